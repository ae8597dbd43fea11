"""Where collected rows go."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import preview


class Sink(Protocol):
    """Takes a table and says how many rows it took; closing twice is allowed."""

    def write(self, df: DataFrame) -> int: ...

    def close(self) -> None: ...


class CountingSink:
    """A dry run: rows are counted and go nowhere."""

    def __init__(self) -> None:
        self.rows = 0

    def write(self, df: DataFrame) -> int:
        n = df.count()
        self.rows += n
        return n

    def close(self) -> None:
        pass


class ConsoleSink(CountingSink):
    """Shows the first rows, shortened, and the total at the end."""

    def __init__(self, first: int = 5, width: int = 1200, out=print) -> None:
        super().__init__()
        self.first, self.width, self.out, self.closed = first, width, out, False

    def write(self, df: DataFrame) -> int:
        for line in df.limit(self.first).toJSON().collect():
            self.out(preview(line, self.width))
        return super().write(df)

    def close(self) -> None:
        if not self.closed:
            self.out(f"{self.rows} rows")
        self.closed = True


class JsonlSink(CountingSink):
    """Compressed JSON lines in folders by source and day of arrival; nothing is written for no rows."""

    def __init__(self, root: str) -> None:
        super().__init__()
        self.root = root

    def write(self, df: DataFrame) -> int:
        n = super().write(df)
        if n:
            df.withColumn("date", F.to_date("ingested_at")).write.mode("append").partitionBy("source", "date").option("compression", "gzip").json(self.root)
        return n
