"""Intermediate tables in the folder that all executors share.

A plan that is read several times is written once, as Parquet, below
``spark.checkpoint.dir``; every later read survives the loss of an executor.
Only where that setting is missing (tests, a laptop) a local folder is made.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where none is set a temporary one is made, and set, if all runs in this process; a cluster without one is refused."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.tidewatch.folder", None)
        if not folder:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tidewatch-")
            spark.conf.set("spark.tidewatch.folder", folder)
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder.rstrip("/")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application, so that it needn't be installed there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tidewatch-package-")  # on the driver, which serves it
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "tidewatch.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(at, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)


_written: dict[str, list[tuple[SparkSession, str]]] = {}


def settle(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage is cut and the work done once.

    The table stays until ``clear_settled`` or the end of this Python process.
    """
    return settled_as(df, df.schema, name)


def settled_as(df: DataFrame, schema: StructType, name: str = "step") -> DataFrame:
    """As ``settle``, read with another schema of the same layout (a struct as the vector that is stored like it)."""
    spark = df.sparkSession
    ship_package(spark)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(clear_settled)
    _written.setdefault(spark.sparkContext.applicationId, []).append((spark, path))
    df.write.parquet(path)
    back = spark.read.schema(schema).parquet(path)
    back._settled_at = path
    return back


def discard(settled: DataFrame) -> None:
    """Delete a table that ``settle`` gave back, once all that reads it has been written itself."""
    Files(settled.sparkSession).remove(settled._settled_at)


def clear_settled(spark: SparkSession | None = None) -> int:
    """Delete what ``settle`` has written, of one application or of all; how many tables. Results that still read them must be written first."""
    n = 0
    for app in [spark.sparkContext.applicationId] if spark is not None else list(_written):
        for session, path in _written.pop(app, []):
            try:
                Files(session).remove(path)
                n += 1
            except Exception:  # noqa: BLE001 - the session has ended; its folder is the cluster's to clear
                break
    return n


def tasks(spark: SparkSession) -> int:
    """Tasks for work that a small table multiplies: all cores, however few bytes it has."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def fresh(taken: list[str], name: str) -> str:
    """``name``, lengthened until it clashes with none of ``taken`` (case-blind, as Spark resolves names)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


class Files:
    """A folder tree on any file system that Spark can write to, through Hadoop's file API."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._path(path)
        return fs.exists(p)

    def make_folder(self, path: str) -> None:
        fs, p = self._path(path)
        fs.mkdirs(p)

    def names(self, folder: str) -> list[str]:
        """The names in a folder, sorted; none if it isn't there."""
        fs, p = self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def files(self, folder: str, suffix: str) -> list[tuple[str, int]]:
        """All files below a folder with that suffix, and their bytes."""
        fs, p = self._path(folder)
        found, it = [], fs.listFiles(p, True) if fs.exists(p) else None
        while it is not None and it.hasNext():
            s = it.next()
            if s.getPath().getName().endswith(suffix):
                found.append((s.getPath().toString(), s.getLen()))
        return found

    def read(self, path: str) -> str:
        fs, p = self._path(path)
        stream = fs.open(p)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        fs, p = self._path(path)
        stream = fs.create(p, True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> bool:
        """Make a file appear whole, at once and only if it isn't there; False if it is."""
        folder, name = path.rsplit("/", 1)
        tmp = f"{folder}/.{name}-{uuid.uuid4().hex}"
        self.write(tmp, text)
        fs, p = self._path(path)
        try:
            if fs.getScheme() == "file":  # a rename would replace it here; a link doesn't
                plain = self._path(path)[1].toUri().getPath()
                os.link(self._path(tmp)[1].toUri().getPath(), plain)
                return True
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self._conf)
            context.rename(self._path(tmp)[1], p, self._no_options())
            return True
        except FileExistsError:
            return False
        except Exception as e:  # Py4J wraps the file system's own error
            if "AlreadyExists" in str(e):
                return False
            raise
        finally:
            if self.exists(tmp):
                self.remove(tmp)

    def _no_options(self):
        return self._jvm.java.lang.reflect.Array.newInstance(self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)

    def replace(self, path: str, text: str) -> None:
        """Write a small file anew; readers see the old or the new one (on file systems whose rename is atomic)."""
        fs, p = self._path(path)
        tmp = f"{path}.{uuid.uuid4().hex}.tmp"
        self.write(tmp, text)
        if fs.getScheme() != "file" and fs.exists(p):
            fs.delete(p, False)
        fs.rename(self._path(tmp)[1], p)

    def move(self, path: str, to: str) -> None:
        """Rename a file; nothing happens if it is there already."""
        fs, p = self._path(to)
        if not fs.exists(p):
            fs.mkdirs(p.getParent())
            fs.rename(self._path(path)[1], p)

    def remove(self, path: str) -> None:
        fs, p = self._path(path)
        fs.delete(p, True)
