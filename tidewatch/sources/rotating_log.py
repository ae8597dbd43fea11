"""A log that rotates, followed by file identity and byte offset, as a streaming source.

``spark.readStream.format("rotating_log").load(folder)`` gives ``(line, inode, offset, rejected)``.
Only whole lines are read; a half-written one waits. A renamed file keeps its
identity and is read on; one that shrank is read anew. A line longer than
``maxLine`` bytes comes as a rejected row, without its text. The checkpoint holds the offsets.
"""

from __future__ import annotations

import os
import re
import subprocess
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Most bytes of a line, as in the collector that this source follows.
MAX_LINE = 8 << 20


@dataclass(frozen=True)
class LogFile:
    inode: int
    size: int
    name: str


def list_logs(folder: str, prefix: str) -> list[LogFile]:
    """The log's files, oldest first, the live one last."""
    found = []
    for name in os.listdir(folder):
        if name == prefix or name.startswith(prefix + "."):
            st = os.stat(os.path.join(folder, name))
            found.append(LogFile(st.st_ino, st.st_size, name))
    return sorted(found, key=lambda f: (f.name == prefix, f.name))


_LISTED = re.compile(r"([0-9]+) ([0-9]+) ([A-Za-z0-9][A-Za-z0-9._-]*)")


def parse_listing(text: str, live: str) -> list[LogFile]:
    """``inode size name`` lines from a remote reader, oldest file first; a line of any other form is dropped, not trusted."""
    found = (_LISTED.fullmatch(line.strip()) for line in text.splitlines())
    return sorted((LogFile(int(m[1]), int(m[2]), m[3]) for m in found if m), key=lambda f: (f.name == live, f.name))


class RemoteLogs:
    """The same files on another machine, through a command that answers ``list`` and ``read <inode> <offset> <bytes>``.

    ``command``: how to reach it, such as ``ssh -o BatchMode=yes sensor log-reader``. Arguments are passed as a list, never through a shell here.
    """

    def __init__(self, command: Sequence[str], live: str, timeout: float = 60):
        self.command, self.live, self.timeout = list(command), live, timeout

    def _run(self, *args: str) -> bytes:
        done = subprocess.run([*self.command, *args], capture_output=True, timeout=self.timeout, check=False)
        if done.returncode:
            raise ConnectionError(f"{self.command[0]} ended with {done.returncode}: {done.stderr.decode(errors='replace')[:500]}")
        return done.stdout

    def files(self) -> list[LogFile]:
        return parse_listing(self._run("list").decode(errors="replace"), self.live)

    def fetch(self, folder: str, chunk: int = MAX_LINE) -> int:
        """Bring local copies of all files up to date, byte by byte where they ended; how many bytes came.

        A copy has the remote file's inode in its name, so that a rotated file stays the same copy; a file that shrank is fetched anew.
        """
        os.makedirs(folder, exist_ok=True)
        total = 0
        for f in self.files():
            path = os.path.join(folder, f"{self.live}.{f.inode:020d}")
            have = os.path.getsize(path) if os.path.exists(path) else 0
            with open(path, "r+b" if 0 < have <= f.size else "wb") as out:
                have = have if have <= f.size else 0
                out.seek(have)
                while have < f.size:
                    data = self._run("read", str(f.inode), str(have), str(min(chunk, f.size - have)))
                    if not data:
                        raise ConnectionError(f"{f.name} ended at {have} of {f.size} bytes")
                    out.write(data)
                    have += len(data)
                    total += len(data)
        return total


def whole_lines(path: str, start: int, stop: int, chunk: int = MAX_LINE, most: int = MAX_LINE) -> Iterator[tuple[bytes | None, int]]:
    """Complete lines in ``[start, stop)`` with the offset after each, in chunks; None for an overlong one, which is never held whole."""
    with open(path, "rb") as f:
        f.seek(start)
        at, seen, rest, dropped = start, start, b"", 0
        while seen < stop:
            data = f.read(min(chunk, stop - seen))
            if not data:
                return
            seen += len(data)
            *lines, rest = (rest + data).split(b"\n")
            for line in lines:
                size, dropped = dropped + len(line), 0
                at += size + 1
                if size > most:
                    yield None, at
                elif line.strip():
                    yield line, at
            if dropped + len(rest) > most:
                rest, dropped = b"", dropped + len(rest)


def end_of_lines(path: str, start: int, size: int) -> int:
    """Where the last complete line ends."""
    with open(path, "rb") as f:
        back = size
        while back > start:
            step = max(start, back - 65536)
            f.seek(step)
            i = f.read(back - step).rfind(b"\n")
            if i >= 0:
                return step + i + 1
            back = step
    return start


@dataclass
class Span(InputPartition):
    inode: int
    start: int
    stop: int


class RotatingLogReader(DataSourceStreamReader):
    def __init__(self, folder: str, prefix: str, most: int):
        self.folder, self.prefix, self.most = folder, prefix, most
        self.seen: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        files = {}
        for f in list_logs(self.folder, self.prefix):
            path = os.path.join(self.folder, f.name)
            start = self.seen.get(str(f.inode), 0)
            files[str(f.inode)] = end_of_lines(path, start if start <= f.size else 0, f.size)
        self.seen = files
        return {"files": files}

    def partitions(self, start: dict, end: dict):
        spans = []
        for inode, stop in end["files"].items():
            begin = start["files"].get(inode, 0)
            begin = 0 if begin > stop else begin  # the file shrank: it was cut and written anew
            if stop > begin:
                spans.append(Span(int(inode), begin, stop))
        return spans

    def read(self, partition: Span):
        for f in list_logs(self.folder, self.prefix):
            if f.inode == partition.inode:
                for line, at in whole_lines(os.path.join(self.folder, f.name), partition.start, partition.stop, most=self.most):
                    yield None if line is None else line.decode("utf-8", "replace"), partition.inode, at, line is None
                return
        # its lines were promised: to give none here would pass over them for good
        raise FileNotFoundError(f"inode {partition.inode} below {self.folder} went away before bytes {partition.start} to {partition.stop} were read; put it back (unpacked) and run again")

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class RotatingLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rotating_log"

    def schema(self) -> str:
        return "line string, inode long, offset long, rejected boolean"

    def streamReader(self, schema) -> DataSourceStreamReader:
        o = self.options
        return RotatingLogReader(o["path"], o.get("prefix", "cowrie.json"), int(o.get("maxLine", MAX_LINE)))
