"""A folder of text files as a stream in which a changed file is read again, whole.

Offsets are the source's own: the newest change time seen and, of the files that changed just then, their lengths. So
an offset stays small however many files there are. A file belongs to the micro-batch whose offsets enclose its change
time; a file that changes while it waits to be read, or before a batch is run again, is read by a later batch instead.
Files that were given an old change time (moved in, say) are not seen, which holds for any source that goes by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SPLIT_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20


@dataclass
class Part(InputPartition):
    """The lines of a file that begin in ``[begin, end)``, of a file that had ``size`` bytes when it was listed."""

    path: str
    begin: int
    end: int
    size: int
    changed: int


def parts_between(files: list[tuple[str, int, int]], start: dict, end: dict, split: int) -> list[Part]:
    """The parts of the files (path, change time, length) that changed after ``start`` and up to ``end``."""
    out = []
    for path, changed, size in sorted(files):
        again = changed == start["since"] and start["at"].get(path) != size
        late = changed == end["since"] and end["at"].get(path) != size
        if (changed > start["since"] or again) and changed <= end["since"] and not late:
            out += [Part(path, b, min(b + split, size), size, changed) for b in range(0, size, split)]
    return out


def line_start(stream, at: int, size: int) -> int:
    """Where the first line begins that does not begin before ``at``."""
    if at <= 0 or at >= size:
        return min(max(at, 0), size)
    at -= 1
    stream.seek(at)
    while at < size:
        block = stream.read(min(BLOCK_BYTES, size - at))
        found = block.find(b"\n")
        if found >= 0:
            return at + found + 1
        if not block:
            break
        at += len(block)
    return size


def lines_of(stream, part: Part) -> Iterator[list[str]]:
    """The lines of a part in blocks; a line that begins in the part is read to its end."""
    at, end = (line_start(stream, x, part.size) for x in (part.begin, part.end))
    stream.seek(at)
    rest = b""
    while at < end:
        block = stream.read(min(BLOCK_BYTES, end - at))
        if not block:
            break
        at += len(block)
        cut = block.rfind(b"\n") + 1
        if cut:
            yield _decoded(rest + block[:cut])
            rest = block[cut:]
        else:
            rest += block
    if rest:
        yield _decoded(rest)


def _decoded(block: bytes) -> list[str]:
    lines = block.decode("utf-8", "replace").split("\n")
    if not lines[-1]:
        lines.pop()
    return [line.removesuffix("\r") for line in lines]


class WatchedReader(DataSourceStreamReader):
    def __init__(self, path: str, split: int):
        self.path, self.split = path, split

    def _files(self) -> list[tuple[str, int, int]]:
        system, root = fs.FileSystem.from_uri(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        return [
            (f.path, f.mtime_ns, f.size)
            for f in found
            if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))
        ]

    def initialOffset(self) -> dict:
        return {"since": 0, "at": {}}

    def latestOffset(self) -> dict:
        files = self._files()
        since = max((changed for _, changed, _ in files), default=0)
        return {"since": since, "at": {path: size for path, changed, size in files if changed == since}}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        return parts_between(self._files(), start, end, self.split)

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(self.path)
        changed = partition.changed // 1000
        with system.open_input_file(partition.path) as stream:
            for lines in lines_of(stream, partition):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(lines, pa.string()),
                        pa.array([partition.path] * len(lines), pa.string()),
                        pa.array([changed] * len(lines), pa.timestamp("us", tz="UTC")),
                    ],
                    names=["value", "file", "changed_at"],
                )

    def commit(self, end: dict) -> None:
        """Nothing to release: the offsets in the checkpoint are all there is."""


class WatchedLines(DataSource):
    """``spark.readStream.format("watched_lines").load(folder)``: value, file and changed_at of every line.

    Option ``split_bytes``: how much of a file a task reads.
    """

    @classmethod
    def name(cls) -> str:
        return "watched_lines"

    def schema(self) -> str:
        return "value STRING, file STRING, changed_at TIMESTAMP"

    def streamReader(self, schema) -> WatchedReader:
        return WatchedReader(self.options["path"], int(self.options.get("split_bytes", SPLIT_BYTES)))


def watch_changing_lines(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Lines of the files in a folder; a file that changes is read again, all of it, once per change that is seen."""
    spark.dataSource.register(WatchedLines)
    return spark.readStream.format("watched_lines").option("split_bytes", split_bytes).load(folder)
