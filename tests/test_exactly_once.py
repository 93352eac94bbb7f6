"""The watching source over files that grow, and the two-phase sink over failures before, in and after a commit."""

import io
import os
import random
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tideline.sinks import committed as C
from tideline.sources import watched as W
from tideline.streaming.run import append_to

# Source


def put(path, text, at, mode="w"):
    with open(path, mode) as out:
        out.write(text)
    os.utime(path, ns=(at, at))


def run_lines(spark, base, split_bytes=W.SPLIT_BYTES):
    lines = W.watch_changing_lines(spark, f"{base}/in", split_bytes)
    append_to(lines, f"{base}/out", f"{base}/check")
    return Counter(r["value"] for r in spark.read.parquet(f"{base}/out").collect())


def test_a_changed_file_is_read_again_whole_and_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder / "a.txt", "a1\na2\n", 10**18)
    put(folder / "b.txt", "b1\r\né2", 10**18)
    put(folder / "_hidden", "no\n", 10**18)
    first = Counter(["a1", "a2", "b1", "é2"])
    assert run_lines(spark, tmp_path) == first
    assert run_lines(spark, tmp_path) == first
    put(folder / "a.txt", "a3\n", 10**18 + 5, "a")
    put(folder / "c.txt", "", 10**18 + 6)
    assert run_lines(spark, tmp_path) == first + Counter(["a1", "a2", "a3"])
    # The same change time as the last one seen, but another length.
    put(folder / "c.txt", "c1\n", 10**18 + 6)
    assert run_lines(spark, tmp_path, split_bytes=4) == first + Counter(["a1", "a2", "a3", "c1"])
    assert run_lines(spark, tmp_path) == first + Counter(["a1", "a2", "a3", "c1"])


def test_parts_of_a_file_hold_each_line_once(monkeypatch):
    monkeypatch.setattr(W, "BLOCK_BYTES", 7)
    rng = random.Random(2)
    for _ in range(300):
        lines = ["x" * rng.choice([0, 1, 2, 9, 40]) + str(i) for i in range(rng.randint(0, 12))]
        data = "\n".join(lines).encode() + rng.choice([b"", b"\n"] if lines else [b""])
        split = rng.choice([1, 3, 8, 100])
        parts = W.parts_between([("f", 5, len(data))], {"since": 0, "at": {}}, {"since": 5, "at": {"f": len(data)}}, split)
        got = [line for part in parts for block in W.lines_of(io.BytesIO(data), part) for line in block]
        assert got == data.decode().split("\n")[: len(lines)]


def test_offsets_enclose_changes():
    files = [("a", 5, 10), ("b", 7, 10), ("c", 7, 20), ("d", 9, 1)]
    offset = lambda since, **at: {"since": since, "at": at}
    paths = lambda start, end: [p.path for p in W.parts_between(files, start, end, 100)]
    assert paths(offset(0), offset(9, d=1)) == ["a", "b", "c", "d"]
    assert paths(offset(7, b=10), offset(9, d=1)) == ["c", "d"]
    assert paths(offset(7, b=10, c=20), offset(7, b=10, c=20)) == []
    # A file that has changed since the end was taken is left to the batch that takes it.
    assert paths(offset(5, a=10), offset(7, b=10, c=15)) == ["b"]


# Sink


class Failing(C.CommittedWriter):
    """Fails once at the place that the file ``fail`` names."""

    def _fail(self, place):
        mark = f"{self.path}/fail"
        if os.path.exists(mark) and open(mark).read() == place:
            os.rename(mark, f"{mark}-done")
            raise RuntimeError(f"failed {place}")

    def write(self, iterator):
        staged = super().write(iterator)
        if staged.rows:
            self._fail("write")
        return staged

    def commit(self, messages, batchId):
        self._fail("before commit")
        super().commit(messages, batchId)
        self._fail("after commit")


class FailingTable(C.CommittedTable):
    @classmethod
    def name(cls):
        return "failing_table"

    def streamWriter(self, schema, overwrite):
        return Failing(self.options["path"])


@pytest.mark.parametrize("place", ["write", "before commit", "after commit"])
def test_each_row_is_there_once(spark, tmp_path, place, monkeypatch):
    base, table = f"{tmp_path}", f"{tmp_path}/table"
    os.mkdir(table)
    schema, want = "id long, text string", Counter()
    for part in range(3):
        spark.range(part * 100, part * 100 + 100, 1, 3).select("id", F.concat(F.lit("t"), "id").alias("text")).write.mode("append").parquet(f"{base}/in")
        want.update((i, f"t{i}") for i in range(part * 100, part * 100 + 100))
        rows = spark.readStream.schema(schema).parquet(f"{base}/in")
        if part == 1:
            with open(f"{table}/fail", "w") as out:
                out.write(place)
            with pytest.raises(StreamingQueryException):
                C.commit_to(rows, table, f"{base}/check", FailingTable)
            # What was staged is invisible unless the failure came after the commit.
            seen = C.read_committed(spark, table, rows.schema).count()
            assert seen == (200 if place == "after commit" else 100)
        C.commit_to(rows, table, f"{base}/check", FailingTable)
    got = C.read_committed(spark, table, rows.schema)
    assert Counter(map(tuple, got.collect())) == want
    assert [r["rows"] for r in C.manifests(spark, table).orderBy("batch").collect()] == [100, 100, 100]
    C.remove_uncommitted(spark, table)
    assert C.remove_uncommitted(spark, table) == 0 and got.count() == 300


def test_nothing_committed_yet(spark, tmp_path):
    assert C.read_committed(spark, f"{tmp_path}/none", spark.range(1).schema).count() == 0
    assert C.remove_uncommitted(spark, f"{tmp_path}") == 0
