"""Line dedup: repeated lines in sharded minimal perfect hash tables that documents probe."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.tables import LAST_ID, beside, grouped, id_or_last, salted, written
from tideline.llm.words import mixed, texts_of

MIN_LENGTH = 10
KEYS_PER_SHARD = 1024
PROBES_PER_TASK = 1 << 14
LEVEL_SEED = 0x9E3779B97F4A7C15


def line_key(line: bytes) -> bytes:
    """The line without white space at its ends, A-Z lower-cased (bytes methods know ASCII only)."""
    return line.strip(b" \t\n\x0b\x0c\r").lower()


def key_hash(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def long_enough(key: bytes, least: int) -> bool:
    return len(key) >= 4 * least or len(key) >= least and len(key.decode("utf-8", "replace")) >= least


def line_hashes(docs: DataFrame, least: int = MIN_LENGTH) -> DataFrame:
    """One row for each different long line key of a row of ``docs`` (id, text): id, high, low, lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, ids, counts = [], [], []
            for own, text in zip(batch.column("id").to_pylist(), texts_of(batch), strict=True):
                keys: dict[bytes, int] = {}
                for line in (text or b"").split(b"\n"):
                    key = line_key(line)
                    if long_enough(key, least):
                        keys[key] = keys.get(key, 0) + 1
                found += map(key_hash, keys)
                counts += keys.values()
                ids += [own] * len(keys)
            halves = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(counts, pa.int64())],
                ["id", "high", "low", "lines"],
            )

    return docs.mapInArrow(run, "id long, high long, low long, lines long")


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys with arrays beside it.

    Level by level the keys left over are thrown into a bit set half as large again; a key alone in its place is
    settled there, the others go on to the next level. A key's number is the count of bits set before its own, so
    the numbers are 0 to n - 1 without gaps. A strange key gets some number too, or none; the fingerprint decides.
    """

    def __init__(self, bits: list[np.ndarray]):
        self.bits = bits
        self.before = np.cumsum([0] + [int(b.sum()) for b in bits])
        self.ranks = [np.cumsum(b) - 1 for b in bits]

    @staticmethod
    def places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((LEVEL_SEED * (level + 1)) & ((1 << 64) - 1))
        return (mixed(keys ^ salt) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        bits = []
        while len(keys):
            size = max(16, len(keys) * 3 // 2)
            places = cls.places(keys, len(bits), size)
            alone = np.bincount(places, minlength=size) == 1
            bits.append(alone)
            keys = keys[~alone[places]]
        return cls(bits)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number, -1 where no level has its place."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, bits in enumerate(self.bits):
            places = self.places(keys[left], level, len(bits))
            hit = bits[places]
            out[left[hit]] = self.before[level] + self.ranks[level][places[hit]]
            left = left[~hit]
        return out

    def packed(self) -> bytes:
        sizes = np.array([len(b) for b in self.bits], np.int64)
        return np.int64(len(sizes)).tobytes() + sizes.tobytes() + b"".join(np.packbits(b).tobytes() for b in self.bits)

    @classmethod
    def unpacked(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        sizes, at, bits = np.frombuffer(data, np.int64, n, 8), 8 + 8 * n, []
        for size in sizes.tolist():
            width = (size + 7) // 8
            bits.append(np.unpackbits(np.frombuffer(data, np.uint8, width, at), count=size).astype(bool))
            at += width
        return cls(bits)


def folded(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(high).view(np.uint64) ^ mixed(np.ascontiguousarray(low).view(np.uint64))


SHARD = "shard long, hash binary, prints binary, counts binary, firsts binary"


def build_shards(repeated: DataFrame, shards: int) -> DataFrame:
    """A row for each shard: its hash, and by number the fingerprint, document count and first document of a line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (shard,), rows in grouped(batches, ["shard"]):
            table = np.array([(r["high"], r["low"], r["n_docs"], r["first"]) for r in rows], np.int64)
            # Distinct in 128 bits, and so in the 64 that these fold into but for odds of about 2**-44 a shard.
            keys = folded(table[:, 0], table[:, 1])
            index = PerfectHash.build(np.unique(keys))
            order = index.numbers(keys)
            arrays = np.empty_like(table)
            arrays[order] = table
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "shard": shard,
                        "hash": index.packed(),
                        "prints": np.ascontiguousarray(arrays[:, :2]).tobytes(),
                        "counts": np.ascontiguousarray(arrays[:, 2]).tobytes(),
                        "firsts": np.ascontiguousarray(arrays[:, 3]).tobytes(),
                    }
                ]
            )

    dealt = repeated.withColumn("shard", F.pmod("high", F.lit(shards)).cast("long"))
    return dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, SHARD)


PROBED = "id long, high long, low long, lines long, n_docs long, first long"


def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Look up each line in the arrays of its shard; a line that is not in them gives no row."""
    index = None
    for batch in batches:
        kinds, at = np.asarray(batch.column("kind")), 0
        for edge in [*np.flatnonzero(kinds == 0).tolist(), len(kinds)]:
            lines = batch.slice(at, edge - at)
            if index and lines.num_rows:
                high, low, ids, counts = (np.asarray(lines.column(c)) for c in ("high", "low", "id", "lines"))
                numbers = index.numbers(folded(high, low))
                known = numbers >= 0
                known[known] = (prints[numbers[known]] == np.stack([high, low], 1)[known]).all(1)
                n = numbers[known]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (ids[known], high[known], low[known], counts[known], n_docs[n], firsts[n])],
                    ["id", "high", "low", "lines", "n_docs", "first"],
                )
            if edge < len(kinds):
                row = batch.slice(edge, 1).to_pylist()[0]
                index = PerfectHash.unpacked(row["hash"])
                prints = np.frombuffer(row["prints"], np.int64).reshape(-1, 2)
                n_docs, firsts = np.frombuffer(row["counts"], np.int64), np.frombuffer(row["firsts"], np.int64)
            at = edge + 1


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_LENGTH) -> DataFrame:
    """Every line key that two or more documents share, in each document that has it.

    Returns id, high and low (the key's hash), lines (how often in this document), n_docs, first (smallest id).
    """
    rows = written(line_hashes(docs.select(id_or_last(id_col).alias("id"), F.col(text_col).alias("text")), least))
    ends = [F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n_docs")]
    repeated = written(rows.groupBy("high", "low").agg(*ends).where("first < last").drop("last"))
    shards = max(1, -(-repeated.count() // KEYS_PER_SHARD))
    tables = written(build_shards(repeated, shards))
    probes = rows.withColumn("shard", F.pmod("high", F.lit(shards)).cast("long"))
    tables, probes = salted(tables, probes, probes.groupBy("shard").agg(F.count("*").alias("load")), PROBES_PER_TASK)
    columns = ["shard", "salt", "kind", "id", "high", "low", "lines", "hash", "prints", "counts", "firsts"]
    return beside(tables, probes, ["shard", "salt"]).select(*columns).mapInArrow(probe, PROBED)


CLEAN = "doc_id long, n_lines long, n_dropped long, kept_sha256 string"


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = MIN_LENGTH,
    with_text: bool = True,
) -> DataFrame:
    r"""Each document without the lines that a document with a smaller id has too.

    Texts are split at \n. A line's key is the line with ASCII white space stripped at both ends and A-Z
    lower-cased; keys of fewer than ``least`` code points are left alone. Null and empty text are one empty line.
    A null id counts as one document after all others. Rows that share an id are one document: they keep all their
    lines that no smaller id has, whether they repeat each other or not. An empty table gives no rows. Returns
    doc_id, n_lines, n_dropped, kept_sha256 and, if asked for, text (the lines that stay); no other column is read.
    """
    lost = repeated_lines(docs, id_col, text_col, least).where("first < id")
    drops = lost.groupBy("id").agg(F.collect_set("high").alias("lost"))
    texts = docs.select(id_or_last(id_col).alias("id"), F.col(text_col).alias("text")).join(drops, "id", "left")

    def cleaned(own: int, text: bytes, lost: set[int]) -> dict:
        def stays(line: bytes) -> bool:
            key = line_key(line)
            return not (long_enough(key, least) and int(np.frombuffer(key_hash(key), np.int64)[0]) in lost)

        lines = text.split(b"\n")
        kept = [line for line in lines if stays(line)] if lost else lines
        joined = b"\n".join(kept)
        row = {
            "doc_id": None if own == LAST_ID else own,
            "n_lines": len(lines),
            "n_dropped": len(lines) - len(kept),
            "kept_sha256": hashlib.sha256(joined).hexdigest(),
        }
        return row | ({"text": joined.decode("utf-8", "replace")} if with_text else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lost = batch.column("id").to_pylist(), batch.column("lost").to_pylist()
            rows = [cleaned(i, t or b"", set(gone or ())) for i, t, gone in zip(ids, texts_of(batch), lost, strict=True)]
            yield from pa.Table.from_pylist(rows, schema).to_batches()

    text_field = [("text", pa.string())] if with_text else []
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())]
        + text_field
    )
    return texts.mapInArrow(run, CLEAN + ", text string" * with_text)
