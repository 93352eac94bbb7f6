"""N-gram Jaccard join by PartEnum signatures."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.components import components
from tideline.llm.tables import LAST_ID, grouped, id_or_last, likely_members, membership, shuffle_partitions, written
from tideline.llm.words import OTHERS, in_blocks, mixed, run_hashes, signed, texts_of, tokenised

SHINGLE, PERCENT = 4, 85
#: Sizes of sets from one band to the next, and parts of the domain for each part that must be enumerated.
BAND_RATIO, SPARE = 1.5, 1.35
#: Parts of the finer division whose digests, a byte each, rule pairs out.
FINE = 4
#: Documents around one pivot that are compared in one block.
BLOCK = 512


def shingle_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """Each text's set of word runs as sorted hashes; a text with fewer words has one run of all of them."""
    words = tokenised(texts, lower=True)
    runs, out = run_hashes(words.hashes, size), []
    for begin, end in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if end - begin >= size:
            out.append(np.unique(runs[begin : end - size + 1]))
        else:
            out.append(run_hashes(words.hashes[begin:end], end - begin) if end > begin else runs[:0])
    return out


def allowed(smaller: int, percent: int) -> int:
    """Elements in which two sets may differ, if the smaller one has ``smaller``: all that stay in 15 % of the union."""
    return smaller * (100 - percent) // percent


class Band:
    """Sets of sizes ``low`` to ``high`` and those a little larger that may be like them.

    Such sets differ in at most ``differ`` elements if they are similar. The domain is divided into ``parts``, more
    than ``differ``, so similar sets agree on at least ``parts - differ`` parts.
    """

    def __init__(self, number: int, percent: int):
        self.low, self.high = math.ceil(BAND_RATIO**number), math.ceil(BAND_RATIO ** (number + 1)) - 1
        self.number, self.differ = number, allowed(self.high, percent)
        self.parts = int(SPARE * (self.differ + 1)) + 1

    @staticmethod
    def of(size: int, percent: int) -> list[Band]:
        """The set's own band, and those below with sets that it may be similar to."""
        number = int(math.log(size) / math.log(BAND_RATIO))
        while math.ceil(BAND_RATIO ** (number + 1)) <= size:
            number += 1
        while math.ceil(BAND_RATIO**number) > size:
            number -= 1
        bands = []
        while number >= 0 and (not bands or math.ceil(BAND_RATIO ** (number + 1)) - 1 >= math.ceil(size * percent / 100)):
            bands.append(Band(number, percent))
            number -= 1
        # Sets that may not differ at all are copies, which have their own way.
        return [b for b in bands if b.differ > 0]


def division(elements: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(digest, size) of what a sorted set has in each of ``parts`` equal ranges of the hashes."""
    limits = (np.arange(1, parts, dtype=np.float64) * (2.0**64 / parts)).astype(np.uint64)
    cuts = np.concatenate(([0], np.searchsorted(elements, limits), [len(elements)]))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(elements ^ np.uint64(0x5851F42D4C957F2D)))))
    return sums[cuts[1:]] - sums[cuts[:-1]], np.diff(cuts)


def signatures(elements: np.ndarray, band: Band) -> np.ndarray:
    """The set's signatures in a band: the parts it has most elements in, one more than may differ.

    Two similar sets agree on at least ``parts - differ`` parts. Parts they agree on have the same size and digest, so
    both put them in the same order, and then one of them is among the first ``differ + 1`` of both.
    """
    digests, sizes = division(elements, band.parts)
    marks = mixed(digests + np.arange(band.parts, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(band.number + 1))
    return marks[np.lexsort((marks, -sizes))[: band.differ + 1]]


def fine_digests(elements: np.ndarray, band: Band) -> bytes:
    """A byte for each part of a finer division; similar sets have at most ``differ`` different bytes."""
    return (division(elements, FINE * (band.differ + 1))[0] >> np.uint64(56)).astype(np.uint8).tobytes()


PROFILE = "id long, key long, n_shingles long, high long, low long"
SIGNED = "sig long, doc long, band int"


def set_digests(sets: list[np.ndarray]) -> np.ndarray:
    """128 bits for each set: two sums of differently mixed elements."""
    return np.array(
        [[mixed(s).sum(dtype=np.uint64), mixed(s * np.uint64(OTHERS.base)).sum(dtype=np.uint64)] for s in sets], np.uint64
    ).reshape(-1, 2)


def set_profiles(texts: DataFrame, size: int) -> DataFrame:
    """Set size and digest of each row (id, key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = texts_of(batch)
            sets = [s for part in in_blocks(bodies) for s in shingle_sets(bodies[part], size)]
            digests = set_digests(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("key"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(signed(digests[:, 0].copy())), pa.array(signed(digests[:, 1].copy())),
                ],
                ["id", "key", "n_shingles", "high", "low"],
            )

    return texts.mapInArrow(run, PROFILE)


def signature_rows(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(sig, doc, band) of every set; a task gives the rows of equal sets once, under the first of their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            bodies, keys = texts_of(batch), batch.column("key").to_pylist()
            for part in in_blocks(bodies):
                sigs, docs, bands = [], [], []
                sets = shingle_sets(bodies[part], size)
                for key, elements, digest in zip(keys[part], sets, set_digests(sets).tolist(), strict=True):
                    if not len(elements) or tuple(digest) in seen:
                        continue
                    seen.add(tuple(digest))
                    for band in Band.of(len(elements), percent):
                        sigs.append(signatures(elements, band))
                        docs.append(key)
                        bands.append(band.number)
                if sigs:
                    counts = [len(s) for s in sigs]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(signed(np.concatenate(sigs))),
                            pa.array(np.repeat(np.array(docs, np.int64), counts)),
                            pa.array(np.repeat(np.array(bands, np.int32), counts)),
                        ],
                        ["sig", "doc", "band"],
                    )

    return texts.select("key", "text").mapInArrow(run, SIGNED)


SETS = "doc long, size int, elements binary, fines array<struct<band:int,fine:binary>>"


def set_rows(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The sets themselves with their fine digests, for the documents that share a signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("doc", pa.int64()), ("size", pa.int32()), ("elements", pa.binary()),
             ("fines", pa.list_(pa.struct([("band", pa.int32()), ("fine", pa.binary())])))]
        )
        for batch in batches:
            bodies, keys = texts_of(batch), batch.column("key").to_pylist()
            for part in in_blocks(bodies):
                rows = [
                    {
                        "doc": key, "size": len(s), "elements": s.tobytes(),
                        "fines": [{"band": b.number, "fine": fine_digests(s, b)} for b in Band.of(len(s), percent)],
                    }
                    for key, s in zip(keys[part], shingle_sets(bodies[part], size), strict=True)
                ]
                yield from pa.Table.from_pylist(rows, schema).to_batches()

    return texts.select("key", "text").mapInArrow(run, SETS)


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int((y[at] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def alike(percent: int):
    """Keep the pairs (a, b) whose sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("one").to_pylist(), batch.column("other").to_pylist(), strict=True)
            keep = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in sides]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def not_ruled_out(percent: int):
    """Keep the pairs (a, b) whose fine digests differ in no more parts than similar sets may."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                int((np.frombuffer(x["fine"], np.uint8) != np.frombuffer(y["fine"], np.uint8)).sum())
                <= allowed(min(x["size"], y["size"]), percent)
                for x, y in zip(batch.column("one").to_pylist(), batch.column("other").to_pylist(), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


MEMBER = "pivot long, left int, right int, band int, block int, doc long, component long, size int, fine binary"


def candidates(rows: list[dict], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of a block, the later rows of other components that the fine digests do not rule out."""
    sizes, components = np.array([r["size"] for r in rows]), np.array([r["component"] for r in rows])
    blocks = np.array([r["block"] for r in rows])
    within = rows[0]["left"] == rows[0]["right"]
    fine = np.frombuffer(b"".join(r["fine"] for r in rows), np.uint8).reshape(len(rows), -1)
    for i in range(len(rows) - 1):
        other = components[i + 1 :] != components[i]
        if not within:
            other &= blocks[i + 1 :] != blocks[i]
        others = np.flatnonzero(other) + i + 1
        if len(others):
            limits = np.minimum(sizes[others], sizes[i]) * (100 - percent) // percent
            yield i, others[(fine[others] != fine[i]).sum(1) <= limits]


def with_candidates(percent: int):
    """The rows of each block that have a candidate: as many as there are rows at most, not pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, ["pivot", "left", "right", "band"]):
            rows, found = list(rows), set()
            for i, others in candidates(rows, percent):
                found.update([i, *others.tolist()] if len(others) else [])
            if found:
                table = pa.Table.from_pylist([rows[i] for i in sorted(found)], MEMBER_SCHEMA)
                yield from table.to_batches()

    return run


MEMBER_SCHEMA = pa.schema(
    [
        ("pivot", pa.int64()), ("left", pa.int32()), ("right", pa.int32()), ("band", pa.int32()), ("block", pa.int32()),
        ("doc", pa.int64()), ("component", pa.int64()), ("size", pa.int32()), ("fine", pa.binary()),
    ]
)


def linked_in_blocks(percent: int):
    """The pairs of candidates whose sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, ["pivot", "left", "right", "band"]):
            rows, a, b = list(rows), [], []
            sets = [np.frombuffer(r["elements"], np.uint64) for r in rows]
            for i, others in candidates(rows, percent):
                for j in others.tolist():
                    if similar(sets[i], sets[j], percent):
                        a.append(rows[i]["doc"])
                        b.append(rows[j]["doc"])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def both_sides(pairs: DataFrame, sides: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Add ``value`` of both documents of each pair, as one and other."""
    for name, out in (("a", "one"), ("b", "other")):
        side = sides.select(F.col("doc").alias(name), *keys, F.col(value).alias(out))
        pairs = pairs.join(side, [name, *keys])
    return pairs


def similarity_links(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, component) of the keys that links connect to others.

    First every document of a signature is compared with its pivot, the smallest one; what is similar is linked and
    makes components. Only pivots whose documents still are of several components go on: these documents, once each
    for all signatures of the pivot, are compared across components, in blocks, by fine digests first and those that
    have candidates by the sets. Pairs within a component
    need no comparison, as a further link would change nothing, and no pair is written that is not a link.
    """
    rows = signature_rows(texts, size, percent)
    shared = rows.groupBy("sig").agg(F.count("*").alias("n")).where("n > 1")
    met = written(rows.join(shared, "sig"))
    meeting = written(met.join(met.groupBy("sig").agg(F.min("doc").alias("pivot")), "sig"))
    involved = met.select(F.col("doc").alias("key")).distinct()
    near = likely_members(texts.select("key", "text"), "key", membership(involved, "key"))
    sets = written(set_rows(near.join(involved, "key", "left_semi").dropDuplicates(["key"]), size, percent))
    fines = sets.select("doc", "size", F.inline("fines"))
    stars = meeting.where("doc <> pivot").select(F.col("pivot").alias("a"), F.col("doc").alias("b"), "band").distinct()
    looks = fines.select("doc", "band", F.struct("size", "fine").alias("look"))
    likely = both_sides(stars, looks, ["band"], "look").mapInArrow(not_ruled_out(percent), "a long, b long").distinct()
    links = written(both_sides(likely, sets, [], "elements").mapInArrow(alike(percent), "a long, b long"))
    found = written(components(links))
    # What is left: the documents around a pivot, over all its signatures, that are not all of one component.
    around = meeting.where("doc <> pivot").select("pivot", "band", "doc").distinct()
    members = around.join(found.withColumnRenamed("node", "doc"), "doc", "left")
    members = members.withColumn("component", F.coalesce("component", "doc"))
    facts = [F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n")]
    unsettled = members.groupBy("pivot", "band").agg(*facts).where("x < y").drop("x", "y")
    rows = members.join(unsettled, ["pivot", "band"]).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"left": F.least("block", "with"), "right": F.greatest("block", "with")})
    rows = in_blocks_of(rows.join(fines, ["doc", "band"]).select(*MEMBER_SCHEMA.names)).mapInArrow(with_candidates(percent), MEMBER)
    rows = written(rows)
    checked = in_blocks_of(rows.join(sets.select("doc", "elements"), "doc"))
    more = checked.select(*MEMBER_SCHEMA.names, "elements").mapInArrow(linked_in_blocks(percent), "a long, b long").distinct()
    # Components so far stand for their links.
    hung = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return written(components(hung.unionByName(more)))


def in_blocks_of(rows: DataFrame) -> DataFrame:
    keys = ["pivot", "left", "right", "band"]
    return rows.repartition(shuffle_partitions(rows), *keys).sortWithinPartitions(*keys, "doc")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(id_or_last(id_col).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"), text.alias("text"))


def grouped_texts(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """id, key, n_shingles, class_id and component_id of each row (id, key, text); the last two null for empty sets.

    Ids may stand at several texts, so they do not tell components apart: beside them there are ``high`` and ``low``, the
    digest of the set, and ``component``, the key that stands for all linked sets, null without links.
    """
    rows = written(set_profiles(texts, size))
    classes = rows.where("n_shingles > 0").groupBy("high", "low", "n_shingles").agg(F.min("id").alias("class_id"))
    found = similarity_links(texts, size, percent)
    # A signature row stands under the key of some text of its class: bring components to classes.
    keys = rows.select("key", "high", "low", "n_shingles").distinct()
    linked = found.withColumnRenamed("node", "key").join(keys, "key").select("high", "low", "n_shingles", "component").distinct()
    member = classes.join(linked, ["high", "low", "n_shingles"], "left")
    least = member.where("component IS NOT NULL").groupBy("component").agg(F.min("class_id").alias("component_id"))
    member = member.join(least, "component", "left").select(
        "high", "low", "n_shingles", "class_id", F.coalesce("component_id", "class_id").alias("component_id"), "component"
    )
    out = rows.join(member, ["high", "low", "n_shingles"], "left")
    return out.select("id", "key", "n_shingles", "class_id", "component_id", "high", "low", "component")


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """Each document's set size and component under links of similar sets.

    A document's set has its different runs of ``size`` words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased); a text with
    fewer words has one run of all of them; one without words, or null, has none and links with nothing. Documents
    link if the sets have at least ``percent`` % of their union in common. Links and components are made between
    sets; equal sets are one class throughout, however many documents have it. A null id is the largest id, and
    null in the result; repeated rows are equal sets. An empty table gives no rows; other columns are not read.

    Returns doc_id, n_shingles, component_id (the smallest id that links reach) and class_id (smallest id of the
    same set).
    """
    out = grouped_texts(keyed(docs, id_col, text_col), size, percent)
    shown = lambda c: F.when(c != LAST_ID, c)
    return out.select(
        shown(F.col("id")).alias("doc_id"),
        "n_shingles",
        shown(F.coalesce("component_id", "id")).alias("component_id"),
        shown(F.coalesce("class_id", "id")).alias("class_id"),
    )


def one_of_each_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """The documents that stay, with all their columns: of each component the row with the smallest id, as one row.

    Null ids, and an id that stands at several texts, name no component: each component keeps a row of its own, of
    equal ids the one with the smallest text hash. Documents without words belong to no group and all stay. Columns may
    have any names; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = docs.select(
        F.struct("*").alias("row"),
        id_or_last(id_col).alias("id"),
        F.xxhash64(text).alias("key"),
        (~text.rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
    )
    found = grouped_texts(keyed(docs, id_col, text_col), size, percent)
    # Linked sets go by their component, others by their own digest.
    digest = [F.when(F.col("component").isNull(), F.col(c)).alias(c) for c in ("high", "low", "n_shingles")]
    first = found.where("n_shingles > 0").groupBy("component", *digest).agg(F.min(F.struct("id", "key")).alias("first"))
    stay = first.select("first.id", "first.key")
    single = marked.where("NOT blank").join(stay, ["id", "key"], "left_semi").dropDuplicates(["id", "key"])
    return single.select("row.*").unionByName(marked.where("blank").select("row.*"))
