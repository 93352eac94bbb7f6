"""Substring dedup: matching statistics of passages against suffix automata of reference shards."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.automaton import SuffixAutomaton
from tideline.llm.tables import LAST_ID, beside, id_or_last, salted, written
from tideline.llm.words import OTHERS, Words, in_blocks, run_hashes, signed, sliding, texts_of, tokenised

WINDOW = 50
#: Words of a landmark, the run that brings equal windows together; each window has at least one.
LANDMARK = 25
#: Reference words of one automaton, words of a passage's home, and landmarks a task matches against one automaton.
SHARD_WORDS, HOME_WORDS, PROBES_PER_TASK = 50_000, 4096, 1 << 14
SPANS = "array<struct<first:int,past:int>>"


def landmarks(words: Words, window: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, where) of the landmarks: in every window the run of ``size`` words with the smallest hash.

    Equal windows have equal landmarks in equal places. About one word in fourteen starts one.
    """
    runs = run_hashes(words.hashes, size)
    inside = words.last_start(size)
    runs = np.where(inside, runs, np.uint64((1 << 64) - 1))
    width = window - size + 1
    smallest = sliding(runs, width, np.minimum)
    if not len(smallest):
        return runs[:0], np.zeros(0, np.int64)
    smallest = np.where(words.last_start(window), smallest, np.uint64(0))
    edge = np.zeros(width - 1, np.uint64)
    chosen = sliding(np.concatenate((edge, smallest, edge)), width, np.maximum) == runs
    where = np.flatnonzero(chosen & inside)
    return runs[where], where


PROFILE = "id long, key long, n_words long, digest string, hashes array<long>, places array<int>"


def profiles(texts: DataFrame, window: int, size: int) -> DataFrame:
    """Word count, digest of the words and landmarks of each row (id, key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = texts_of(batch)
            for part in in_blocks(bodies):
                words = tokenised(bodies[part])
                hashes, where = landmarks(words, window, size)
                counts = words.counts()
                offsets = np.searchsorted(where, words.first)
                own = np.repeat(words.first[:-1], np.diff(offsets))
                digests = [hashlib.sha256(b" ".join((b or b"").split())).hexdigest() for b in bodies[part]]
                rows = batch.slice(part.start, part.stop - part.start)
                bounds = pa.array(offsets, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("id"), rows.column("key"), pa.array(counts), pa.array(digests),
                        pa.ListArray.from_arrays(bounds, pa.array(signed(hashes))),
                        pa.ListArray.from_arrays(bounds, pa.array((where - own).astype(np.int32))),
                    ],
                    ["id", "key", "n_words", "digest", "hashes", "places"],
                )

    return texts.mapInArrow(run, PROFILE)


PASSAGE = "shard long, kind int, id long, key long, at int, words binary, places array<int>"


def passages(plans: DataFrame, shards: int, window: int, size: int) -> DataFrame:
    """Cut from each text (id, key, text, marks) what has to be compared, by the shard it goes to.

    A mark (shard, owner, place) is a landmark that documents share. All windows with this landmark lie from
    ``window - size`` words before it to ``window`` words after its start; such stretches are joined where they
    overlap. In the owner, the first document that has the landmark, they are reference (kind 0), else they are
    to be matched (kind 1).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("shard", pa.int64()), ("kind", pa.int32()), ("id", pa.int64()), ("key", pa.int64()),
                ("at", pa.int32()), ("words", pa.binary()), ("places", pa.list_(pa.int32())),
            ]
        )
        for batch in batches:
            rows = []
            columns = zip(
                batch.column("id").to_pylist(), batch.column("key").to_pylist(), texts_of(batch),
                batch.column("marks").to_pylist(), strict=True,
            )
            for own, key, text, marks in columns:
                words = (text or b"").split()
                groups: dict[tuple, list[int]] = defaultdict(list)
                for mark in marks:
                    groups[mark["shard"], int(mark["owner"] != own)].append(mark["place"])
                for (shard, kind), places in groups.items():
                    places.sort()
                    begin = 0
                    for i, place in enumerate(places):
                        if i + 1 == len(places) or places[i + 1] - (window - size) > place + window - size:
                            first, past = max(0, places[begin] - (window - size)), place + window
                            rows.append(
                                {
                                    "shard": shard, "kind": kind, "id": own, "key": key, "at": first,
                                    "words": b" ".join(words[first:past]), "places": places[begin : i + 1],
                                }
                            )
                            begin = i + 1
            yield from pa.Table.from_pylist(rows, schema).to_batches()

    return plans.mapInArrow(run, PASSAGE)


MATCHED = f"id long, key long, spans {SPANS}, starts array<int>, highs array<long>, lows array<long>"


def match(window: int, size: int):
    """Per task: build each shard's automaton from its reference rows, then stream the other rows through it."""

    def open_windows(words: Words, places: list[int], matched: np.ndarray) -> np.ndarray:
        """Starts of the windows that have one of the landmarks and no match."""
        runs = run_hashes(words.hashes, size)
        marked = np.full(len(runs), (1 << 64) - 1, np.uint64)
        marked[places] = runs[places]
        width = window - size + 1
        own = sliding(marked, width, np.minimum) == sliding(runs, width, np.minimum)
        own[matched] = False
        return np.flatnonzero(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("id", pa.int64()), ("key", pa.int64()),
                ("spans", pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))),
                ("starts", pa.list_(pa.int32())), ("highs", pa.list_(pa.int64())), ("lows", pa.list_(pa.int64())),
            ]
        )
        shard, automaton = None, SuffixAutomaton()
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if (row["shard"], row["salt"]) != shard:
                    shard, automaton = (row["shard"], row["salt"]), SuffixAutomaton()
                words = row["words"].split()
                if row["kind"] == 0:
                    automaton.add(words, row["id"])
                    continue
                found = np.array(automaton.repeats(words, row["id"], window), np.int64)
                hashed = tokenised([row["words"]])
                left = open_windows(hashed, [p - row["at"] for p in row["places"]], found)
                edges = np.flatnonzero(np.diff(found) > window) if len(found) else found
                firsts = found[np.concatenate(([0], edges + 1))] if len(found) else found
                lasts = found[np.append(edges, len(found) - 1)] if len(found) else found
                out.append(
                    {
                        "id": row["id"], "key": row["key"],
                        "spans": [
                            {"first": a, "past": b}
                            for a, b in zip((firsts + row["at"]).tolist(), (lasts + row["at"] + window).tolist(), strict=True)
                        ],
                        "starts": (left + row["at"]).tolist(),
                        "highs": signed(run_hashes(hashed.hashes, window)[left]).tolist(),
                        "lows": signed(run_hashes(hashed.hashes, window, OTHERS)[left]).tolist(),
                    }
                )
            yield from pa.Table.from_pylist(out, schema).to_batches()

    return run


def repeated_spans(rows: DataFrame, texts: DataFrame, window: int, size: int) -> DataFrame:
    """Spans of words (id, key, spans) that a document with a smaller id has, for rows whose text is no whole copy.

    1. Documents that share a landmark meet at its owner, the smallest id that has it. The owner's words around
       its landmarks are the reference; they are dealt to shards of bounded size, and a shard that many documents
       ask for is repeated for each salt of them. What others have around the landmark is matched against it.
    2. A window that differs from its owner's may still equal one of another document. Such windows had the same
       owner and stayed open on both sides, so they are compared among themselves, by 128 bits of hash.
    """
    marks = rows.select("id", "key", F.inline(F.arrays_zip("hashes", "places"))).withColumnRenamed("hashes", "hash")
    shared = written(
        marks.groupBy("hash")
        .agg(F.min("id").alias("owner"), F.max("id").alias("last"), F.min_by("places", "id").alias("place"))
        .where("owner < last")
        .select("hash", "owner", F.floor(F.col("place") / HOME_WORDS).alias("home"))
    )
    # A landmark has its share of the words: neighbours overlap.
    stretch = (window - size + 2) // 2
    shards = max(1, -(-shared.count() * stretch // SHARD_WORDS))
    shared = shared.select("hash", "owner", F.pmod(F.xxhash64("owner", "home"), F.lit(shards)).alias("shard"))
    meeting = marks.join(shared, "hash").select("id", "key", F.struct("shard", "owner", F.col("places").alias("place")).alias("mark"))
    plans = meeting.groupBy("id", "key").agg(F.collect_list("mark").alias("marks"))
    cut = written(passages(texts.join(plans, ["id", "key"]), shards, window, size))
    probes = cut.where("kind = 1").drop("kind")
    loads = probes.groupBy("shard").agg(F.sum(F.size("places")).alias("load"))
    reference, probes = salted(cut.where("kind = 0").drop("kind"), probes, loads, PROBES_PER_TASK)
    columns = ["shard", "salt", "kind", "id", "key", "at", "words", "places"]
    dealt = beside(reference, probes, ["shard", "salt"], ["id"]).select(*columns)
    matched = written(dealt.mapInArrow(match(window, size), MATCHED))
    spans = matched.where(F.size("spans") > 0).select("id", "key", "spans")
    # Step 2.
    left = matched.select("id", "key", F.inline(F.arrays_zip("starts", "highs", "lows")))
    ends = [F.min("id").alias("first_id"), F.max("id").alias("last_id")]
    twins = left.groupBy("highs", "lows").agg(*ends).where("first_id < last_id").drop("last_id")
    more = left.join(twins, ["highs", "lows"]).where("first_id < id")
    span = F.array(F.struct(F.col("starts").alias("first"), (F.col("starts") + window).cast("int").alias("past")))
    return spans.unionByName(more.select("id", "key", span.alias("spans")))


CLEAN = "id long, key long, n_removed long, kept_sha256 string"


def strip(cut: DataFrame, with_text: bool) -> DataFrame:
    """Take the words in spans out of each text (id, key, text, spans)."""
    schema = pa.schema(
        [("id", pa.int64()), ("key", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
        + [("text", pa.string())] * with_text
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for own, key, text, spans in zip(
                batch.column("id").to_pylist(), batch.column("key").to_pylist(), texts_of(batch),
                batch.column("spans").to_pylist(), strict=True,
            ):
                words, kept, at = (text or b"").split(), [], 0
                for span in sorted(spans or (), key=lambda s: s["first"]):
                    kept += words[at : span["first"]]
                    at = max(at, span["past"])
                kept += words[at:]
                joined = b" ".join(kept)
                row = {
                    "id": own, "key": key, "n_removed": len(words) - len(kept),
                    "kept_sha256": hashlib.sha256(joined).hexdigest(),
                }
                rows.append(row | ({"text": joined.decode("utf-8", "replace")} if with_text else {}))
            yield from pa.Table.from_pylist(rows, schema).to_batches()

    return cut.mapInArrow(run, CLEAN + ", text string" * with_text)


def dedup_substrings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    landmark: int = LANDMARK,
    with_text: bool = True,
) -> DataFrame:
    """Each document without the words of runs of ``window`` or more that a document with a smaller id has.

    Words are ``[^\\x20\\x09-\\x0D]+``. All windows are judged on the input. A whole copy of a smaller document's
    words loses all of them at once, if it is long enough to have a window; the rest goes through
    ``repeated_spans``. Null and empty text have no words; a null id counts as one document after all others; rows
    that share an id are one document and do not repeat each other. An empty table gives no rows; other columns are
    not read. Returns doc_id, n_words, n_removed, kept_sha256 and, if asked for, text (kept words, one space apart).
    """
    text = F.col(text_col)
    texts = docs.select(id_or_last(id_col).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"), text.alias("text"))
    rows = written(profiles(texts, window, landmark))
    firsts = rows.groupBy("digest").agg(F.min("id").alias("first_id"))
    rows = rows.join(firsts, "digest").withColumn("copy", (F.col("first_id") < F.col("id")) & (F.col("n_words") >= window))
    spans = repeated_spans(rows.where("first_id = id"), texts, window, landmark)
    if with_text:
        whole = F.array(F.struct(F.lit(0).alias("first"), F.col("n_words").cast("int").alias("past")))
        spans = spans.unionByName(rows.where("copy").select("id", "key", whole.alias("spans")))
    spans = spans.groupBy("id", "key").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    # Rows that repeat id and text give the same row here.
    done = strip(texts.join(spans, ["id", "key"], "left" if with_text else "inner"), with_text)
    done = done.dropDuplicates(["id", "key"])
    rows = rows.select("id", "key", "n_words", "digest", "copy").join(done, ["id", "key"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return rows.select(
        F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id"),
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(F.col("copy"), nothing).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
        *["text"] * with_text,
    )
