"""Benchmark passages in training documents, by a stored positional inverted index."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.tables import LAST_ID
from tideline.llm.words import ALPHANUMERIC, in_blocks, texts_of, tokenised
from tideline.session import stored

WINDOW = 13
#: A document is contaminated if at least one word in so many is hit.
SHARE = 20
#: Text bytes indexed together, and words of test items searched together.
SEGMENT_BYTES, BLOCK_WORDS = 2 << 20, 200_000

INDEX = "first_row long, ids binary, counts binary, terms binary, starts binary, positions binary"


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store the postings of every word of every document, segment by segment.

    A segment holds some neighbouring documents: their ids and word counts, the sorted distinct terms (64-bit
    hashes of the lower-cased words) and for each term the sorted positions where it stands. Positions run through
    the whole segment with a gap after each document, so neighbours in a phrase are of one document.
    """

    def segment(first_row: int, ids: list, texts: list) -> dict:
        words = tokenised(texts, ALPHANUMERIC, lower=True)
        order = np.argsort(words.hashes, kind="stable")
        terms, starts = np.unique(words.hashes[order], return_index=True)
        places = np.arange(len(order)) + np.repeat(np.arange(len(texts)), words.counts())
        return {
            "first_row": first_row,
            "ids": np.array([LAST_ID if i is None else i for i in ids], np.int64).tobytes(),
            "counts": words.counts().astype(np.int64).tobytes(),
            "terms": terms.tobytes(),
            "starts": np.append(starts, len(order)).astype(np.int64).tobytes(),
            "positions": places[order].astype(np.int32).tobytes(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), texts_of(batch)
            for part in in_blocks(texts, SEGMENT_BYTES):
                yield pa.RecordBatch.from_pylist([segment(row, ids[part], texts[part])])
                row += part.stop - part.start

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return stored(rows.mapInArrow(run, INDEX))


class Segment:
    """One stored segment, read."""

    def __init__(self, row: dict):
        self.first_row = row["first_row"]
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.starts = np.frombuffer(row["starts"], np.int64)
        self.positions = np.frombuffer(row["positions"], np.int32)
        self.begins = np.concatenate(([0], np.cumsum(np.frombuffer(row["counts"], np.int64) + 1)))

    def lists(self, terms: np.ndarray) -> list[np.ndarray]:
        """The positions of each of some terms."""
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        known = self.terms[at] == terms if len(self.terms) else np.zeros(len(terms), bool)
        none = self.positions[:0]
        return [
            self.positions[a:b] if k else none
            for k, a, b in zip(known.tolist(), self.starts[at].tolist(), self.starts[at + 1].tolist(), strict=True)
        ] if len(self.terms) else [none] * len(terms)


class Phrases:
    """The windows of some test items: each different one once, with the items that have it."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]], window: int = WINDOW):
        owners: dict[bytes, set] = defaultdict(set)
        for item, words in items:
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                owners[words[i : i + size].tobytes()].add(item)
        windows = [np.frombuffer(w, np.uint64) for w in owners]
        self.items = [sorted(o, key=str) for o in owners.values()]
        self.terms = np.unique(np.concatenate(windows)) if windows else np.zeros(0, np.uint64)
        self.windows = [np.searchsorted(self.terms, w) for w in windows]

    def found(self, segment: Segment, slop: int = 0) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(window number, start positions, exact) of all occurrences in a segment.

        A window's lists are taken from the rarest term on. Each is moved by the term's offset, so equal numbers
        in two lists are the same start, and what the lists have in common gets smaller with each term.
        With ``slop``, also the places where the rarest three terms stand up to ``slop`` words from where an
        exact phrase would have them.
        """
        lists = segment.lists(self.terms)
        rarity = np.array([len(x) for x in lists], np.int64)
        for number, window in enumerate(self.windows):
            lengths = rarity[window]
            order = np.argsort(lengths, kind="stable").tolist()
            if lengths[order[0]]:
                exact = rarest = lists[window[order[0]]] - order[0]
                for offset in order[1:]:
                    exact = common(exact, lists[window[offset]], offset)
                    if not len(exact):
                        break
                if len(exact):
                    yield number, exact, True
                if slop and len(window) > 3:
                    near = rarest
                    for offset in order[1:3]:
                        near = near[close(near + offset, lists[window[offset]], slop)]
                    near = np.setdiff1d(near, exact)
                    if len(near):
                        yield number, near, False


def common(starts: np.ndarray, positions: np.ndarray, offset: int) -> np.ndarray:
    """The starts that have ``offset`` words on one of the positions."""
    wanted = starts + offset
    at = np.searchsorted(positions, wanted)
    at[at == len(positions)] = 0
    return starts[positions[at] == wanted] if len(positions) else starts[:0]


def close(wanted: np.ndarray, positions: np.ndarray, slop: int) -> np.ndarray:
    """Whether some position is within ``slop`` of each wanted one."""
    return np.searchsorted(positions, wanted - slop) < np.searchsorted(positions, wanted + slop, "right")


def merged_spans(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    starts = np.unique(starts)
    new = np.concatenate(([True], np.diff(starts) > length))
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(starts)) - 1
    return list(zip(starts[firsts].tolist(), (starts[lasts] + length).tolist(), strict=True))


MATCHES = "row long, item string, exact boolean, spans array<struct<first:int,past:int>>"


def search(index: DataFrame, phrases: Phrases, slop: int = 0) -> DataFrame:
    """Every document and item with a common window: the words it covers, first to past the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("row", pa.int64()), ("item", pa.string()), ("exact", pa.bool_()),
                ("spans", pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))),
            ]
        )
        for batch in batches:
            for i in range(batch.num_rows):
                segment = Segment(batch.slice(i, 1).to_pylist()[0])
                hits: dict[tuple, dict[int, list]] = defaultdict(lambda: defaultdict(list))
                for number, starts, exact in phrases.found(segment, slop):
                    docs = np.searchsorted(segment.begins, starts, "right") - 1
                    for doc in np.unique(docs).tolist():
                        local = starts[docs == doc] - segment.begins[doc]
                        for item in phrases.items[number]:
                            hits[doc, item, exact][len(phrases.windows[number])].append(local)
                rows = [
                    {
                        "row": segment.first_row + doc,
                        "item": "null" if item is None else str(item),
                        "exact": exact,
                        "spans": [
                            {"first": max(a, 0), "past": b}
                            for length, lists in by_length.items()
                            for a, b in merged_spans(np.concatenate(lists), length)
                        ],
                    }
                    for (doc, item, exact), by_length in hits.items()
                ]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return index.select("first_row", "counts", "terms", "starts", "positions").mapInArrow(run, MATCHES)


def item_blocks(items: DataFrame, id_col: str, text_col: str, window: int) -> Iterator[Phrases]:
    """The test items in blocks of about BLOCK_WORDS words, read one after the other."""
    block, words = [], 0
    for row in items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).toLocalIterator():
        hashes = tokenised([(row["text"] or "").encode()], ALPHANUMERIC, lower=True).hashes
        block.append((row["id"], hashes))
        words += len(hashes)
        if words >= BLOCK_WORDS:
            yield Phrases(block, window)
            block, words = [], 0
    if block:
        yield Phrases(block, window)


def document_rows(index: DataFrame) -> DataFrame:
    """row, id and n_words of each indexed document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, counts = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["counts"], np.int64)
                rows = np.arange(len(ids)) + row["first_row"]
                yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(ids), pa.array(counts)], ["row", "id", "n_words"])

    rows = index.select("first_row", "ids", "counts").mapInArrow(run, "row long, id long, n_words long")
    return rows.withColumn("id", F.when(F.col("id") != LAST_ID, F.col("id")))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    share: int = SHARE,
    index: DataFrame | None = None,
) -> DataFrame:
    """How much of each document stands in test items.

    Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased. An item's windows are its
    runs of ``window`` words, or the whole item if it is shorter. Document words inside any occurrence are hit. The
    items are the stated query set: they are read in blocks of bounded size, each searched against the whole index.

    Null or empty text has no words and is never hit, nor hits; items with the same id are one item, and a null id
    is listed as ``null``. Repeated rows get a row each. Empty tables are fine on both sides; other columns are not
    read. Returns doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items (sorted as text).
    """
    index = build_index(docs, id_col, text_col) if index is None else index
    found = None
    for phrases in item_blocks(items, item_col, item_text_col, window):
        matches = search(index, phrases)
        found = matches if found is None else found.unionByName(matches)
    rows = document_rows(index)
    if found is None:
        hits = rows.select("row").limit(0).withColumns({"items": F.array().cast("array<string>"), "n_hit": F.lit(0)})
    else:
        # A document's spans in order: each adds what lies past the furthest end so far.
        start = F.struct(F.lit(0).alias("past"), F.lit(0).cast("long").alias("n"))

        def add(state, span):
            fresh = F.greatest(span["past"] - F.greatest(span["first"], state["past"]), F.lit(0))
            return F.struct(
                F.greatest(state["past"], span["past"]).alias("past"), (state["n"] + fresh).alias("n")
            )

        spans = F.sort_array(F.flatten(F.collect_list("spans")))
        hits = found.groupBy("row").agg(
            F.sort_array(F.collect_set("item")).alias("items"), F.aggregate(spans, start, add)["n"].alias("n_hit")
        )
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    listed = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return rows.join(hits, "row", "left").select(
        F.col("id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
        listed.alias("items"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns, whatever their names.

    The verdict is one on the text alone, so repeated rows and rows of one id are judged each by its text, and ids may be
    null. Null and empty texts are never contaminated and stay. Without items all rows stay; no rows give none.
    """
    text = F.col(text_col)
    keyed = docs.select(F.struct("*").alias("row"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("id"), text.alias("text"))
    verdicts = contamination(keyed.select("id", "text"), items, id_col="id", text_col="text", **options)
    bad = verdicts.where("contaminated").select(F.col("doc_id").alias("id")).distinct()
    return keyed.join(bad, "id", "left_anti").select("row.*")
