"""Language-model scores of documents by a hashed maximum-entropy model with class-factored softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.tables import LAST_ID, beside, grouped, written
from tideline.llm.words import Words, in_blocks, signed, texts_of, tokenised

#: Classes: the end, the commonest words one each, the commonest word endings one each, other endings by hash.
WORD_CLASSES, TAIL_CLASSES, HASH_CLASSES = 47, 64, 16
CLASSES = 1 + WORD_CLASSES + TAIL_CLASSES + HASH_CLASSES
#: The third word back counts as one of so many groups of classes.
GROUPS = 8
CONTEXTS = CLASSES * CLASSES * GROUPS
#: Rows of the hashed weight table, gradient steps, and their tasks: few, as each gets the whole table in each step, and
#: the contexts are bounded in number.
BUCKETS, STEPS, GRADIENT_TASKS = 1 << 13, 12, 4
#: Counts that hold each weight back.
PULL = 5.0
#: Words whose counts every task has, at most; the others are looked up by a join.
HOT_WORDS = 1 << 17
#: Tokens counted together; a worker holds about 80 bytes for each.
CHUNK_TOKENS = 1 << 20
END = np.uint64(0x5D1E6F3A9B7C2481)
#: Endings are the last two bytes of a word; the end has a number of its own.
END_TAIL, TAILS = 1 << 16, (1 << 16) + 1
#: Parts that the weight table is kept in.
SLICES = 8


def held_out(id_column: Column) -> Column:
    """Whether crc32 of the id as text is 2 modulo 7; a null id is empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 7 == 2


@dataclass
class Tokens:
    """Words of some texts, each followed by an end: hash, ending (``END_TAIL`` for the end), and where each text begins."""

    hashes: np.ndarray
    tails: np.ndarray
    first: np.ndarray


def with_ends(words: Words) -> Tokens:
    n, at = len(words.first) - 1, words.first[1:]
    last = words.data[words.ends - 1].astype(np.int64)
    before = np.where(words.ends - words.starts > 1, words.data[np.maximum(words.ends - 2, 0)], 0).astype(np.int64)
    return Tokens(
        np.insert(words.hashes, at, END), np.insert(before * 256 + last, at, END_TAIL), words.first + np.arange(n + 1)
    )


def token_blocks(bodies: list[bytes | None]) -> Iterator[tuple[slice, Tokens]]:
    for part in in_blocks(bodies):
        yield part, with_ends(tokenised(bodies[part], lower=True))


def chunked(batches: Iterator[pa.RecordBatch], value) -> Iterator[np.ndarray]:
    """``value`` of the tokens of all texts of a task, in chunks of about CHUNK_TOKENS."""
    held, size = [], 0
    for batch in batches:
        for _, tokens in token_blocks(texts_of(batch)):
            held.append(value(tokens))
            size += len(tokens.hashes)
            if size >= CHUNK_TOKENS:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, tail, n) of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.dtype([("word", np.uint64), ("tail", np.int64)])

        def value(tokens: Tokens) -> np.ndarray:
            out = np.empty(len(tokens.hashes), pairs)
            out["word"], out["tail"] = tokens.hashes, tokens.tails
            return out

        for chunk in chunked(batches, value):
            order = np.argsort(chunk["word"], kind="stable")
            words, at, n = np.unique(chunk["word"][order], return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(words)), pa.array(chunk["tail"][order][at]), pa.array(n)], ["word", "tail", "n"]
            )

    counts = texts.select("text").mapInArrow(run, "word long, tail long, n long")
    return written(counts.groupBy("word").agg(F.max("tail").alias("tail"), F.sum("n").alias("n")))


@dataclass
class Vocabulary:
    """What every task knows of the words: counts of the common ones and the classes."""

    words: np.ndarray  # common words, sorted
    counts: np.ndarray
    own: np.ndarray  # their own class, 0 if none
    tails: np.ndarray  # class of each ending
    total: int
    distinct: int
    #: Tokens and words of each class.
    class_tokens: np.ndarray
    class_words: np.ndarray

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, known) of words among the common ones."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        return at, self.words[at] == hashes

    def classes(self, tokens: Tokens, at: np.ndarray, known: np.ndarray) -> np.ndarray:
        classes = self.tails[tokens.tails]
        if len(self.words):
            own = np.where(known, self.own[at], 0)
            classes = np.where(own > 0, own, classes)
        return np.where(tokens.hashes == END, 0, classes)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals, the common words and the classes, all of bounded size."""
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    # The least count that leaves no more than HOT_WORDS words, found on a histogram.
    step = F.floor(F.log2("n") * 8).cast("int")
    histogram = counts.groupBy(step.alias("step")).agg(F.count("*").alias("v")).orderBy(F.desc("step")).collect()
    least, room = None, HOT_WORDS
    for row in histogram:
        room -= row["v"]
        if room < 0:
            break
        least = row["step"]
    hot = counts.where(step >= least if least is not None else F.lit(False)).select("word", "n", "tail").toArrow()
    word, n, tail = (hot[c].to_numpy().astype(np.int64) for c in ("word", "n", "tail"))
    word = word.view(np.uint64)
    order = np.argsort(word)
    word, n, tail = word[order], n[order], tail[order]
    own = np.zeros(len(word), np.int64)
    best = np.lexsort((word, -n))
    best = best[word[best] != END][:WORD_CLASSES]
    own[best] = 1 + np.arange(len(best))
    tails = np.zeros((TAILS, 2), np.int64)
    per_tail = counts.groupBy("tail").agg(F.sum("n").alias("n"), F.count("*").alias("v")).toArrow()
    tails[per_tail["tail"].to_numpy()] = np.column_stack([per_tail["n"].to_numpy(), per_tail["v"].to_numpy()])
    tails[END_TAIL] = 0  # the end is no word of a class
    np.subtract.at(tails, tail[best], np.stack([n[best], np.ones(len(best), np.int64)], 1))
    common = np.lexsort((np.arange(END_TAIL), -tails[:END_TAIL, 0]))[:TAIL_CLASSES]
    classes = 1 + WORD_CLASSES + TAIL_CLASSES + (np.arange(TAILS) * 40503 >> 8) % HASH_CLASSES
    classes[common] = 1 + WORD_CLASSES + np.arange(TAIL_CLASSES)
    return Vocabulary(
        word, n, own, classes, totals["n"] or 0, totals["v"],
        np.bincount(classes, tails[:, 0], CLASSES), np.bincount(classes, tails[:, 1], CLASSES),
    )


def contexts(classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """What stands before each token: classes of the last two words and the group of the third; the end before the text."""
    back = []
    for distance in (1, 2, 3):
        shifted = np.zeros_like(classes)
        shifted[distance:] = classes[:-distance]
        # A text's first tokens have nothing before them.
        starts = (first[:-1, None] + np.arange(distance)).ravel()
        ends = np.repeat(first[1:], distance)
        shifted[starts[starts < ends]] = 0
        back.append(shifted)
    return (back[0] * CLASSES + back[1]) * GROUPS + back[2] * 7 % GROUPS


def context_counts(texts: DataFrame, known: Vocabulary) -> DataFrame:
    """(context, class, n) of all texts; there are at most ``CONTEXTS * CLASSES`` rows, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def value(tokens: Tokens) -> np.ndarray:
            classes = known.classes(tokens, *known.places(tokens.hashes))
            return (contexts(classes, tokens.first) * CLASSES + classes).astype(np.int32)

        for chunk in chunked(batches, value):
            cells, n = np.unique(chunk, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n)], ["cell", "n"])

    cells = texts.select("text").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    return written(cells.select(F.expr(f"cell div {CLASSES}").cast("int").alias("context"), F.expr(f"cell % {CLASSES}").alias("class"), "n"))


def feature_rows(context: np.ndarray) -> list[np.ndarray]:
    """The rows of the weight table that are active in each context, one array for each kind of feature."""
    one, rest = context // (CLASSES * GROUPS), context % (CLASSES * GROUPS)
    two, three = rest // GROUPS, rest % GROUPS
    kinds = (
        np.zeros_like(context),  # always
        one,  # the last word
        two,  # skip: the word before it
        three,  # skip: the third word back
        one * CLASSES + two,  # the last two words
        one * GROUPS + three,  # skip: the last and the third
    )
    out = []
    for kind, value in enumerate(kinds):
        x = (value.astype(np.uint64) + np.uint64(kind << 40)) * np.uint64(0x9E3779B97F4A7C15)
        out.append(((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64))
    return out


def log_softmax(weights: np.ndarray, context: np.ndarray) -> np.ndarray:
    """log P(class | context) for each context."""
    scores = sum(weights[rows] for rows in feature_rows(context))
    scores -= scores.max(1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(1, keepdims=True))


def feature_sums(context: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Rows of ``table``, one for each context, added up by the context's features."""
    out = np.zeros((BUCKETS, CLASSES), np.float32)
    for rows in feature_rows(context):
        order = np.argsort(rows, kind="stable")
        names, starts = np.unique(rows[order], return_index=True)
        out[names] += np.add.reduceat(table[order], starts)
    return out


def in_slices(table: np.ndarray) -> pa.RecordBatch:
    """A weight-shaped table as one row per slice."""
    parts = [part.astype(np.float32).tobytes() for part in np.split(table, SLICES)]
    return pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], names=["slice", "sums"])


def slice_of(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.float32).reshape(BUCKETS // SLICES, CLASSES)


def seen_sums(cells: DataFrame) -> DataFrame:
    """(slice, sums): how often each weight's feature and class were seen together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                context, number = np.unique(np.asarray(batch.column(0)), return_inverse=True)
                seen = np.zeros((len(context), CLASSES), np.float32)
                np.add.at(seen, (number, np.asarray(batch.column(1))), np.asarray(batch.column(2)))
                own = feature_sums(context.astype(np.int64), seen)
                total = own if total is None else total + own
        if total is not None:
            yield in_slices(total)

    return cells.select("context", "class", "n").mapInArrow(run, "slice int, sums binary")


def expected_sums(totals: DataFrame, weights: DataFrame) -> DataFrame:
    """(slice, sums): how often the model expects each, with some of the contexts in each task and all weights."""
    copies = weights.select("slice", "sums", F.explode(F.sequence(F.lit(0), F.lit(GRADIENT_TASKS - 1))).alias("task"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, ["task"]):
            table, context, n = np.zeros((BUCKETS, CLASSES), np.float32), [], []
            for row in rows:
                if row["kind"] == 0:
                    at = row["slice"] * (BUCKETS // SLICES)
                    table[at : at + BUCKETS // SLICES] = slice_of(row["sums"])
                else:
                    context.append(row["context"])
                    n.append(row["n"])
            total = np.zeros((BUCKETS, CLASSES), np.float32)
            for begin in range(0, len(context), 4096):
                part = np.array(context[begin : begin + 4096], np.int64)
                likely = np.exp(log_softmax(table, part)) * np.array(n[begin : begin + 4096], np.float32)[:, None]
                total += feature_sums(part, likely)
            yield in_slices(total)

    return beside(copies, totals, ["task"], ["slice", "context"]).mapInArrow(run, "slice int, sums binary")


def train(cells: DataFrame, steps: int = STEPS) -> np.ndarray:
    """Weights of the class model, by gradient steps over all contexts of the corpus.

    All of it stays in Spark: a task has some of the contexts and adds up what the model expects of each weight; these
    sums meet by slices of the weight table, which is moved on there and stored for the next step. The gradient, seen
    minus expected, is scaled by the expected count of each weight. The driver gets the last table only.
    """
    spark = cells.sparkSession
    task = F.pmod(F.xxhash64("context"), F.lit(GRADIENT_TASKS)).cast("int")
    totals = written(cells.groupBy("context").agg(F.sum("n").alias("n")).withColumn("task", task))
    seen = written(seen_sums(cells))
    weights = spark.range(0, SLICES, 1, 1).mapInArrow(_zeros, "slice int, sums binary")

    def moved(rate: float):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (number,), rows in grouped(batches, ["slice"]):
                sums = np.zeros((3, BUCKETS // SLICES, CLASSES), np.float64)
                for row in rows:
                    sums[row["what"]] += slice_of(row["sums"])
                old, had, expected = sums
                change = (had - expected - PULL * old * 0.01) / (expected + PULL)
                new = old + rate * np.clip(np.where(change > 0, np.log1p(np.maximum(change, 0)), change), -1.5, 1.5)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), pa.array([new.astype(np.float32).tobytes()])], names=["slice", "sums"]
                )

        return run

    for step in range(steps):
        parts = [
            frame.withColumn("what", F.lit(i)) for i, frame in enumerate((weights, seen, expected_sums(totals, weights)))
        ]
        met = parts[0].unionByName(parts[1]).unionByName(parts[2])
        dealt = met.repartition(SLICES, "slice").sortWithinPartitions("slice", "what", "sums")
        weights = written(dealt.mapInArrow(moved(0.6 if step < 3 else 0.4), "slice int, sums binary"))
    table = weights.orderBy("slice").toArrow()
    return np.concatenate([slice_of(x.as_py()) for x in table["sums"]])


def _zeros(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        empty = bytes(BUCKETS // SLICES * CLASSES * 4)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int32()), pa.array([empty] * batch.num_rows, pa.binary())], names=["slice", "sums"]
        )


@lru_cache(maxsize=1)
def class_table(weights: bytes) -> np.ndarray:
    """log10 P(class | context) for all contexts; each Python worker makes it once."""
    table = np.frombuffer(weights, np.float32).reshape(BUCKETS, CLASSES)
    out = np.empty((CONTEXTS, CLASSES), np.float32)
    for begin in range(0, CONTEXTS, 4096):
        part = np.arange(begin, min(begin + 4096, CONTEXTS))
        out[part] = log_softmax(table, part) / np.log(10)
    return out


ROWS = (
    "doc long, kind int, word long, doc_id long, held_out boolean, tokens long, known long, logs double, "
    "free_logs double, class_logs double"
)


def score_rows(texts: DataFrame, known: Vocabulary, weights: np.ndarray) -> DataFrame:
    """A row for each document (kind 0) with all that common words give, and one for each of its other words (kind 1).

    logs adds log10(c + 1) of words known to the task, free_logs the same of words without a class of their own,
    class_logs the class factor and the sizes of the classes.
    """
    packed = weights.tobytes()
    sizes = np.log10(known.class_tokens + known.class_words + 1)
    sizes[: 1 + WORD_CLASSES] = 0
    count_logs = np.log10(known.counts + 1)

    def block(ids, docs, held, tokens: Tokens, table: np.ndarray) -> Iterator[pa.RecordBatch]:
        at, common = known.places(tokens.hashes)
        classes = known.classes(tokens, at, common)
        free = classes > WORD_CLASSES
        logs = np.where(common, count_logs[at], 0.0) if len(count_logs) else np.zeros(len(at))
        class_logs = table[contexts(classes, tokens.first), classes].astype(np.float64) - sizes[classes]
        sums = lambda x: np.add.reduceat(x, tokens.first[:-1])
        n = len(docs)
        yield batch_of(
            docs, np.zeros(n, np.int32), docs, ids, held, np.diff(tokens.first),
            sums(common.astype(np.int64)), sums(logs), sums(np.where(free, logs, 0.0)), sums(class_logs),
        )
        other = np.flatnonzero(~common)
        own = np.repeat(docs, np.diff(tokens.first))[other]
        pairs = np.stack([own, signed(tokens.hashes)[other]], 1)
        order = np.lexsort((pairs[:, 1], pairs[:, 0]))
        pairs = pairs[order]
        new = np.flatnonzero(np.concatenate(([True], (pairs[1:] != pairs[:-1]).any(1)))) if len(pairs) else order
        times = np.diff(np.append(new, len(pairs)))
        zero = np.zeros(len(new))
        yield batch_of(
            pairs[new, 0], np.ones(len(new), np.int32), pairs[new, 1], None, None, times, zero.astype(np.int64), zero, zero, zero
        )

    def batch_of(docs, kinds, words, ids, held, tokens, found, logs, free, by_class) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(docs), pa.array(kinds), pa.array(words),
                pa.nulls(len(docs), pa.int64()) if ids is None else pa.array(ids, pa.int64()),
                pa.nulls(len(docs), pa.bool_()) if held is None else pa.array(held, pa.bool_()),
                pa.array(tokens), pa.array(found), pa.array(logs), pa.array(free), pa.array(by_class),
            ],
            ["doc", "kind", "word", "doc_id", "held_out", "tokens", "known", "logs", "free_logs", "class_logs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = class_table(packed)
        for batch in batches:
            bodies = texts_of(batch)
            ids, held = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist()
            docs = np.asarray(batch.column("doc"))
            for part, tokens in token_blocks(bodies):
                yield from block(ids[part], docs[part], held[part], tokens, table)

    return texts.mapInArrow(run, ROWS)


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", steps: int = STEPS
) -> DataFrame:
    """Each document's log10 probability under a unigram model and under the maximum-entropy model.

    Tokens are words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased) and one end. Both models learn from all documents but
    those held out. The model gives a word its class's probability after the classes before it, from weights of hashed
    n-gram and skip features, times the word's share of its class, where every class keeps room for one unseen word; both
    factors add up to 1. Null text is empty: only the end. A null id is in training. Repeated rows get a row each
    and count each; an empty table gives no rows; other columns are not read.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.monotonically_increasing_id().alias("doc"),
        F.col(id_col).cast("long").alias("doc_id"),
        held_out(F.col(id_col)).alias("held_out"),
        text.alias("text"),
    )
    training = rows.where("NOT held_out")
    counts = word_counts(training)
    known = vocabulary(counts)
    weights = train(context_counts(training, known), steps)
    least = int(known.counts.min()) if len(known.counts) else LAST_ID
    other = counts.where(F.col("n") < least).select("word", "n", F.lit(1).alias("kind"))
    told = score_rows(rows, known, weights).join(other, ["word", "kind"], "left")
    log = F.coalesce(F.log10(F.col("n") + 1), F.lit(0.0)) * F.col("tokens")
    one = F.col("kind") == 1
    sums = told.groupBy("doc").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.sum(F.when(one, 0).otherwise(F.col("tokens"))).alias("n_tokens"),
        F.sum(F.when(one & F.col("n").isNotNull(), F.col("tokens")).otherwise(F.col("known"))).alias("n_known"),
        F.sum(F.when(one, log).otherwise(F.col("logs"))).alias("logs"),
        F.sum(F.when(one, log).otherwise(F.col("free_logs") + F.col("class_logs"))).alias("score"),
    )
    room = F.lit(float(np.log10(known.total + known.distinct + 1)))
    return sums.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * room).alias("base_score"),
        "score",
    )
