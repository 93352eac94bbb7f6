"""A quality classifier: regularised quadratic discriminant analysis over transformed document statistics.

Each document becomes a short vector of statistics. Two Gaussians, one per label, are fitted from sums that Spark
forms in one grouped aggregation, so training reads every labelled row and the driver holds one row per label. A
class covariance is shrunk towards that of both classes by the number of its rows. A score is the difference of the
two log densities, read off Mahalanobis distances by Cholesky factors that are made once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.tables import written
from tideline.llm.words import byte_table, in_blocks, run_hashes, texts_of, tokenised

#: The statistics, in the order of the vector.
NAMES = [
    "words", "word_length", "word_spread", "upper", "digits", "symbols", "stops", "commas",
    "variety", "commonest", "marked_words", "line_length", "repeated_runs", "longest_word",
]
#: Neighbouring words of a run that counts as repeated.
RUN_WORDS = 4
#: Rows that the covariance of both classes counts for in each class, per statistic.
STRENGTH = 4.0
#: Share of the common variances that is added to every variance; keeps constant statistics harmless.
RIDGE = 0.1
LEAST_VARIANCE = 1e-6

ASCII_SPACE = byte_table(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)
#: Letters of any case, digits, upper case, closing stops, commas and quotes, what else is ASCII and visible.
KINDS = {
    "letters": byte_table(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0xC0),
    "upper": byte_table(lambda b: 0x41 <= b <= 0x5A),
    "digits": byte_table(lambda b: 0x30 <= b <= 0x39),
    "stops": byte_table(lambda b: chr(b) in ".!?"),
    "commas": byte_table(lambda b: chr(b) in ",;:'\"-()"),
    "symbols": byte_table(lambda b: 0x21 <= b <= 0x7E and not chr(b).isalnum() and chr(b) not in ".!?,;:'\"-()"),
    "visible": byte_table(lambda b: not (0x80 <= b <= 0xBF or b == 0x20 or 0x09 <= b <= 0x0D)),
    "lines": byte_table(lambda b: b == 0x0A),
}


def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The arcsine of a share's square root, whose variance hardly depends on the share; a few more in the whole
    keep the shares of very short texts from the extremes."""
    return np.arcsin(np.sqrt(part / (whole + 5)))


def repeats(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per owner, how many different hashes it has and how often the commonest occurs."""
    keys = np.sort((owner.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(keys)))
    whose = (keys[first] >> np.uint64(44)).astype(np.int64)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, whose, times)
    return np.bincount(whose, minlength=n), most


def statistics(texts: list[bytes | None]) -> np.ndarray:
    """The vectors of some texts; null counts as empty."""
    n, words = len(texts), tokenised(texts)
    sizes = np.fromiter((len(t or b"") for t in texts), np.int64, n)
    ends = np.cumsum(sizes + 1)
    begins = ends - sizes - 1

    def count(kind: str) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(KINDS[kind][words.data], dtype=np.int64)))
        return sums[ends - 1] - sums[begins]

    c = {kind: count(kind) for kind in KINDS}
    owner = np.repeat(np.arange(n), words.counts())
    lengths = (words.ends - words.starts).astype(np.float64)
    total = words.counts().astype(np.float64)
    at_least_one = np.maximum(total, 1)
    mean = np.bincount(owner, lengths, n) / at_least_one
    square = np.bincount(owner, lengths * lengths, n) / at_least_one
    longest = np.zeros(n)
    np.maximum.at(longest, owner, lengths)
    different, most = repeats(words.hashes, owner, n)
    # Words with a symbol in them or at their end.
    symbol = np.concatenate(([0], np.cumsum(KINDS["symbols"][words.data], dtype=np.int64)))
    marked = np.bincount(owner, symbol[words.ends] > symbol[words.starts], n)
    whole = words.last_start(RUN_WORDS)
    run_owner = owner[: len(whole)][whole]
    runs = np.bincount(run_owner, minlength=n)
    different_runs, _ = repeats(run_hashes(words.hashes, RUN_WORDS)[whole], run_owner, n)
    return np.column_stack(
        [
            np.log1p(total),
            np.log1p(mean),
            np.log1p(np.sqrt(np.maximum(square - mean * mean, 0))),
            share(c["upper"], np.maximum(c["letters"], c["upper"])),
            share(c["digits"], c["visible"]),
            share(c["symbols"], c["visible"]),
            share(c["stops"], c["visible"]),
            share(c["commas"], c["visible"]),
            np.log1p(different) / np.log1p(at_least_one),
            share(most, total),
            share(marked, total),
            np.log1p(c["visible"] / (c["lines"] + 1)),
            share(runs - different_runs, runs),
            np.log1p(longest),
        ]
    )


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and x (the vector) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = rows.select("id", F.lit(None).cast("array<double>").alias("x")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            for block in in_blocks(texts):
                x = statistics(texts[block])
                bounds = pa.array(np.arange(0, x.size + 1, len(NAMES), dtype=np.int32))
                vectors = pa.ListArray.from_arrays(bounds, pa.array(x.ravel()))
                ids = batch.column(0).slice(block.start, block.stop - block.start)
                yield pa.RecordBatch.from_arrays([ids, vectors], names=["id", "x"])

    return rows.mapInArrow(run, schema)


@dataclass
class Discriminant:
    """Per label the log prior, the mean, the inverse Cholesky factor and the log determinant."""

    log_prior: np.ndarray
    mean: np.ndarray
    factor: np.ndarray
    log_det: np.ndarray

    @staticmethod
    def fit(n: np.ndarray, sums: np.ndarray, products: np.ndarray, strength: float = STRENGTH, ridge: float = RIDGE):
        """From each label's row count, sums of the statistics and sums of their products."""
        size = sums.shape[1]
        mean = sums / n[:, None]
        scatter = products - n[:, None, None] * mean[:, :, None] * mean[:, None, :]
        common = scatter.sum(0) / n.sum()
        weight = strength * size
        cov = (scatter + weight * common) / (n + weight)[:, None, None]
        cov += np.diag(ridge * np.diag(common) + LEAST_VARIANCE)
        lower = np.linalg.cholesky(cov)
        log_det = 2 * np.log(np.diagonal(lower, axis1=1, axis2=2)).sum(1)
        return Discriminant(np.log(n / n.sum()), mean, np.linalg.inv(lower), log_det)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """How likely the label is 1."""
        logs = []
        for k in (0, 1):
            z = (x - self.mean[k]) @ self.factor[k].T
            logs.append(self.log_prior[k] - 0.5 * (self.log_det[k] + (z * z).sum(1)))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fitted(rows: DataFrame, label: str = "label") -> Discriminant | float:
    """The discriminant of rows with a vector and a label 0 or 1; a constant score if a label has no row."""
    size = len(NAMES)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    at = lambda i: F.get("x", F.lit(i))
    found = {
        row[label]: row
        for row in rows.groupBy(label)
        .agg(
            F.count("*").alias("n"),
            F.array(*[F.sum(at(i)) for i in range(size)]).alias("sums"),
            F.array(*[F.sum(at(i) * at(j)) for i, j in pairs]).alias("products"),
        )
        .collect()
    }
    if len(found) < 2:
        return float(*found) if found else 0.5
    products = np.zeros((2, size, size))
    for k in (0, 1):
        for (i, j), value in zip(pairs, found[k]["products"]):
            products[k, i, j] = products[k, j, i] = value
    return Discriminant.fit(
        np.array([found[k]["n"] for k in (0, 1)], float), np.array([found[k]["sums"] for k in (0, 1)]), products
    )


def held_out(id_col: str, folds: int = 3, fold: int = 1) -> Column:
    """Rows that nothing is learnt from; a null id counts as empty."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(folds)) == fold


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """id, held_out, score and predicted of every row of ``docs``.

    Learns from the rows that are not held out and whose id has a label 0 or 1 in ``labels``; of repeated equal
    labels of an id one counts, and an id with both labels counts once for each. Repeated rows get equal scores, null
    text counts as empty, and a null id has no label. The score depends on the text alone. Without rows of both
    labels all scores are the one label there is, or 0.5. An empty table gives no rows; other columns are ignored.
    """
    made = written(features(docs, id_col, text_col))
    known = labels.where(F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")
    )
    model = fitted(made.where(~held_out("id")).join(known.distinct(), "id"))
    schema = made.select("id", held_out("id").alias("held_out"), F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(2).flatten()).reshape(-1, len(NAMES))
            score = np.full(len(x), model) if isinstance(model, float) else model.scores(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], names=schema.names)

    scored = made.select("id", held_out("id").alias("held_out"), "x").mapInArrow(run, schema)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
