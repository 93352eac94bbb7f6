"""Language identification by fusing evidence: text, declared language, address suffix and host."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.reputation import with_address, with_domain
from tideline.llm.tables import written
from tideline.llm.words import LOWER, byte_table, texts_of

#: Three neighbouring bytes, hashed to so many features.
FEATURES = 1 << 12
#: Feature counts or weights, by language or host, that a task holds before it hands them on.
CELLS = 1 << 22
#: A text never counts for more than this many independent features, as neighbouring ones overlap.
STRENGTH = 60.0
#: Rows that a prior counts for in the level below it; cells added to the declared-language table.
PRIOR_ROWS, CELL = 20.0, 0.5
#: The prior of a text in no known language, whose features are all equally likely.
UNKNOWN_PRIOR = 1e-9
UNKNOWN = "und"
MIN_POSTERIOR = 0.5

LETTER = byte_table(lambda b: 0x61 <= b <= 0x7A or b >= 0x80)
TAGS = re.compile(r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>")


def features(text: bytes) -> np.ndarray:
    """Counts of the text's features; the middle byte of each is part of a letter."""
    data = LOWER[np.frombuffer(text, np.uint8)]
    if len(data) < 3:
        data = np.concatenate((np.full(1, 32, np.uint8), data, np.full(2, 32, np.uint8)))
    wide = data.astype(np.uint32)
    codes = (wide[:-2] * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA77) + wide[2:] * np.uint32(0xC2B2AE3D))
    codes = codes ^ (codes >> np.uint32(15))
    codes = (codes * np.uint32(0x2C1B3C6D)) >> np.uint32(20)
    return np.bincount(codes[LETTER[data[1:-1]]], minlength=FEATURES)


def plain(markup: str) -> bytes:
    return html.unescape(TAGS.sub(" ", markup)).encode()


def primary(declared: Column) -> Column:
    """The primary part of a declared language in lower case; null if there is none."""
    part = F.lower(F.regexp_extract(F.coalesce(declared, F.lit("")), r"^\s*([A-Za-z]{2,8})", 1))
    return F.when(part != "", part)


class TextModel:
    """Log likelihoods of features by language, the unknown one last."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.logs = np.full((len(languages) + 1, FEATURES), -np.log(FEATURES), np.float32)
        for i, own in enumerate(counts):
            self.logs[i] = np.log((own + 0.5) / (own.sum(dtype=np.float64) + 0.5 * FEATURES))

    def log_likelihoods(self, text: bytes) -> tuple[np.ndarray, int]:
        counts = features(text)
        n = int(counts.sum())
        return self.logs @ (counts * (STRENGTH / (n + STRENGTH))).astype(np.float32), n


def train(rows: DataFrame, is_markup: bool) -> TextModel:
    """Feature counts of all rows (text, declared) by declared language, however few rows declare it.

    Counts are a table keyed by language and feature; only a row per language, its counts, goes to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for declared, text in zip(batch.column("declared").to_pylist(), texts_of(batch), strict=True):
                if declared is None:
                    continue
                counts = features(plain(text.decode("utf-8", "replace")) if is_markup else text) if text else 0
                sums[declared] = sums.get(declared, np.zeros(FEATURES, np.int64)) + counts
                if len(sums) * FEATURES >= CELLS:
                    yield from counted(sums)
                    sums = {}
        yield from counted(sums)

    def counted(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for declared, counts in sums.items():
            # A language without a single feature has a row all the same.
            at = np.flatnonzero(counts) if counts.any() else np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([declared] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())],
                ["declared", "feature", "n"],
            )

    found = rows.select("declared", "text").mapInArrow(run, "declared string, feature long, n long")
    cells = found.groupBy("declared", "feature").agg(F.sum("n").alias("n"))
    by_language = cells.groupBy("declared").agg(F.collect_list("feature").alias("at"), F.collect_list("n").alias("n"))
    own = {}
    for row in written(by_language).toLocalIterator():
        own[row["declared"]] = np.zeros(FEATURES, np.float32)
        own[row["declared"]][row["at"]] = row["n"]
    languages = sorted(own)
    return TextModel(languages, [own.pop(name) for name in languages])


SCORED = "id long, key long, host string, declared string, n long, logs array<float>"


def score_texts(rows: DataFrame, model: TextModel, is_markup: bool) -> DataFrame:
    """Log likelihoods of each row's text, the unknown language last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, CELLS // len(model.logs))
        for whole in batches:
            for begin in range(0, whole.num_rows, step):
                batch = whole.slice(begin, step)
                logs, sizes = [], []
                for text in texts_of(batch):
                    text = text or b""
                    log, n = model.log_likelihoods(plain(text.decode("utf-8", "replace")) if is_markup else text)
                    logs.append(log)
                    sizes.append(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c) for c in ("id", "key", "host", "declared")], pa.array(sizes, pa.int64()),
                        lists(np.array(logs)),
                    ],
                    ["id", "key", "host", "declared", "n", "logs"],
                )

    return written(rows.select("id", "key", "host", "declared", "text").mapInArrow(run, SCORED))


def lists(table: np.ndarray) -> pa.Array:
    offsets = np.arange(len(table) + 1, dtype=np.int32) * table.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(table).ravel()))


def weights_by(scored: DataFrame, key: str) -> DataFrame:
    """(key, n, w): texts and the sums of their languages' weights, under flat priors, for each value of a column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for value, logs in zip(batch.column(key).to_pylist(), batch.column("logs"), strict=True):
                known = logs.values.to_numpy()[:-1].astype(np.float64)
                weights = np.exp(known - known.max())
                # The last place counts the texts.
                sums[value] = sums.get(value, 0) + np.append(weights / weights.sum(), 1.0)
                if len(sums) * (len(known) + 1) >= CELLS:
                    yield summed(sums)
                    sums = {}
        if sums:
            yield summed(sums)

    def summed(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
        table = np.array(list(sums.values()))
        columns = [pa.array(list(sums), pa.string()), pa.array(table[:, -1]), lists(table[:, :-1])]
        return pa.RecordBatch.from_arrays(columns, [key, "n", "w"])

    return vector_sums(scored.select(key, "logs").mapInArrow(run, f"{key} string, n double, w array<double>"), [key])


def vector_sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of n and, place by place, of w by ``keys``; a row is as long as there are languages."""
    cells = rows.select(*keys, "n", F.posexplode("w").alias("at", "v")).groupBy(*keys, "at")
    sums = cells.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).groupBy(*keys)
    places = F.array_sort(F.collect_list(F.struct("at", "v")))
    return sums.agg(F.max("n").alias("n"), F.transform(places, lambda c: c["v"]).alias("w"))


def constant(values: np.ndarray) -> Column:
    """An array column as one literal, however many values there are."""
    return F.split(F.lit(",".join(map(repr, values.tolist()))), ",").cast("array<double>")


def host_priors(scored: DataFrame, size: int) -> tuple[DataFrame, np.ndarray]:
    """(host, prior): language shares of a host's texts, smoothed by its domain's, its suffix's and all texts'.

    Each level's prior counts for PRIOR_ROWS rows of the level below. Only sums per host are grouped further.
    """
    hosts = written(with_domain(weights_by(scored.where("n > 0"), "host")))
    top = vector_sums(hosts, []).first()
    shares = (np.array(top["w"] or np.zeros(size)) + 1.0 / size) / ((top["n"] or 0) + 1.0)
    parents, keys = None, []
    for key in ("suffix", "domain", "host"):
        groups = vector_sums(hosts, [*keys, key])
        groups = groups.withColumn("outer", constant(shares)) if parents is None else groups.join(parents, keys)
        prior = F.zip_with("w", "outer", lambda w, p: (w + PRIOR_ROWS * p) / (F.col("n") + PRIOR_ROWS))
        parents = groups.select(*keys, key, prior.alias("outer"))
        keys = [*keys, key]
    return parents.select("host", F.col("outer").alias("prior")), shares


def declared_odds(scored: DataFrame, size: int) -> tuple[DataFrame, np.ndarray]:
    """(declared, odds): log P(declared | language) by language for each declared one, from the texts' weights.

    Beside it the odds of a declared language none of whose texts has letters.
    """
    rows = written(weights_by(scored.where("n > 0 AND declared IS NOT NULL"), "declared"))
    top = vector_sums(rows, []).first()
    totals = np.array(top["w"] or np.zeros(size)) + CELL * size
    odds = F.zip_with("w", constant(totals), lambda w, total: F.log((w + CELL) / total))
    return rows.select("declared", odds.alias("odds")), np.log(CELL / totals)


def identify(
    rows: DataFrame,
    id_col: str,
    text_col: str,
    declared: Column,
    host: Column | None = None,
    is_markup: bool = False,
    min_posterior: float = MIN_POSTERIOR,
) -> DataFrame:
    """The language of each row's text, by Bayes' rule over all evidence.

    * text: a naive Bayes model of byte triples, trained on all rows by the language they declare, its weight bounded
      by STRENGTH as neighbouring triples overlap. Every declared primary tag is a language, however rare;
    * declared language: how often texts of each language declare it, counted over all rows;
    * address suffix and host: the share of languages on the host, smoothed by registered domain, suffix and all.

    ``und`` stands for no known language. A row is accepted if its best language is a known one with a posterior of
    ``min_posterior`` or more and its text has letters. Null or empty text has no letters, so it is not accepted; its
    language is what the other evidence says. Null declared language and null host are no evidence (the host falls
    back to the prior of all rows). Ties go to the language first in the alphabet. Repeated rows get a row each, an
    empty table gives none, other columns are not read.

    Returns id, key (a hash of the row's text), lang, posterior, declared, accepted.
    """
    text = F.col(text_col)
    read = rows.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"),
        F.coalesce(host if host is not None else F.lit(""), F.lit("")).alias("host"),
        primary(declared).alias("declared"),
        text.alias("text"),
    )
    model = train(read, is_markup)
    languages = model.languages
    scored = score_texts(read, model, is_markup)
    if not languages:
        out = scored.select("id", "key", F.lit(UNKNOWN).alias("lang"), F.lit(1.0).alias("posterior"), "declared")
        return out.withColumn("accepted", F.lit(False))
    priors, shares = host_priors(scored, len(languages))
    by_declared, without = declared_odds(scored, len(languages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*languages, UNKNOWN]
        for batch in batches:
            out = []
            # Row by row, so that no more than one row's arrays are Python objects or copies.
            for at, row in enumerate(batch.select(["id", "key", "declared", "n"]).to_pylist()):
                prior, odds = batch.column("prior")[at].values, batch.column("odds")[at].values
                log = batch.column("logs")[at].values.to_numpy().astype(np.float64)
                log[:-1] += np.log((shares if prior is None else prior.to_numpy()) * (1 - UNKNOWN_PRIOR))
                if row["declared"] is not None:
                    log[:-1] += without if odds is None else odds.to_numpy()
                log[-1] += np.log(UNKNOWN_PRIOR)
                weights = np.exp(log - log.max())
                best = int(weights.argmax())
                posterior = float(weights[best] / weights.sum())
                sure = names[best] != UNKNOWN and posterior >= min_posterior and row["n"] > 0
                out.append(
                    {
                        "id": row["id"], "key": row["key"], "lang": names[best], "posterior": posterior,
                        "declared": row["declared"], "accepted": sure,
                    }
                )
            yield from pa.Table.from_pylist(out, schema).to_batches()

    schema = pa.schema(
        [
            ("id", pa.int64()), ("key", pa.int64()), ("lang", pa.string()), ("posterior", pa.float64()),
            ("declared", pa.string()), ("accepted", pa.bool_()),
        ]
    )
    joined = scored.join(priors, "host", "left").join(by_declared, "declared", "left")
    return joined.mapInArrow(run, "id long, key long, lang string, posterior double, declared string, accepted boolean")


def page_languages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Languages of web pages: the html element's lang attribute is what they declare, the host comes from the url."""
    declared = F.regexp_extract(F.col("html"), r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z]{2,8})", 1)
    rows = with_address(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")))
    return identify(rows, "id", "html", declared, F.col("host"), is_markup=True).withColumnRenamed("id", "page_id")


def in_known_language(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", host_col: str = "source") -> DataFrame:
    """The documents whose language is accepted, with all their columns, whatever their names; ``host_col`` plays the
    host's part.

    The verdict depends on the text, the declared language and the host alone, so rows that agree in these stay or go
    together, and ids do not matter. Null and empty texts are not accepted and go; a null declared language or host
    is no evidence. An empty table gives no rows.
    """
    text, lang, host = F.col(text_col), F.col(lang_col), F.col(host_col)
    none = F.lit("")
    key = F.xxhash64(F.coalesce(text, none), F.coalesce(lang, none), F.coalesce(host, none))
    keyed = docs.select(F.struct("*").alias("row"), key.alias("id"), text.alias("text"), lang.alias("lang"), host.alias("host"))
    found = identify(keyed.drop("row"), "id", "text", F.col("lang"), F.col("host"))
    bad = found.where("NOT accepted").select("id").distinct()
    return keyed.join(bad, "id", "left_anti").select("row.*")
