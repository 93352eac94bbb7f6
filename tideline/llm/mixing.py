"""Mixing sources to target weights by systematic sampling; DataFrame functions only."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sources in order take these weights, again and again.
WEIGHTS = (5, 2, 1)
#: The mix holds this share of all words, and no source more than so many times its own.
SHARE, MOST = 1.5, 2
#: Documents of one source and size are numbered in so many pieces, dealt by a multiplier.
PIECES, MULTIPLIER = 1024, 7919
SEED = 17


def offset(seed: int = SEED) -> float:
    """The one random offset of a mix."""
    return random.Random(seed).random()


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Words to take of each source: shares by weight, none above ``most`` times the source's words.

    The sources that reach their limit first are those with the least words per weight. With the sources in that
    order, the first j full, and the rest sharing what is left, j is the first number that fits: the level that
    the rest gets per weight is not above the limit of the next one. ``sizes`` has one row per source
    (source, source_size), so the two windows here see sources only.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("nr") % len(weights) + 1).cast("int"))
    weighed = sizes.withColumn("nr", F.row_number().over(order) - 1).withColumn("weight", pick)
    weighed = weighed.withColumn("cap", most * F.col("source_size")).withColumn("fill", F.col("cap") / F.col("weight"))
    by_fill = Window.orderBy("fill", "nr")
    before, everything = by_fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    levels = weighed.select(
        "*",
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("full"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("open"),
        (F.lit(share) * F.sum("source_size").over(everything)).alias("total"),
    ).withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    first = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "nr", "level"))).over(everything)["level"]
    target = F.least(F.col("cap").cast("double"), first * F.col("weight"))
    return levels.select("source", "source_size", target.alias("target"))


def mix_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    keep_row: bool = False,
    weights=WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = SEED,
) -> DataFrame:
    """How often the mix takes each document.

    Every document of a source expects target / source_size copies. Documents stand in order of size, then of a
    multiplicative deal of the id, then of the id; copy numbers are the integers that the running sum of expected
    copies passes, shifted by one random offset. Neighbours in this order have nearly the same size, so the words
    taken follow the target closely.

    The running sum is the document's number in its source times the rate. Numbers come in three levels, so that
    no task sorts a whole source: documents before this size, before this piece of the size, and in the piece.

    Null text or text without words has size 0, null source is a source of its own and comes last, null ids come
    first in their piece, repeated rows are separate documents. An empty table gives no rows. Returns id, size,
    source_size, target, copies, taken and, if ``keep_row``, the row itself as ``row``, so that no name can clash.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        *[F.struct(*docs.columns).alias("row")] * keep_row,
    ).withColumn("piece", F.coalesce(F.pmod(F.pmod(F.col("id"), F.lit(1 << 31)) * MULTIPLIER, F.lit(PIECES)), F.lit(0)))
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    rows = rows.withColumn("key", key)
    pieces = rows.groupBy("key", "source", "size", "piece").agg(F.count("*").alias("n"))
    sizes = pieces.groupBy("key", "source", "size").agg(F.sum("n").alias("n"))
    per_source = sizes.groupBy("key", "source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    goal = targets(per_source, weights, share, most).withColumn("key", key).drop("source")
    size_order = Window.partitionBy("key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    piece_order = Window.partitionBy("key", "size").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    smaller = sizes.select("key", "size", F.coalesce(F.sum("n").over(size_order), F.lit(0)).alias("smaller"))
    earlier = pieces.select("key", "size", "piece", F.coalesce(F.sum("n").over(piece_order), F.lit(0)).alias("earlier"))
    starts = earlier.join(smaller, ["key", "size"]).join(goal, "key").select(
        "key", "size", "piece", (F.col("smaller") + F.col("earlier")).alias("start"), "source_size", "target"
    )
    within = Window.partitionBy("key", "size", "piece").orderBy("id")
    numbered = rows.withColumn("nr", F.row_number().over(within)).join(starts, ["key", "size", "piece"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    upto = lambda nr: F.floor(F.lit(offset(seed)) + nr * rate)
    number = F.col("start") + F.col("nr")
    copies = (upto(number) - upto(number - 1)).cast("long")
    return numbered.withColumn("copies", copies).select(
        "id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
        *["row"] * keep_row,
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: a row of ``docs`` for each copy taken, with ``copy`` counting from 1 (in place of any such column)."""
    counted = mix_counts(docs, keep_row=True, **options).where("copies > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return counted.select("row", copies.alias("number")).select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c != "copy"], F.col("number").alias("copy")
    )


SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents
), s AS (
  SELECT source, sum(size) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) - 1 AS nr FROM d GROUP BY source
), w AS (
  SELECT *, [{', '.join(map(str, WEIGHTS))}][CAST(nr % {len(WEIGHTS)} + 1 AS INT)] AS weight FROM s
), c AS (
  SELECT *, {MOST} * source_size AS cap, {MOST} * source_size / weight AS fill FROM w
), l AS (
  SELECT *, ({SHARE} * CAST(sum(source_size) OVER () AS DOUBLE)
             - coalesce(sum(cap) OVER (ORDER BY fill, nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY fill, nr
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM c
), t AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size, least(CAST(cap AS DOUBLE), weight *
         (SELECT level FROM l WHERE level <= fill ORDER BY fill, nr LIMIT 1)) AS target FROM l
), n AS (
  SELECT doc_id, d.source, size, row_number() OVER (PARTITION BY d.source ORDER BY size,
         coalesce((doc_id % 2147483648 * {MULTIPLIER}) % {PIECES}, 0), doc_id NULLS FIRST) AS nr FROM d
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (floor({offset()!r} + nr * rate) - floor({offset()!r} + (nr - 1) * rate)) AS BIGINT) AS taken
FROM (SELECT n.*, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate
      FROM n JOIN t ON n.source IS NOT DISTINCT FROM t.source)
"""
