"""Exact duplicates by a tree merge of sorted digest runs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.tables import shuffle_partitions
from tideline.session import stored

KEYS = ["digest", "check", "n_norm"]
BEST = ["shorter", "no_id", "best_id", "best_row"]
#: What a run holds of each text: its keys, the row that stays and how many rows have the text.
RUN = "slot int, digest string, check long, n_norm long, shorter long, no_id boolean, best_id long, best_row long, copies long"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's digest without white space, written once so that row numbers and origins stay what they are."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.length(text).alias("n_chars"), bare.alias("bare"))
    return stored(
        rows.select(
            "id",
            F.sha2("bare", 256).alias("digest"),
            F.xxhash64("bare").alias("check"),
            F.length("bare").cast("long").alias("n_norm"),
            F.col("n_chars").cast("long").alias("n_chars"),
            F.monotonically_increasing_id().alias("row"),
            F.spark_partition_id().alias("origin"),
        )
    )


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge runs that arrive in order: of equal texts the first row stays and the copies add up."""
    held = None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if held and all(held[k] == row[k] for k in ("slot", *KEYS)):
                held["copies"] += row["copies"]
            else:
                if held:
                    out.append(held)
                held = row
        yield pa.RecordBatch.from_pylist(out, schema=batch.schema)
    if held:
        yield pa.RecordBatch.from_pylist([held], schema=batch.schema)


def tree_merge(runs: DataFrame, slots_per_round: int, rounds: int) -> DataFrame:
    """Bring equal digests together in ``rounds`` exchanges among ``slots_per_round`` slots each.

    A run starts in the slot of the partition that read it. In each round one digit of the slot number gives
    way to a digit of the digest, so a slot exchanges with ``slots_per_round`` others only, hands each of them
    the part of its run that is theirs, and merges what it gets. After the last round the slot is a function of
    the digest: every text is in one place, and no place has more than its share of all texts.
    """
    for r in range(rounds):
        unit = slots_per_round**r
        digit = F.conv(F.substring("digest", 1 + 2 * r, 2), 16, 10).cast("int") % slots_per_round
        own = F.floor(F.col("slot") / unit) % slots_per_round
        runs = runs.withColumn("slot", (F.col("slot") + (digit - own) * unit).cast("int"))
        runs = (
            runs.repartition(shuffle_partitions(runs), "slot")
            .sortWithinPartitions("slot", *KEYS, *BEST)
            .mapInArrow(merged, RUN)
        )
    return runs


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 16) -> DataFrame:
    """For each row the id of the equal text that stays.

    Texts are equal when they agree but for ``[\\x20\\x09-\\x0D]``: the same SHA-256, verified by a second hash and
    the length. Of equal texts the one with most code points stays, then the smallest id (null last); of repeated
    rows of one id exactly one stays. Null text counts as empty. An empty table gives no rows.

    A run has each text once for each partition that read it, so a text that a third of all rows share counts as
    one row per partition in the tree and on the way back.

    Returns id, keep_id, group_size, kept, digest; other columns of ``docs`` are ignored.
    """
    return _groups(docs, id_col, text_col, fan_in).drop("n_chars")


def _groups(docs: DataFrame, id_col: str, text_col: str, fan_in: int = 16) -> DataFrame:
    rows = digests(docs, id_col, text_col)
    rounds, slots = 1, fan_in
    while slots < shuffle_partitions(docs):
        rounds, slots = rounds + 1, slots * fan_in
    leaves = rows.groupBy("origin", *KEYS).agg(
        F.min(F.struct((-F.col("n_chars")).alias("a"), F.col("id").isNull().alias("b"), "id", "row")).alias("best"),
        F.count("*").alias("copies"),
    )
    runs = leaves.select(
        (F.col("origin") % slots).cast("int").alias("slot"),
        *KEYS,
        F.col("best.a").alias("shorter"),
        F.col("best.b").alias("no_id"),
        F.col("best.id").alias("best_id"),
        F.col("best.row").alias("best_row"),
        "copies",
    )
    tree = tree_merge(runs, fan_in, rounds).select(*KEYS, "best_id", "best_row", "copies")
    # Back down: to the runs that had the text, then to the rows of each run.
    told = rows.select("origin", *KEYS).distinct().join(tree, KEYS)
    return rows.join(told, ["origin", *KEYS]).select(
        "id",
        F.col("best_id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        (F.col("row") == F.col("best_row")).alias("kept"),
        "digest",
        "n_chars",
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay (see ``exact_groups``), with all their columns, whatever their names.

    Of rows that agree in id, text but for white space, and length, any one stays. Rows without text count as empty and
    are copies of each other; a null id comes last. An empty table gives no rows.
    """
    stay = _groups(docs, id_col, text_col).where("kept").select("id", "digest", "n_chars")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        F.struct("*").alias("row"),
        F.col(id_col).cast("long").alias("id"),
        F.sha2(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""), 256).alias("digest"),
        F.length(text).cast("long").alias("n_chars"),
    )
    same = F.expr("l.id <=> r.id AND l.digest = r.digest AND l.n_chars = r.n_chars")
    found = keyed.alias("l").join(stay.alias("r"), same, "left_semi")
    return found.dropDuplicates(["id", "digest"]).select("row.*")
