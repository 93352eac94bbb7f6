"""Tables as streams of changes, and back."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.joins import newest_per_key
from tideline.operators.ordered import OrderedJob, Stage, running_count, running_sum


def running_total_changes(keys: list[str], order: list[str], value: str, name: str) -> OrderedJob:
    """What a per-key running total of a BIGINT column tells its reader row by row.

    The first row of a key is ``+I``; each later one withdraws the old total (``-U``) and
    states the new one (``+U``).
    """

    def change(op: str, total: Column) -> Column:
        return F.struct(F.lit(op).alias("op"), total.alias(name))

    def spread(frame: DataFrame) -> DataFrame:
        new, old = F.col("__new"), F.col("__new") - F.col(value)
        changes = F.when(F.col("__rows") == 1, F.array(change("+I", new))).otherwise(
            F.array(change("-U", old), change("+U", new))
        )
        spread_out = frame.select(*keys, *order, F.explode(changes).alias("__c"))
        return spread_out.select(*keys, *order, "__c.*")

    running = Stage(lambda: [running_sum("__new", F.col(value)), running_count("__rows")])
    return OrderedJob(keys, order, [running], spread)


def count_changes(counted: DataFrame, count: str) -> DataFrame:
    """What each row does to its key's count: ``+I`` at the first, then ``-U`` of the old and ``+U`` of the new one."""
    n = F.col(count)

    def change(op: str, value: Column) -> Column:
        return F.struct(F.lit(op).alias("op"), value.alias(count))

    changes = F.when(n == 1, F.array(change("+I", n))).otherwise(F.array(change("-U", n - 1), change("+U", n)))
    rest = [c for c in counted.columns if c != count]
    return counted.select(*rest, F.explode(changes).alias("__c")).select(*rest, "__c.*")


def snapshot_changes(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The changes that lead from one state of a keyed table to the next."""
    # A null key is a key like any other.
    before = old.select(F.struct(*keys).alias("__key_old"), F.struct(*values).alias("__old"))
    after = new.select(F.struct(*keys).alias("__key_new"), F.struct(*values).alias("__new"))
    same = [F.col(f"__key_old.{k}").eqNullSafe(F.col(f"__key_new.{k}")) for k in keys]
    both = before.join(after, reduce(and_, same), "full").select(
        F.coalesce("__key_old", "__key_new").alias("__key"), "__old", "__new"
    ).select("__key.*", "__old", "__new")

    def change(op: str, row: str) -> Column:
        return F.struct(F.lit(op).alias("op"), F.col(row).alias("row"))

    changes = (
        F.when(F.col("__old").isNull(), F.array(change("+I", "__new")))
        .when(F.col("__new").isNull(), F.array(change("-D", "__old")))
        .when(
            ~F.col("__old").eqNullSafe(F.col("__new")),
            F.array(change("-U", "__old"), change("+U", "__new")),
        )
    )
    return both.select(*keys, F.explode(changes).alias("__c")).select(*keys, "__c.op", "__c.row.*")


def insert_rows(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("op") == "+I")


def current_rows(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The table the changes lead to: newest statement per key, deleted keys left out."""
    stated = changes.where(F.col("op") != "-U")
    return newest_per_key(stated, keys, order).where(F.col("op") != "-D").drop("op")
