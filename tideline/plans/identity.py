"""Who a log row belongs to: registered account, best-bound account or temporary id.

Per device, each event of an account adds one to its binding weight and takes one from
every other account bound before. With n = events of the account, N = account events of
the device and N0 = N at the account's first event, the weight after any row is
2n + N0 - 1 - N. The first part only grows, and only at the account's own events, so the
best account at any row is a running minimum over the rows before it: no device's events
are paired with its accounts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.timing import not_blank
from tideline.operators.ordered import MAX_ROWS, ordered, running_count, running_min, totals
from tideline.session import stored

# Fixed value: temporary ids start above this number.
TEMP_ID_BASE = 100_000_000

ORDER = ["timestamp", "log_id"]


def _registered(logs: DataFrame, members: DataFrame) -> DataFrame:
    """Adds the member's id and registration time; unknown accounts count as absent."""
    known = members.select(
        F.col("account").alias("__account"),
        F.col("id").alias("__member"),
        F.col("create_time").alias("__registered"),
    )
    # Rows without an account match nothing; a key of their own keeps them spread over tasks.
    nobody = F.concat(F.lit("\u0000"), F.col("log_id").cast("string"))
    account = F.when(not_blank(F.col("account")), F.col("account")).otherwise(nobody)
    # Hashed, not sorted: a task holds its accounts, while log rows pass.
    return logs.join(known.hint("shuffle_hash"), account == known["__account"], "left")


@dataclass(frozen=True)
class IdentityState:
    """What one run of the identity job hands to the next: all of it is one short row per device or account.

    ``events`` counts account events per device, ``accounts`` has each account's events on a device and where the
    first stood, ``best`` the strongest account so far, ``temporary`` the temporary ids given.
    """

    events: DataFrame
    accounts: DataFrame
    best: DataFrame
    temporary: DataFrame

    def written(self) -> "IdentityState":
        """The same state from the shared folder, free of the run that made it."""
        return IdentityState(*[stored(f) for f in (self.events, self.accounts, self.best, self.temporary)])


def _best_bound(
    logs: DataFrame, members: DataFrame, max_rows: int, state: IdentityState | None, continued: bool
) -> tuple[DataFrame, list[DataFrame]]:
    """Adds N as ``__n_all`` and, as ``__best``, the strongest account up to the row, and writes the rows; and, if the
    job is to be ``continued``, what each scan reached, by the rows written."""
    rows = ordered(logs, ["deviceid"], ORDER, max_rows, counted=True).transform(lambda f: _registered(f, members))
    scans = []

    def scan(rows, keys: list[str], since: DataFrame | None, *running):
        scans.append((keys, list(running), since))
        return rows.by(*keys).scan(*running, since=since)

    rows = scan(rows, ["deviceid"], state and state.events, running_count("__n_all", F.col("__account").isNotNull()))
    rows = scan(
        rows, ["deviceid", "__account"], state and state.accounts,
        running_count("__n"), running_min("__n_first", F.col("__n_all")),
    )
    score = 2 * F.col("__n") + F.col("__n_first") - 1
    # Equal scores go to the account that sorts first.
    candidate = F.when(
        F.col("__account").isNotNull(),
        F.struct(
            (-score).alias("minus_score"),
            F.col("__account").alias("account"),
            F.col("__member").alias("member"),
            F.col("__registered").alias("registered"),
        ),
    )
    rows = rows.transform(lambda f: f.withColumn("__candidate", candidate))
    rows = scan(rows, ["deviceid"], state and state.best, running_min("__best", F.col("__candidate")))
    # Read by the totals, by the numbering of devices and by the result.
    best = stored(rows.rows())
    return best, [totals(best, keys, ORDER, running, since) for keys, running, since in scans] if continued else []


def device_bindings(logs: DataFrame, members: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Weight of each account on each device after all rows.

    Only the totals matter here, so three grouped counts replace the ordered scan, except
    for N0, the device's account events up to each account's first one.
    """
    rows = _registered(logs, members).where(F.col("__account").isNotNull())
    counted = ordered(
        rows.select("deviceid", "__account", *ORDER), ["deviceid"], ORDER, max_rows, counted=True
    ).scan(running_count("__n_all")).rows()
    per_account = counted.groupBy("deviceid", "__account").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__n_all").alias("__n_first")
    )
    per_device = per_account.groupBy("deviceid").agg(F.sum("__n").alias("__n_device"))
    weight = 2 * F.col("__n") + F.col("__n_first") - 1 - F.col("__n_device")
    return per_account.join(per_device, "deviceid").select(
        "deviceid", F.col("__account").alias("account"), weight.alias("weight")
    )


def temporary_ids(
    first_visits: DataFrame, known: DataFrame | None = None, max_rows: int = MAX_ROWS
) -> DataFrame:
    """A stable id per anonymous device: numbered by first visit above the ids given so far.

    ``first_visits`` has ``deviceid`` and ``first_time``; ``known`` holds devices numbered
    before, which keep their id.
    """
    start = F.lit(TEMP_ID_BASE).cast("long")
    fresh = first_visits
    if known is not None:
        fresh = first_visits.join(known.select("deviceid"), "deviceid", "left_anti")
        start = known.agg(F.coalesce(F.max("guid"), F.lit(TEMP_ID_BASE)).cast("long")).scalar()
    numbered = ordered(fresh, [], ["first_time", "deviceid"], max_rows, keep=True, counted=True).scan(running_count("__at")).rows()
    given = numbered.select("deviceid", (F.col("__at") + start).alias("guid"), "first_time")
    return given if known is None else known.unionByName(given)


def map_identity(
    logs: DataFrame, members: DataFrame, known_ids: DataFrame | None = None, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Fill ``guid``, ``register_time``, ``first_access_time`` and, where bound, ``account``.

    A device that once fell back to a temporary id keeps it for its anonymous rows.
    """
    return _mapped(logs, members, known_ids, max_rows, None, continued=False)[0]


def continue_identity(
    logs: DataFrame, members: DataFrame, state: IdentityState | None = None, max_rows: int = MAX_ROWS
) -> tuple[DataFrame, IdentityState]:
    """``map_identity`` of rows that come after those of earlier runs, and the state for the next run.

    Runs over consecutive stretches of a log give together what one run over all of it gives.
    """
    mapped, reached, ids = _mapped(logs, members, state and state.temporary, max_rows, state, continued=True)
    return mapped, IdentityState(*reached, ids)


def _mapped(
    logs: DataFrame, members: DataFrame, known_ids: DataFrame | None, max_rows: int, state: IdentityState | None, continued: bool
) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    best, reached = _best_bound(logs, members, max_rows, state, continued)
    anonymous = F.col("__account").isNull()
    bound = -F.col("__best.minus_score") - F.col("__n_all") > 0
    unresolved = anonymous & ~F.coalesce(bound, F.lit(False))
    fallback = (
        best.where(unresolved)
        .groupBy("deviceid")
        .agg(F.min(F.struct(*ORDER)).alias("__since"))
        .withColumn("first_time", F.col("__since.timestamp"))
    )
    ids = temporary_ids(fallback.select("deviceid", "first_time"), known_ids, max_rows)
    temp = ids.join(fallback.select("deviceid", "__since"), "deviceid", "left").select(
        "deviceid",
        F.col("guid").alias("__temp_guid"),
        F.col("first_time").alias("__first_time"),
        "__since",
    )
    if known_ids is not None:
        # A device numbered in an earlier batch holds its id from its first row on.
        earlier = known_ids.select("deviceid", F.lit(True).alias("__known"))
        temp = temp.join(earlier, "deviceid", "left")
    else:
        temp = temp.withColumn("__known", F.lit(False))
    joined = best.join(temp.hint("shuffle_hash"), "deviceid", "left")
    on_temp = anonymous & (
        F.coalesce(F.col("__known"), F.lit(False))
        | F.coalesce(F.col("__since") <= F.struct(*ORDER), F.lit(False))
    )
    mapped = joined.select(
        *[c for c in logs.columns if c != "account"],
        F.when(anonymous & ~on_temp, F.col("__best.account")).otherwise(F.col("account")).alias("account"),
        F.when(~anonymous, F.col("__member"))
        .when(on_temp, F.col("__temp_guid"))
        .otherwise(F.col("__best.member"))
        .alias("guid"),
        F.when(~anonymous, F.col("__registered"))
        .when(~on_temp, F.col("__best.registered"))
        .alias("register_time"),
        F.when(on_temp, F.col("__first_time")).alias("first_access_time"),
    )
    return mapped, reached, ids
