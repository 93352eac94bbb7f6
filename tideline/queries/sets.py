"""Sets that are kept and united: bitmaps of wide ids, daily sketches, Bloom filters; and user code over groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tideline.operators import accumulators as A
from tideline.operators import bitmaps as B
from tideline.operators import bloom, sketches
from tideline.queries.registry import query
from tideline.queries.relational import DAY, action_sql, actions
from tideline.session import scratch_folder, stored

ORDER = ["action_time", "log_id"]
#: Spreads user numbers over the range of 64 bits.
STRIDE = 10**15

_PART = "CASE WHEN day(ts) <= 9 THEN 0 WHEN day(ts) <= 20 THEN 1 ELSE 2 END"


def part_of_month():
    day = F.day("ts")
    return F.when(day <= 9, 0).when(day <= 20, 1).otherwise(2)


def _wide():
    return ((F.col("guid") % 9000) * F.lit(STRIDE) + F.col("guid")).alias("wide")


@query(
    "agg_bitmap_wide",
    action_sql(f"""
    WITH w AS (SELECT channel, guid % 9000 * {STRIDE} + guid AS wide FROM action_event)
    SELECT channel, count(DISTINCT wide) AS uv FROM w GROUP BY channel
    UNION ALL SELECT 'all', count(DISTINCT wide) FROM w
    UNION ALL SELECT 'app and web', count(*) FROM (SELECT wide FROM w WHERE channel = 'app' INTERSECT SELECT wide FROM w WHERE channel = 'web')"""),
)
def agg_bitmap_wide(spark, folder):
    """Distinct 64-bit ids from compressed bitmaps: per channel, of all channels, and of two at once."""
    sets = stored(B.build(actions(spark, folder).select("channel", _wide()), ["channel"], "wide"))
    one = lambda channel: sets.where(F.col("channel") == channel).drop("channel")
    both = B.count(B.common(one("app"), one("web"), []), [], "uv").select(
        F.lit("app and web").alias("channel"), F.coalesce("uv", F.lit(0).cast("long")).alias("uv")
    )
    everyone = B.count(B.united(sets, []), [], "uv").select(F.lit("all").alias("channel"), "uv")
    return B.count(sets, ["channel"], "uv").unionByName(everyone).unionByName(both)


@query(
    "agg_bitmap_member",
    action_sql("""SELECT log_id, guid IN (SELECT guid FROM action_event WHERE event_id = 'purchase') AS buyer FROM action_event"""),
)
def agg_bitmap_member(spark, folder):
    """Whether a row's user is in a kept set, looked up in the set's containers."""
    rows = actions(spark, folder).select("log_id", "guid", _wide())
    buyers = B.build(actions(spark, folder).where("event_id = 'purchase'").select(_wide()), [], "wide")
    return B.with_membership(rows, buyers, [], "wide", "buyer").select("log_id", "buyer")


@query(
    "agg_sketch_daily",
    action_sql("""SELECT channel, count(DISTINCT guid) AS uv, true AS close, true AS same_again FROM action_event GROUP BY channel"""),
)
def agg_sketch_daily(spark, folder):
    """Daily sketches that are stored and united: within five standard errors of the exact number, also united twice."""
    rows, path = actions(spark, folder).withColumn("day", F.to_date("ts")), scratch_folder(spark, "sketches")
    sketches.store_days(sketches.sketched(rows, "day", ["channel"], "guid"), path, "day")
    kept = spark.read.parquet(path).drop("day")
    once = sketches.united(kept, ["channel"]).select("channel", sketches.estimate().alias("n"))
    twice = sketches.united(kept.unionByName(kept), ["channel"]).select("channel", sketches.estimate().alias("m"))
    exact = rows.groupBy("channel").agg(F.count_distinct("guid").alias("uv"))
    off = F.abs(F.col("n") - F.col("uv")) <= F.greatest(F.lit(1.0), 5 * sketches.standard_error() * F.col("uv"))
    return exact.join(once, "channel").join(twice, "channel").select(
        "channel", "uv", off.alias("close"), (F.col("n") == F.col("m")).alias("same_again")
    )


@query("st_first_seen_filters", action_sql(f"SELECT guid, min({_PART}) AS part FROM action_event GROUP BY guid"))
def st_first_seen_filters(spark, folder):
    """Users new in each part of the month: filters kept per part reject most known users, a join decides the rest."""
    users = stored(actions(spark, folder).select("guid", part_of_month().alias("part")).distinct())
    sizing = bloom.Sizing.of(users.agg(F.approx_count_distinct("guid")).first()[0], 0.01)
    filters = stored(bloom.build(users, ["part"], ["guid"], sizing))
    found = []
    for part in range(3):
        earlier = bloom.united(filters.where(F.col("part") < part))
        now, known = users.where(F.col("part") == part), users.where(F.col("part") < part)
        found.append(bloom.unseen(now, earlier, known, ["guid"], sizing))
    return reduce(lambda a, b: a.unionByName(b), found)


@query(
    "win_user_accumulator",
    action_sql(f"""SELECT action_time // {DAY} AS day, channel, CAST(sum(action_timelong) AS DOUBLE) AS total, count(*) AS n,
                   CAST(sum(action_timelong) AS DOUBLE) / count(*) AS average FROM action_event GROUP BY ALL"""),
)
def win_user_accumulator(spark, folder):
    """An accumulator of the user's own per day and channel, partial before the shuffle."""
    rows = actions(spark, folder).select(F.floor(F.col("action_time") / DAY).alias("day"), "channel", "action_timelong")
    return A.accumulate(rows, ["day", "channel"], A.Average("action_timelong"), ["action_timelong"])


@query(
    "win_user_counts",
    action_sql("""SELECT channel, string_agg(event_id || '=' || n, ',' ORDER BY event_id) AS counts FROM (
                  SELECT channel, event_id, count(*) AS n FROM action_event GROUP BY ALL) GROUP BY channel"""),
)
def win_user_counts(spark, folder):
    """An accumulator whose state is a map of counts."""
    rows = actions(spark, folder).select("channel", "event_id")
    return A.accumulate(rows, ["channel"], A.CountPerItem("event_id"), ["event_id"])


@query(
    "win_user_process",
    action_sql(f"""
    WITH placed AS (SELECT *, action_time // {DAY} AS day, row_number() OVER (PARTITION BY guid, action_time // {DAY} ORDER BY action_time, log_id) AS place
                    FROM action_event)
    SELECT day, guid, count(*) AS n, string_agg(event_id, '>' ORDER BY place) FILTER (WHERE place <= 3) AS opening FROM placed GROUP BY day, guid"""),
)
def win_user_process(spark, folder):
    """A function over all rows of a user's day, in order."""

    def opening(key, rows):
        n, first = 0, []
        for row in rows:
            n += 1
            if n <= 3:
                first.append(row["event_id"])
        yield n, ">".join(first)

    rows = actions(spark, folder).select(F.floor(F.col("action_time") / DAY).alias("day"), "guid", *ORDER, "event_id")
    return A.process_groups(rows, ["day", "guid"], ORDER, opening, "n BIGINT, opening STRING")


@query(
    "cogroup_user",
    action_sql("""
    WITH both_kinds AS (SELECT * FROM action_event WHERE event_id IN ('click', 'purchase')),
         counted AS (SELECT *, count(*) FILTER (WHERE event_id = 'click') OVER (PARTITION BY guid ORDER BY action_time, log_id) AS clicks FROM both_kinds)
    SELECT guid, log_id, clicks - coalesce(lag(clicks) OVER (PARTITION BY guid ORDER BY action_time, log_id), 0) AS clicks
    FROM counted WHERE event_id = 'purchase'"""),
)
def cogroup_user(spark, folder):
    """Each purchase with the clicks since the one before, by a function that sees both sides of a user in order."""

    def since_last(key, rows):
        clicks = 0
        for row in rows:
            if row["side"] == "left":
                clicks += 1
            else:
                yield row["log_id"], clicks
                clicks = 0

    rows = actions(spark, folder).select("guid", *ORDER, "event_id")
    left, right = (rows.where(F.col("event_id") == kind).drop("event_id") for kind in ("click", "purchase"))
    return A.co_group(left, right, ["guid"], ORDER, since_last, "log_id BIGINT, clicks BIGINT")
