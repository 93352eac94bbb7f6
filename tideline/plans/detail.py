"""From raw application log to cleaned, mapped and enriched detail rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.timing import day_of, not_blank, same_day
from tideline.operators.ordered import MAX_ROWS
from tideline.plans.geo import enrich_area, located
from tideline.plans.identity import map_identity

# Fixed value: times at or below this are not epoch milliseconds.
EARLIEST_MILLIS = 1_000_000_000_000

# Columns of the detail table, in its order.
DETAIL_COLUMNS = [
    "eventid", "guid", "releasechannel", "account", "appid", "appversion", "carrier", "deviceid",
    "devicetype", "ip", "latitude", "longitude", "nettype", "osname", "osversion", "resolution",
    "sessionid", "timestamp", "register_time", "first_access_time", "is_new", "geohash", "province",
    "city", "region", "props_json", "dw_date",
]


def passes_gate() -> Column:
    """Device and event present, a plausible time and properties."""
    return (
        not_blank(F.col("deviceid"))
        & not_blank(F.col("eventid"))
        & F.coalesce(F.col("timestamp") > EARLIEST_MILLIS, F.lit(False))
        & F.col("properties").isNotNull()
    )


def with_new_flag(rows: DataFrame, as_of: str) -> DataFrame:
    """1 where the first access, or else the registration, fell on the ``as_of`` day."""
    first = F.coalesce(F.nullif(F.col("first_access_time"), F.lit(0).cast("long")), F.col("register_time"))
    return rows.withColumn("is_new", F.coalesce(same_day(first, as_of).cast("int"), F.lit(0)))


def build_detail(
    logs: DataFrame,
    members: DataFrame,
    dictionary: DataFrame,
    as_of: str,
    known_ids: DataFrame | None = None,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """The whole cleaning job; ``area_missing`` marks rows for the unknown-position output."""
    gated = logs.where(passes_gate()).withColumn("props_json", F.to_json("properties"))
    mapped = map_identity(gated, members, known_ids, max_rows)
    enriched = enrich_area(located(with_new_flag(mapped, as_of)), dictionary)
    dated = enriched.withColumn("dw_date", F.date_format(day_of(F.col("timestamp")), "yyyy-MM-dd"))
    return dated.select("log_id", *DETAIL_COLUMNS, "properties", "area_missing")
