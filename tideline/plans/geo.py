"""Area dictionary by geohash and enrichment with it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.geohash import possible_position, with_geohash

# Fixed value: the name given to an area that cannot be found.
UNKNOWN = "未知"

HASH_LENGTH = 5


def area_paths(areas: DataFrame) -> DataFrame:
    """Province, city and region of every position held by level four and level three areas."""

    def level(number: int, name: str) -> DataFrame:
        return areas.where(F.col("level") == number).select(
            F.col("id").alias(f"{name}_id"),
            F.col("area_name").alias(name),
            F.col("parent_id").alias(f"{name}_parent"),
            F.col("lat").alias(f"{name}_lat"),
            F.col("lng").alias(f"{name}_lng"),
        )

    province, city, region, spot = (
        level(1, "province"), level(2, "city"), level(3, "region"), level(4, "spot"),
    )
    tree = region.join(city, region.region_parent == city.city_id).join(
        province, city.city_parent == province.province_id
    )
    spots = spot.join(tree, spot.spot_parent == tree.region_id)
    names = ["province", "city", "region"]
    # Positions of level three are written after those of level four and so replace them.
    return spots.select(
        *names, F.col("spot_lat").alias("lat"), F.col("spot_lng").alias("lng"),
        F.lit(0).alias("part"), F.col("spot_id").alias("source_id"),
    ).unionAll(
        tree.select(
            *names, F.col("region_lat").alias("lat"), F.col("region_lng").alias("lng"),
            F.lit(1).alias("part"), F.col("region_id").alias("source_id"),
        )
    )


def geo_dictionary(areas: DataFrame) -> DataFrame:
    """One area per geohash, the last written one."""
    hashed = with_geohash(area_paths(areas), "lat", "lng", "geohash", HASH_LENGTH)
    last = F.max_by(F.struct("province", "city", "region"), F.struct("part", "source_id"))
    return hashed.groupBy("geohash").agg(last.alias("area")).select("geohash", "area.*")


def located(logs: DataFrame) -> DataFrame:
    return with_geohash(logs, "latitude", "longitude", "geohash", HASH_LENGTH)


def enrich_area(logs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Area names by geohash; a miss is named unknown and flagged in ``area_missing``."""
    found = dictionary.withColumn("__found", F.lit(True))
    joined = logs.join(found, "geohash", "left")
    # Tested on the position, not the geohash, so that a filter on it stays cheap in the scan.
    missing = F.col("__found").isNull() & possible_position(F.col("latitude"), F.col("longitude"))
    return joined.withColumns(
        {
            "area_missing": F.coalesce(missing, F.lit(False)),
            **{c: F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in ("province", "city", "region")},
        }
    ).drop("__found")


def unknown_positions(enriched: DataFrame) -> DataFrame:
    """Positions to be looked up elsewhere, as ``lng,lat``."""
    text = F.concat_ws(",", F.col("longitude").cast("string"), F.col("latitude").cast("string"))
    return enriched.where("area_missing").select("log_id", text.alias("position"))
