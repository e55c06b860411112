"""Cleaning and enriching trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.measures import duration_minutes, speed_per_hour
from tidemark.functions.values import as_timestamp, spelled
from tidemark.schemas import TRIP_COLUMNS


def typed_trips(bronze: DataFrame) -> DataFrame:
    """``trip_id`` and the trip columns in their clean types; values that do not convert become NULL.

    A column that already has its type is passed through as is, so that filters on it still reach the
    Parquet scan.
    """
    trip_id, *raw_names = spelled(bronze, "trip_id", *TRIP_COLUMNS)
    columns = [F.col(trip_id).alias("trip_id")]
    for raw, (name, data_type) in zip(raw_names, TRIP_COLUMNS.items(), strict=True):
        if data_type == "timestamp":
            value = as_timestamp(F.col(raw), bronze.schema[raw].dataType)
        else:
            value = F.col(raw).try_cast(data_type)
        columns.append(value.alias(name))
    return bronze.select(*columns)


def quality_rules() -> dict[str, Column]:
    """What a trip must satisfy; a trip of zero duration passes."""
    return {
        "fare_present": F.col("fare_amount").isNotNull(),
        "tip_present": F.col("tip_amount").isNotNull(),
        "distance_present": F.col("trip_distance").isNotNull(),
        "pickup_present": F.col("tpep_pickup_datetime").isNotNull(),
        "dropoff_present": F.col("tpep_dropoff_datetime").isNotNull(),
        "dropoff_not_before_pickup": F.col("tpep_dropoff_datetime") >= F.col("tpep_pickup_datetime"),
        "fare_positive": F.col("fare_amount") > 0,
        "tip_not_negative": F.col("tip_amount") >= 0,
        "distance_positive": F.col("trip_distance") > 0,
    }


def clean_trips(bronze: DataFrame, distance_factor: float = 1.0) -> DataFrame:
    """Typed trips that pass every rule, with duration and speed.

    ``distance_factor`` converts the distance unit inside the speed, 1.0 leaves it alone.
    """
    trips = typed_trips(bronze)
    for rule in quality_rules().values():
        trips = trips.filter(rule)
    minutes = duration_minutes(F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime"))
    distance = F.col("trip_distance") if distance_factor == 1.0 else F.col("trip_distance") * F.lit(distance_factor)
    return trips.select(
        "*",
        minutes.alias("trip_duration_minutes"),
        speed_per_hour(distance, minutes).alias("trip_speed_kmh"))


def rejected_trips(bronze: DataFrame) -> DataFrame:
    """Per rule, how many trips break it, in one pass; then the totals and the share dropped.

    A comparison with a missing value breaks only the rule on presence. One trip can break several.
    """
    rules = quality_rules()
    flags = {name: F.coalesce(rule, F.lit(True)) for name, rule in rules.items()}
    passes = F.lit(True)
    for flag in flags.values():
        passes = passes & flag

    def count_of(condition: Column) -> Column:
        return F.coalesce(F.sum(condition.cast("bigint")), F.lit(0))

    totals = typed_trips(bronze).agg(
        *[count_of(~flag).alias(name) for name, flag in flags.items()],
        F.count(F.lit(1)).alias("all_trips"),
        count_of(passes).alias("kept_trips"))
    measures = [*rules, "all_trips", "kept_trips"]
    return totals.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).alias("trips"),
                 (F.col(m) * 100.0 / F.nullif(F.col("all_trips"), F.lit(0))).alias("pct_of_all"))
        for m in measures])).alias("m")).select("m.*")


def zone_names(zones: DataFrame, id_name: str, zone_name: str) -> DataFrame:
    """Lookup with one row per zone; two rows for the same zone stop the job, they would multiply trips."""
    location, zone = spelled(zones, "LocationID", "Zone")
    grouped = (zones.groupBy(F.col(location).alias(id_name))
               .agg(F.count(F.lit(1)).alias("_n"), F.min(zone).alias("_zone")))
    checked = F.when(F.col("_n") > 1, F.raise_error(F.concat(
        F.lit("zone lookup has several rows for LocationID "), F.col(id_name).cast("string")))).otherwise(F.col("_zone"))
    return grouped.select(id_name, checked.alias(zone_name))


def enrich_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Adds pickup and dropoff zone names; an unknown zone leaves NULL.

    No broadcast hint: Spark broadcasts the lookup when its measured size allows, and otherwise joins
    by shuffle, where AQE splits a zone that holds a large share of the trips.
    """
    pickup = zone_names(zones, "PULocationID", "pickup_zone")
    dropoff = zone_names(zones, "DOLocationID", "dropoff_zone")
    return (trips.join(pickup, "PULocationID", "left").join(dropoff, "DOLocationID", "left")
            .select(*trips.columns, "pickup_zone", "dropoff_zone"))
