"""Change logs and trips as views over the test tables.

``events`` is read as a change log, its type giving the operation and its user the key, and also as a
list of trips; ``nation`` serves as zone lookup and ``supplier`` as the drivers.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark import schemas as S
from tidemark.session import pin_utc
from tidemark.sinks.messages import to_envelope

USERS = S.TableSpec("users", "id", T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# K of events with an unknown operation, and of those that lost their row images.
UNKNOWN_K, LOST_K = 41, 43


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in order of arrival (``event_id``, ``ts``); ``ts_ms``, when they happened, is often earlier.

    A third of all events belong to user 1. One in ten happened five days before it arrived, one in ten an hour.
    """
    # props is {"k": <number>}. Filters on derived columns repeat this expression, so it has to be cheap.
    k = F.regexp_extract("props", r'"k": *(\d+)', 1).cast("int")
    op = (F.when(F.col("k") == UNKNOWN_K, "m")
          .when(F.col("event_type") == "signup", S.CREATE).when(F.col("event_type") == "view", S.SNAPSHOT)
          .when(F.col("event_type") == "error", S.DELETE).otherwise(S.UPDATE))
    delay = (F.when(F.col("k") % 10 == 3, F.lit(5 * 86_400_000)).when(F.col("k") % 10 == 7, F.lit(3_600_000))
             .otherwise(F.lit(0)))
    return table(spark, sf_dir, "events").withColumn("k", k).select(
        "event_id", F.when(F.col("k") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("user_id")).alias("user_id"),
        "event_type", F.col("value").alias("amount"),
        F.col("ts").cast("timestamp").alias("ts"), "k", op.alias("op"),
        (F.unix_millis(F.col("ts").cast("timestamp")) - delay).alias("ts_ms"))


def bronze_of(events: DataFrame, spec: S.TableSpec, columns: dict[str, Column], offset: Column) -> DataFrame:
    """Bronze rows: the row image is before for a delete and after for everything else."""
    deleted = F.col("op") == S.DELETE

    def image(side: str, name: str) -> Column:
        shown = deleted if side == "before" else ~deleted & (F.col("k") != LOST_K)
        return F.when(shown, columns[name]).alias(f"{side}_{name}")

    keys = [image(side, spec.key) for side in ("after", "before")]
    attributes = [image(side, name) for side in ("after", "before") for name in spec.attributes]
    return events.select(
        F.lit(spec.topic).alias("topic"), F.pmod("user_id", F.lit(4)).cast("int").alias("kafka_partition"),
        offset.alias("kafka_offset"), F.col("ts").alias("kafka_timestamp"), F.lit(spec.name).alias("source_table"),
        "op", "ts_ms", F.col("event_id").alias("source_lsn"), *keys, *attributes,
        F.lit(None).cast("string").alias("value"))


def user_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as the bronze change log of one table."""
    columns = {"id": F.col("user_id"), "event_type": F.col("event_type"), "amount": F.col("amount")}
    return bronze_of(_events(spark, sf_dir), USERS, columns, F.col("event_id"))


def _rating_text(unscaled: Column) -> Column:
    """A rating the two ways a connector may send it as text: decimal digits, or base64 for updates."""
    plain = (unscaled / F.lit(100)).cast("decimal(3,2)").cast("string")
    packed = F.base64(F.unhex(F.lpad(F.hex(unscaled.cast("bigint")), 4, "0")))
    return F.when(F.col("op") == S.UPDATE, packed).otherwise(plain)


def base64_of_decimal(value: Column) -> Column:
    """A whole decimal as base64 of its big-endian two's complement bytes, as few as it needs."""
    step = F.lit(Decimal(1 << 48)).cast("decimal(15,0)")
    whole, shown = value.cast("decimal(38,0)"), F.lit("")
    for _ in range(3):
        part = F.pmod(whole, step).cast("decimal(15,0)")
        shown = F.concat(F.lpad(F.hex(part.cast("bigint")), 12, "0"), shown)
        whole = F.floor((whole - part) / step).cast("decimal(38,0)")
    return F.base64(F.unhex(F.regexp_replace(shown, "^(00)+(?=[0-7])|^(FF)+(?=[89A-F])", "")))


def messages(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Raw messages of two topics, even users as customers and odd users as drivers.

    Updates come as bare envelopes, the rest wrapped; every delete is followed by a tombstone. With ``spread`` all tasks
    write them, however few row groups the events come in.
    """
    events = _events(spark, sf_dir)
    half = F.pmod("user_id", F.lit(2))
    if spread:
        # By hash: dealt in turn, rows would be sorted first so that a repeated task deals them alike. The generator holds
        # the filters above the shuffle, so that events are read and dealt once for both topics.
        events = events.repartition("event_id", "ts_ms", "user_id").select("*", F.explode(F.array(half)).alias("half"))
        half = F.col("half")
    offset = F.col("event_id") * 2
    user = F.col("user_id").cast("string")
    k = F.col("k")
    customers = bronze_of(events.filter(half == 0), S.CUSTOMERS, {
        "id": F.col("user_id").cast("int"),
        "name": F.concat(F.lit("user-"), user),
        "email": F.concat(F.col("event_id").cast("string"), F.lit("@example.com")),
        "country": F.concat(F.lit("country-"), k.cast("string")),
    }, offset)
    drivers = bronze_of(events.filter(half == 1), S.DRIVERS, {
        "id": F.col("user_id").cast("int"),
        "name": F.concat(F.lit("user-"), user),
        "license_number": F.concat(F.lit("TLC-"), F.col("event_id").cast("string")),
        "rating": _rating_text(k * 5),
        "city": F.concat(F.lit("city-"), k.cast("string")),
        "active": k >= 50,
    }, offset)
    wrapped = F.col("op") != S.UPDATE
    return (to_envelope(customers, S.CUSTOMERS, wrapped, tombstones=True)
            .unionByName(to_envelope(drivers, S.DRIVERS, wrapped, tombstones=True)))


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages, some replaced by unusable ones depending on the event's ``k``."""
    # K of the damaged events and what becomes of them.
    replacements = {
        7: "not json",
        11: '{"payload":{"after":{"id":1,"na',
        13: '{"payload":{"op":"t","ts_ms":1}}',
        17: '{"payload":{"op":"m","after":{"id":1}}}',
        19: '{"payload":{"op":"c","after":{"name":"nobody"}}}',
        23: '{"payload":{"op":"c","after":{"id":"x"}}}',
        29: '{"payload":{"ts_ms":1}}',
    }
    value = F.col("value").cast("string")
    for k, text in replacements.items():
        value = F.when(F.col("k") == k, F.lit(text)).otherwise(value)
    # The tombstone after a delete has the next offset and stays.
    offsets = _events(spark, sf_dir).select((F.col("event_id") * 2).alias("offset"), "k")
    log = messages(spark, sf_dir).join(offsets, "offset", "left")
    return log.select("key", value.cast("binary").alias("value"), "topic", "partition", "offset", "timestamp")


def trips(spark: SparkSession, sf_dir: str, zones: int = 25) -> DataFrame:
    """All events as trips, some of which break a quality rule."""
    k = F.col("k")
    tip = (F.when(F.col("event_type") == "view", F.lit(0.0))
           .when((F.col("event_type") == "error") & (k < 10), F.lit(-1.0))
           .otherwise(F.col("amount") * k / F.lit(300)))
    return _events(spark, sf_dir).select(
        F.col("event_id").alias("trip_id"),
        F.pmod("user_id", F.lit(zones)).cast("int").alias("PULocationID"),
        F.pmod(k, F.lit(30)).alias("DOLocationID"),
        (F.col("amount") - F.lit(1.0)).alias("fare_amount"),
        tip.alias("tip_amount"),
        F.when(F.pmod(k, F.lit(17)) != 0, F.pmod(k, F.lit(6))).alias("payment_type"),
        (k.cast("double") / F.lit(10.0)).alias("trip_distance"),
        F.col("ts").alias("tpep_pickup_datetime"),
        (F.col("ts") + F.make_dt_interval(mins=k - 5)).alias("tpep_dropoff_datetime"),
        F.pmod(k, F.lit(7)).cast("bigint").alias("passenger_count"),
        F.when(k > 50, F.col("amount")).alias("total_amount"))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("LocationID"), F.col("n_name").alias("Zone"))


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("rating"))


def keyed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as trips that name their driver."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("driver_id"), F.col("l_extendedprice").alias("fare_amount"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("tip_amount"))
