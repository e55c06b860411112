"""What each run took in: offsets reached, events read and applied, rows live afterwards.

A run is a folder of a few rows, one per topic partition. The offsets of the newest run say where the next one starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.sources.files import read_if_present

OFFSETS = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("next_offset", T.LongType()),
])

RUN = T.StructType([
    *OFFSETS,
    T.StructField("from_offset", T.LongType()),
    T.StructField("events_read", T.LongType()),
    T.StructField("applied", T.LongType()),
    T.StructField("live_rows", T.LongType()),
    T.StructField("rejected", T.MapType(T.StringType(), T.LongType())),
    T.StructField("operation", T.StringType()),
    T.StructField("finished_at", T.TimestampType()),
])


def _runs(spark: SparkSession, path: str) -> DataFrame:
    found = read_if_present(spark, path, T.StructType([*RUN, T.StructField("run", T.LongType())]))
    return spark.createDataFrame([], T.StructType([*RUN, T.StructField("run", T.LongType())])) if found is None else found


def newest_run(spark: SparkSession, path: str) -> int | None:
    return _runs(spark, path).agg(F.max("run").alias("run")).head().run


def save_run(offsets: DataFrame, path: str, operation: str = "refresh") -> int:
    """Record a run; ``offsets`` has the columns of OFFSETS, those of RUN that it lacks are NULL. Returns its number."""
    spark = offsets.sparkSession
    last = newest_run(spark, path)
    number = 0 if last is None else last + 1
    columns = [F.current_timestamp().alias(f.name) if f.name == "finished_at" else
               F.lit(operation).alias(f.name) if f.name == "operation" else
               F.col(f.name).cast(f.dataType).alias(f.name) if f.name in offsets.columns else
               F.lit(None).cast(f.dataType).alias(f.name) for f in RUN]
    # A row per topic partition.
    offsets.select(*columns).coalesce(1).write.mode("overwrite").parquet(f"{path}/run={number}")
    return number


def load_offsets(spark: SparkSession, path: str, run: int | None = None) -> DataFrame:
    """The offsets reached by a run, by default the newest; empty before the first run."""
    wanted = newest_run(spark, path) if run is None else run
    return _runs(spark, path).filter(F.col("run") == F.lit(wanted).cast("bigint")).select(*OFFSETS.names)


def list_runs(spark: SparkSession, path: str) -> DataFrame:
    """Runs, newest first, with the events of all partitions together."""
    return (_runs(spark, path).groupBy("run")
            .agg(F.max("operation").alias("operation"), F.max("finished_at").alias("finished_at"),
                 F.sum("events_read").alias("events_read"), F.sum("applied").alias("applied"),
                 F.sum("live_rows").alias("live_rows"), F.sum("next_offset").alias("offsets"))
            .orderBy(F.desc("run")))


def live_rows_after(spark: SparkSession, path: str, topic: str) -> int | None:
    """Live rows that the newest run counted for a topic's table, None if it did not."""
    last = newest_run(spark, path)
    rows = _runs(spark, path).filter((F.col("run") == F.lit(last).cast("bigint")) & (F.col("topic") == topic))
    return rows.agg(F.sum("live_rows").alias("n")).head().n


def return_to(spark: SparkSession, path: str, run: int) -> int:
    """A new run that stands where an earlier one stood: what came after it is read again by the next refresh."""
    return save_run(load_offsets(spark, path, run), path, "rollback")
