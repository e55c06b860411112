"""Id ranges of batches, given out from a table of a row per batch and not from the ids in use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources.files import finished, folders

_SCHEMA = "batch string, first_id long, rows long"


def allocations(spark: SparkSession, path: str) -> DataFrame:
    """Every range given out: batch, first_id, rows, and the order in which they were given."""
    names = [name for name in folders(spark, path) if finished(spark, f"{path}/{name}")]
    if not names:
        return spark.createDataFrame([], _SCHEMA + ", number int")
    found = spark.read.schema(_SCHEMA + ", number int").option("basePath", path).parquet(*[f"{path}/{name}" for name in names])
    return found.select("batch", "first_id", "rows", "number")


def allocate(spark: SparkSession, path: str, batch: str, rows: int) -> int:
    """First id of a batch of so many rows.

    A batch that asks again gets the range it has, so that repeating it gives the same ids. One that has grown gets a
    new range at the end; its old ids are not given to others. A range is stored before it is used, under a name nobody
    used before: what dies in between wastes a range at most. One writer.
    """
    given = allocations(spark, path).collect()  # a row per batch
    held = [r for r in given if r.batch == batch and r.rows >= rows]
    if held:
        return max(held, key=lambda r: r.number).first_id
    first = max((r.first_id + r.rows for r in given), default=0)
    number = max((int(name.removeprefix("number=")) for name in folders(spark, path)), default=-1) + 1
    row = spark.createDataFrame([(batch, first, rows)], _SCHEMA)
    row.coalesce(1).write.parquet(f"{path}/number={number}")
    return first
