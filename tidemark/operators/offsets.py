"""What has been consumed and what is still to come, per (topic, partition)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, functions as F

from tidemark.operators.envelope import PROBLEMS, problem
from tidemark.schemas import TableSpec
from tidemark.sources.event_log import Offsets


def high_water(bronze: DataFrame) -> DataFrame:
    """Next offset to read, taken from the rows that really are in bronze."""
    return (bronze.groupBy("topic", "kafka_partition")
            .agg((F.max("kafka_offset") + 1).alias("next_offset")))


def pending(log: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored and latest offset of every partition, and how many offsets lie between them.

    ``log`` holds messages, all of them or only those from the stored offsets on, as a Kafka read with
    starting offsets gives; ``stored`` is the result of :func:`high_water`. A partition seen for the
    first time counts from zero, one without messages has no news.
    """
    latest = (log.groupBy("topic", F.col("partition").alias("kafka_partition"))
              .agg((F.max("offset") + 1).alias("latest")))
    known = stored.select("topic", "kafka_partition", F.col("next_offset").alias("from_offset"))
    both = latest.join(known, ["topic", "kafka_partition"], "full_outer").fillna(0, ["from_offset", "latest"])
    reached = F.greatest("from_offset", "latest")
    return both.select("topic", "kafka_partition", "from_offset", reached.alias("to_offset"),
                       (reached - F.col("from_offset")).alias("new_events"))


def offset_ranges(gate: list[Row]) -> tuple[Offsets, Offsets]:
    """Start and end maps of the partitions with news, from the collected rows of :func:`pending`."""
    news = [r for r in gate if r.new_events > 0]
    start = {(r.topic, r.kafka_partition): r.from_offset for r in news}
    end = {(r.topic, r.kafka_partition): r.to_offset for r in news}
    return start, end


def event_counts(spec: TableSpec, partitions: Iterable[int] = (), reason: Column | None = None) -> dict[str, Column]:
    """Aggregates that describe a batch of bronze rows, for a write that counts what it writes.

    Events, their offsets, those applied, those that cannot be by reason, and events and applied ones per partition.
    ``reason`` names a column that holds ``problem(spec)``; without it every count works that out again for each row.
    """
    reason, at = problem(spec) if reason is None else reason, F.col("kafka_offset")
    counts = {"events_read": F.count(F.lit(1)), "from_offset": F.min(at), "to_offset": F.max(at) + 1,
              "applied": F.count_if(reason.isNull())}
    counts |= {f"rejected_{name}": F.count_if(reason == name) for name in PROBLEMS}
    for number in partitions:
        here = F.col("kafka_partition") == number
        counts |= {f"events_read_{number}": F.count_if(here), f"applied_{number}": F.count_if(here & reason.isNull())}
    return counts


def run_summary(bronze: DataFrame, mirror: DataFrame, spec: TableSpec) -> DataFrame:
    """One row on a run: events read, offset range, operations applied, rows now live."""
    usable = problem(spec).isNull()
    live = mirror.agg(F.count(F.lit(1)).alias("n")).scalar()
    return bronze.agg(
        F.count(F.lit(1)).alias("events_read"),
        F.min("kafka_offset").alias("from_offset"),
        (F.max("kafka_offset") + 1).alias("to_offset"),
        F.coalesce(F.sum(usable.cast("bigint")), F.lit(0)).alias("applied"),
    ).withColumn("live_rows", live)
