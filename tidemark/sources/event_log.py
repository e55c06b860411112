"""Reading change messages: whole topics, offset ranges, saved batches."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.schemas import TableSpec

Offsets = dict[tuple[str, int], int]


def topic_pattern(specs: Iterable[TableSpec]) -> str:
    """Matches the topics of the given tables and no others."""
    return "|".join(sorted(re.escape(spec.topic) for spec in specs))


def read_kafka(spark: SparkSession, servers: str, specs: Iterable[TableSpec],
               start: Offsets | None = None, end: Offsets | None = None,
               min_partitions: int | None = None) -> DataFrame:
    """Bounded read of the tables' topics, from earliest to latest unless maps say otherwise.

    Kafka wants every partition in a map; ``complete_start`` fills one up. ``min_partitions`` lets Spark split the
    offset range of a topic partition that holds much of the log.
    """
    reader = (spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribePattern", topic_pattern(specs)))
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return (reader.option("startingOffsets", _kafka_offsets(start, "earliest"))
            .option("endingOffsets", _kafka_offsets(end, "latest")).load())


#: Kafka's number for the earliest offset of a partition.
EARLIEST = -2


def complete_start(start: Offsets, end: Offsets) -> Offsets:
    """A start for every partition of ``end``: one never read before starts at its earliest offset."""
    return {partition: start.get(partition, EARLIEST) for partition in end}


def _kafka_offsets(offsets: Offsets | None, default: str) -> str:
    if offsets is None:
        return default
    by_topic: dict[str, dict[str, int]] = {}
    for (topic, partition), offset in offsets.items():
        by_topic.setdefault(topic, {})[str(partition)] = offset
    return json.dumps(by_topic)


def read_event_log(log: DataFrame, specs: Iterable[TableSpec]) -> DataFrame:
    """Messages of the tables' topics."""
    return log.filter(F.col("topic").isin(*[spec.topic for spec in specs]))


def read_topic(log: DataFrame, topic: str) -> DataFrame:
    return log.filter(F.col("topic") == topic)


def per_partition(values: Offsets, topic: Column, partition: Column) -> Column:
    """The value of a row's (topic, partition), NULL without one.

    Partitions of a topic count from zero, so a topic's values are an array and each row indexes it: the cost per row
    does not depend on the number of partitions.
    """
    by_topic: dict[str, dict[int, int]] = {}
    for (name, number), value in values.items():
        by_topic.setdefault(name, {})[number] = value
    found = F.lit(None).cast("bigint")
    for name, known in sorted(by_topic.items()):
        array = F.lit([known.get(i, -1) for i in range(max(known) + 1)]).cast("array<bigint>")
        value = F.get(array, partition)
        found = F.when(topic == name, F.when(value >= 0, value)).otherwise(found)
    return found


def read_offsets(log: DataFrame, end: Offsets, start: Offsets | None = None, partition: str = "partition",
                 offset: str = "offset") -> DataFrame:
    """Messages with start <= offset < end, per (topic, partition).

    ``end`` names the partitions to read; one without a start is read from its beginning. The maps are
    driver-side values with one entry per partition, so their size is bounded by the topic layout. The log is
    only ever filtered: by topic and least and greatest offset in the scan, by its partition's bounds after it.
    """
    start = start or {}
    if not end:
        return log.filter(F.lit(False))
    lows = {p: max(0, start.get(p, 0)) for p in end}
    at = F.col(offset)
    coarse = log.filter(F.col("topic").isin(*sorted({topic for topic, _ in end})) & (at >= min(lows.values()))
                        & (at < max(end.values())))
    return coarse.filter((at >= per_partition(lows, F.col("topic"), F.col(partition)))
                         & (at < per_partition(end, F.col("topic"), F.col(partition))))


CHECKPOINT_BATCH = T.StructType([
    T.StructField("from", T.LongType()),
    T.StructField("to", T.LongType()),
    T.StructField("events", T.ArrayType(T.StructType([
        T.StructField("offset", T.LongType()),
        T.StructField("value", T.StringType()),
    ]))),
])


def read_checkpoint_batches(spark: SparkSession, path: str, topic: str, partition: int | None = None) -> DataFrame:
    """Messages kept in saved batches, one JSON document {from, to, events} per file.

    A batch holds offsets of one partition. Which one is not in the document: it is the value of a folder
    ``partition=<n>`` below ``path``, or ``partition`` for files without such a folder.
    """
    batches = spark.read.schema(CHECKPOINT_BATCH).option("multiLine", True).json(path)
    where = F.regexp_extract("_metadata.file_path", r"/partition=(\d+)/", 1)
    number = F.when(where != "", where.cast("int"))
    if partition is not None:
        number = F.coalesce(number, F.lit(partition))
    unknown = F.raise_error(F.concat(F.lit("partition of saved batch unknown: "), F.col("_metadata.file_path")))
    return messages_of_batches(batches.withColumn("partition", F.coalesce(number, unknown.cast("int"))), topic)


def messages_of_batches(batches: DataFrame, topic: str) -> DataFrame:
    """One message per saved event; each batch covers offsets from <= offset < to of its ``partition``."""
    return (batches.select("partition", F.explode("events").alias("event"))
            .select(F.lit(None).cast("binary").alias("key"),
                    F.col("event.value").cast("binary").alias("value"),
                    F.lit(topic).alias("topic"),
                    F.col("partition").cast("int").alias("partition"),
                    F.col("event.offset").alias("offset"),
                    F.lit(None).cast("timestamp").alias("timestamp")))
