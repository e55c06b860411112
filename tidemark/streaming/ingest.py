"""Continuous ingest: messages to bronze, bronze to mirrors, trip events to bronze.

All run with the trigger ``availableNow`` unless given another one: take what is there, in batches, then stop.
Restarting with the same checkpoint continues; with nothing new no batch runs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark import schemas as S
from tidemark.operators.envelope import bronze_table, message_columns, problem
from tidemark.operators.ids import assign_ids
from tidemark.operators.offsets import event_counts
from tidemark.operators.trips import clean_trips, enrich_zones
from tidemark.session import side_by_side
from tidemark.sinks import deltas
from tidemark.sinks.messages import REJECT_REASON, from_events
from tidemark.sinks.mirrors import Log, merge_into_mirror
from tidemark.sinks.tables import append_events, batch_bounds
from tidemark.sources.event_log import topic_pattern


def message_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Messages from a growing folder of Parquet files."""
    reader = spark.readStream.schema(S.MESSAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def kafka_stream(spark: SparkSession, servers: str, specs: Iterable[S.TableSpec],
                 offsets_per_batch: int | None = None) -> DataFrame:
    """Messages of the tables' Kafka topics, at most so many per batch."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribePattern", topic_pattern(specs)).option("startingOffsets", "earliest"))
    if offsets_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_batch)
    return reader.load()


def bronze_path(root: str, spec: S.TableSpec) -> str:
    return f"{root}/bronze_{spec.name}"


def ingest_messages(messages: DataFrame, specs: list[S.TableSpec], root: str,
                    partitions: dict[str, list[int]] | None = None) -> dict[str, dict[str, int | None] | None]:
    """One batch of messages into the bronze table of each topic.

    Safe to repeat: offsets that are stored already are not stored again. Unusable messages are kept
    like all others and can be listed from bronze at any time.

    With ``partitions`` per topic, the write of each table also counts its events (``offsets.event_counts``); the counts
    come back by table, None where part of the batch had been stored before.
    """
    ids = message_columns(messages).select(*S.EVENT_ID)
    bounds = batch_bounds(ids)

    def append(spec: S.TableSpec) -> dict[str, int | None] | None:
        of_table = [row for row in bounds if row.topic == spec.topic]
        counts = event_counts(spec, partitions.get(spec.topic, ()), F.col("_reason")) if partitions is not None else None
        return append_events(bronze_table(messages, spec), bronze_path(root, spec), bounds=of_table, counts=counts,
                             given={"_reason": problem(spec)})

    return dict(zip([spec.name for spec in specs], side_by_side(messages.sparkSession, append, specs), strict=True))


def _start(writer: DataStreamWriter, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def stream_bronze(messages: DataFrame, specs: list[S.TableSpec], root: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Messages to bronze tables. Each table reads the messages of its own topic from the source."""
    def batch(df: DataFrame, batch_id: int) -> None:
        ingest_messages(df, specs, root)

    return _start(messages.writeStream.foreachBatch(batch), checkpoint, trigger)


def bronze_stream(spark: SparkSession, root: str, spec: S.TableSpec, files_per_batch: int | None = None) -> DataFrame:
    """Bronze rows of one table as they are appended."""
    reader = spark.readStream.schema(spec.bronze_schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(bronze_path(root, spec))


def stream_silver(events: DataFrame, table: str, spec: S.TableSpec, checkpoint: str, buckets: int = 16,
                  trigger: dict | None = None, log: Log | None = None) -> StreamingQuery:
    """Bronze rows merged into a stored mirror. A batch that is repeated after a failure changes nothing more.

    ``log`` gives the bronze table that the events come from; buckets that a batch left half-written are rebuilt from it.
    """
    def batch(df: DataFrame, batch_id: int) -> None:
        merge_into_mirror(df, table, spec, buckets, log)

    return _start(events.writeStream.foreachBatch(batch), checkpoint, trigger)


def stream_deltas(events: DataFrame, table: str, spec: S.TableSpec, checkpoint: str, fold_share: float = 0.1,
                  trigger: dict | None = None) -> StreamingQuery:
    """Bronze rows as one delta per batch over a base, folded as they grow; a repeated batch replaces its delta."""
    def batch(df: DataFrame, batch_id: int) -> None:
        deltas.append_delta(df, table, spec, batch_id)
        deltas.fold(df.sparkSession, table, spec, fold_share)

    return _start(events.writeStream.foreachBatch(batch), checkpoint, trigger)


def trip_stream(spark: SparkSession, path: str, schema: T.StructType = S.TRIP_EVENT,
                files_per_batch: int | None = None) -> DataFrame:
    """Trip events from a growing folder of JSON lines; a line that is none comes with its text and a reason."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return from_events(reader.text(path), schema, rejects=True)


def stream_trips(trips: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Trip events to bronze Parquet, each exactly once."""
    writer = trips.writeStream.format("parquet").outputMode("append").option("path", path)
    return _start(writer, checkpoint, trigger)


def bronze_trip_stream(spark: SparkSession, path: str, schema: T.StructType = S.TRIP_EVENT) -> DataFrame:
    """Streamed bronze trips as they are appended, without the lines that were no trips."""
    columns = T.StructType([*schema.fields, T.StructField(REJECT_REASON, T.StringType())])
    return spark.readStream.schema(columns).parquet(path).filter(F.col(REJECT_REASON).isNull()).drop(REJECT_REASON)


def stream_trips_silver(trips: DataFrame, zones: DataFrame, path: str, checkpoint: str,
                        trigger: dict | None = None) -> StreamingQuery:
    """Bronze trips, cleaned and with zone names, appended to silver by day of pickup.

    ``trip_id`` is the content's fingerprint, as a stream has no other that stays the same when a batch is repeated.
    """
    clean = enrich_zones(clean_trips(assign_ids(trips, "hash")), zones)
    writer = (clean.withColumn("pickup_date", F.to_date("tpep_pickup_datetime")).writeStream.format("parquet")
              .outputMode("append").partitionBy("pickup_date").option("path", path))
    return _start(writer, checkpoint, trigger)
