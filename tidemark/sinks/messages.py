"""Rows as messages: keyed JSON events and change envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.values import iso_timestamp, spelled
from tidemark.schemas import DELETE, TRIP_EVENT, TableSpec


def to_events(df: DataFrame, key: str) -> DataFrame:
    """One (key, value) message per row: all columns as JSON, NULLs kept, timestamps in ISO-8601."""
    times = (T.TimestampType, T.TimestampNTZType)
    columns = [iso_timestamp(F.col(f.name)).alias(f.name) if isinstance(f.dataType, times) else F.col(f.name)
               for f in df.schema]
    return df.select(
        F.col(*spelled(df, key)).cast("string").alias("key"),
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"))


#: Columns that :func:`from_events` adds for messages that are no JSON object of the schema.
RAW_VALUE, REJECT_REASON = "_raw_value", "_reject_reason"


def from_events(messages: DataFrame, schema: T.StructType = TRIP_EVENT, rejects: bool = False) -> DataFrame:
    """Rows back from JSON messages; a field that does not parse is NULL.

    With ``rejects`` two more columns say what could not be read: the message and the reason, both NULL otherwise.
    """
    text = F.col("value").cast("string")
    corrupt = T.StructType([*schema.fields, T.StructField(RAW_VALUE, T.StringType())])
    row = F.from_json(text, corrupt, {"columnNameOfCorruptRecord": RAW_VALUE})
    parsed = messages.select(row.alias("row"), text.alias("text"))
    if not rejects:
        return parsed.select(*[F.col(f"row.{c}").alias(c) for c in schema.names])
    reason = (F.when(F.col("text").isNull(), "empty").when(F.col("row.{}".format(RAW_VALUE)).isNotNull(), "unparseable"))
    return parsed.select(*[F.col(f"row.{c}").alias(c) for c in schema.names],
                         F.when(reason.isNotNull(), F.col("text")).alias(RAW_VALUE), reason.alias(REJECT_REASON))


def to_envelope(changes: DataFrame, spec: TableSpec, wrapped: Column | bool = True,
                tombstones: bool = False) -> DataFrame:
    """Bronze rows as raw messages, the inverse of parsing them.

    With ``tombstones`` every delete is followed, at the next offset, by a message without a value.
    """
    def image(side: str) -> Column:
        present = F.col(f"{side}_{spec.key}").isNotNull()
        return F.when(present, F.struct(*[F.col(f"{side}_{c}").alias(c) for c in spec.columns.names])).alias(side)

    body = F.struct(image("before"), image("after"),
                    F.struct(F.col("source_table").alias("table"), F.col("source_lsn").alias("lsn")).alias("source"),
                    F.col("op"), F.col("ts_ms"))
    wrapped = wrapped if isinstance(wrapped, Column) else F.lit(wrapped)
    text = F.when(wrapped, F.to_json(F.struct(body.alias("payload")))).otherwise(F.to_json(body))
    value = text.cast("binary")
    key = F.coalesce(F.col(f"after_{spec.key}"), F.col(f"before_{spec.key}"))
    sent = changes.withColumn("value", value)
    if tombstones:
        pair = F.array(value, F.lit(None).cast("binary"))
        # Position 0 is the event itself, position 1 its tombstone.
        sent = (changes.drop("value").select("*", F.posexplode(pair).alias("_at", "value"))
                .filter((F.col("_at") == 0) | (F.col("op") == DELETE))
                .withColumn("kafka_offset", F.col("kafka_offset") + F.col("_at")))
    return sent.select(
        F.to_json(F.struct(key.alias(spec.key))).cast("binary").alias("key"),
        "value",
        "topic",
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"))
