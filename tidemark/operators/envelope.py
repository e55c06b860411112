"""From raw change messages to typed change rows.

An envelope is read once per row by a single ``from_json`` whose leaves are text; the declared types
follow by ``try_cast``, so one bad value becomes NULL instead of failing the job or losing the row.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark import schemas as S
from tidemark.functions.values import typed_value

_CORRUPT = "_corrupt_record"
_MESSAGE_NAMES = ["topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "source_table"]


def drop_tombstones(log: DataFrame) -> DataFrame:
    return log.filter(F.col("value").isNotNull())


def message_columns(log: DataFrame) -> DataFrame:
    """Message metadata under its bronze names, the table named by the topic, and the value as text."""
    return log.select(
        "topic",
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        # The last word, tried at the starts of words only.
        F.regexp_extract("topic", r"(?<!\w)(\w++)$", 1).alias("source_table"),
        F.col("value").cast("string").alias("value"),
    )


def _envelope_schema(image: T.DataType) -> T.StructType:
    body = [
        T.StructField("before", image),
        T.StructField("after", image),
        T.StructField("source", T.StructType([T.StructField("lsn", T.StringType())])),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.StringType()),
    ]
    return T.StructType(body + [T.StructField("payload", T.StructType(body)),
                                T.StructField(_CORRUPT, T.StringType())])


def parse_envelope(log: DataFrame, spec: S.TableSpec | None = None) -> DataFrame:
    """Header fields plus the row images ``before`` and ``after``, still as text.

    Takes envelopes both wrapped in ``payload`` and bare. With a spec the images are structs of its
    columns; without one they are maps, which keeps the fields of tables nobody declared.
    """
    image = (T.StructType([T.StructField(c.name, T.StringType()) for c in spec.columns]) if spec
             else T.MapType(T.StringType(), T.StringType()))
    parsed = message_columns(drop_tombstones(log)).withColumn(
        "_e", F.from_json("value", _envelope_schema(image), {"columnNameOfCorruptRecord": _CORRUPT}))

    def part(name: str):
        return F.coalesce(F.col(f"_e.payload.{name}"), F.col(f"_e.{name}"))

    return parsed.select(
        *_MESSAGE_NAMES,
        part("op").alias("op"),
        part("ts_ms").try_cast("bigint").alias("ts_ms"),
        part("source.lsn").try_cast("bigint").alias("source_lsn"),
        part("before").alias("before"),
        part("after").alias("after"),
        F.col(f"_e.{_CORRUPT}").isNotNull().alias("is_corrupt"),
        "value",
    )


def flatten(parsed: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Bronze rows of one table: the header, then typed after_* and before_* columns."""
    def image(side: str, name: str):
        return typed_value(F.col(f"{side}.{name}"), spec.columns[name]).alias(f"{side}_{name}")

    keys = [image(side, spec.key) for side in ("after", "before")]
    attributes = [image(side, name) for side in ("after", "before") for name in spec.attributes]
    return parsed.select(*S.EVENT_HEADER.names, *keys, *attributes, "value")


def bronze_table(log: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Bronze rows of one table straight from the message log."""
    return flatten(parse_envelope(log.filter(F.col("topic") == spec.topic), spec), spec)


def route(log: DataFrame, specs: Iterable[S.TableSpec]) -> dict[str, DataFrame]:
    """One bronze frame per table. Each message is parsed only in the route of its own topic."""
    return {spec.name: bronze_table(log, spec) for spec in specs}


def count_by_table(log: DataFrame) -> DataFrame:
    """Messages, without tombstones, per source table."""
    return (message_columns(drop_tombstones(log)).groupBy("source_table")
            .agg(F.count(F.lit(1)).alias("events")))


def event_key(spec: S.TableSpec) -> Column:
    """Key of an event; a delete only has a before image."""
    return F.coalesce(F.col(f"after_{spec.key}"), F.col(f"before_{spec.key}"))


#: What :func:`problem` can say.
PROBLEMS = ("missing_op", "truncate", "unknown_op", "missing_key", "missing_after")


def problem(spec: S.TableSpec) -> Column:
    """Why a bronze row cannot be applied, NULL if it can: the one rule for mirrors, counts and quarantine.

    An upsert needs a key after the change, a delete one on either side; keys count if they have the declared type.
    """
    upsert, key = F.col("op").isin(*S.UPSERTS), event_key(spec)
    return (F.when(F.col("op").isNull(), "missing_op")
            .when(F.col("op") == S.TRUNCATE, "truncate")
            .when(~F.col("op").isin(*S.KNOWN_OPS), "unknown_op")
            .when(key.isNull(), "missing_key")
            .when(upsert & F.col(f"after_{spec.key}").isNull(), "missing_after"))


def quarantine(log: DataFrame, specs: Iterable[S.TableSpec]) -> DataFrame:
    """Messages of declared tables that cannot be applied to a mirror, with the raw value and a reason.

    Together with the applied ones these are all messages but tombstones.
    """
    return reduce(DataFrame.unionByName, [_quarantine(log, spec) for spec in specs])


def _quarantine(log: DataFrame, spec: S.TableSpec) -> DataFrame:
    parsed = parse_envelope(log.filter(F.col("topic") == spec.topic), spec)
    keys = [typed_value(F.col(f"{side}.{spec.key}"), spec.columns[spec.key]).alias(f"{side}_{spec.key}")
            for side in ("after", "before")]
    text = F.coalesce(F.col(f"after.{spec.key}"), F.col(f"before.{spec.key}"))
    typed = parsed.select(*_MESSAGE_NAMES, "op", "is_corrupt", text.alias("_key"), *keys, "value")
    reason = (F.when(F.col("is_corrupt") & F.col("op").isNull(), "unparseable")
              .when((problem(spec) == "missing_key") & F.col("_key").isNotNull(), "bad_key").otherwise(problem(spec)))
    # The generator holds the filter above the parsing, which would otherwise be repeated inside it.
    return (typed.select(*_MESSAGE_NAMES, F.explode(F.array(reason)).alias("reason"), "value")
            .filter(F.col("reason").isNotNull()))


def quarantined(bronze: DataFrame, spec: S.TableSpec) -> DataFrame:
    """The unusable rows of a bronze table. Only these are parsed again, to tell why."""
    return _quarantine(as_messages(bronze.filter(problem(spec).isNotNull())), spec)


def as_messages(bronze: DataFrame) -> DataFrame:
    """Bronze rows as the messages they came from."""
    return bronze.select(
        F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), "topic",
        F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"))


def evolve(bronze: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Bronze rows widened to a newer spec: columns that were unknown then are NULL."""
    wanted = spec.bronze_schema
    present = set(bronze.columns)
    return bronze.select(*[F.col(f.name).cast(f.dataType) if f.name in present
                           else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted])


def reparse(bronze: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Bronze rows read again from their raw value under a newer spec."""
    return bronze_table(as_messages(bronze), spec)
