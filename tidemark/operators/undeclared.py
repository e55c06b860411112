"""Changes of tables that nobody declared: row images as VARIANT, which keeps nested and typed values, and a declaration
proposed from the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark import schemas as S
from tidemark.operators.envelope import drop_tombstones, message_columns


def parse_variants(log: DataFrame) -> DataFrame:
    """Header fields plus the row images ``before`` and ``after`` as VARIANT, from envelopes wrapped in ``payload`` or bare.

    A value is parsed once; what is no JSON has ``is_corrupt`` and NULL fields.
    """
    parsed = message_columns(drop_tombstones(log)).withColumn("_v", F.try_parse_json("value"))
    body = parsed.withColumn("_b", F.coalesce(F.try_variant_get("_v", "$.payload", "variant"), F.col("_v")))

    def part(path: str, kind: str) -> Column:
        return F.try_variant_get("_b", f"$.{path}", kind)

    return body.select(
        "topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "source_table",
        part("op", "string").alias("op"), part("ts_ms", "bigint").alias("ts_ms"), part("source.lsn", "bigint").alias("source_lsn"),
        part("before", "variant").alias("before"), part("after", "variant").alias("after"),
        F.col("_v").isNull().alias("is_corrupt"), "value")


def field(image: str, name: str, kind: str | T.DataType) -> Column:
    """A top-level field of a row image in a type; NULL where it is absent or does not convert. Objects come as JSON."""
    shown = kind if isinstance(kind, str) else kind.simpleString()
    return F.try_variant_get(image, f"$['{name}']", shown)


def propose_spec(parsed: DataFrame, name: str, key: str, prefix: str = S.TOPIC_PREFIX) -> S.TableSpec:
    """A declaration of a table from the images of all its changes, which Spark folds into one schema.

    Whole numbers become bigint, others double, objects, arrays and fields of several kinds text; only the schema comes
    to the driver. Raises when no image has the key.
    """
    images = parsed.select(F.explode(F.array("before", "after")).alias("image")).filter(F.col("image").isNotNull())
    shown = images.agg(F.schema_of_variant_agg("image")).head()[0]
    found = T.DataType.fromDDL(shown.replace("OBJECT<", "STRUCT<")) if shown.startswith("OBJECT<") else T.StructType([])
    if key not in found.names:
        raise ValueError(f"no change of {name} has a field {key}")

    def kept(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.DecimalType):
            # Variants hold numbers that end as decimals; one without a fraction is a whole number too long for a bigint.
            return T.DoubleType() if kind.scale else kind
        return kind if isinstance(kind, (T.LongType, T.DoubleType, T.BooleanType)) else T.StringType()

    fields = sorted(found.fields, key=lambda f: f.name != key)
    return S.TableSpec(name, key, T.StructType([T.StructField(f.name, kept(f.dataType)) for f in fields]), prefix)


def flatten_variants(parsed: DataFrame, spec: S.TableSpec) -> DataFrame:
    """Bronze rows of a table from its parsed changes, as ``envelope.flatten`` gives them for a declared one."""
    def image(side: str, name: str) -> Column:
        return field(side, name, spec.columns[name].dataType).alias(f"{side}_{name}")

    keys = [image(side, spec.key) for side in ("after", "before")]
    attributes = [image(side, name) for side in ("after", "before") for name in spec.attributes]
    return parsed.filter(F.col("topic") == spec.topic).select(*S.EVENT_HEADER.names, *keys, *attributes, "value")
