"""Declared schemas: messages, source tables, trips."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Operation codes of the change envelope.
SNAPSHOT, CREATE, UPDATE, DELETE, TRUNCATE = "r", "c", "u", "d", "t"
UPSERTS = (SNAPSHOT, CREATE, UPDATE)
KNOWN_OPS = (SNAPSHOT, CREATE, UPDATE, DELETE)

# Fixed value: topics are named <server>.<schema>.<table>; a spec may name another server and schema.
TOPIC_PREFIX = "dbserver1.public."

MESSAGE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

# Identity of a message; offsets of different partitions are not comparable.
EVENT_ID = ["topic", "kafka_partition", "kafka_offset"]

EVENT_HEADER = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("kafka_timestamp", T.TimestampType()),
    T.StructField("source_table", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("source_lsn", T.LongType()),
])


@dataclass(frozen=True)
class TableSpec:
    """One source table: name, key column and typed columns, the key included, and the prefix of its topic.

    Field metadata says how a JSON value is encoded: ``decimal_scale`` allows the base64 form of a
    decimal next to plain numbers, and ``base64_only`` says that nothing else comes (four characters of
    base64 can look like a number); ``micros`` marks a timestamp held as microseconds.
    """

    name: str
    key: str
    columns: T.StructType
    prefix: str = TOPIC_PREFIX

    @property
    def topic(self) -> str:
        return self.prefix + self.name

    @property
    def attributes(self) -> list[str]:
        return [c.name for c in self.columns if c.name != self.key]

    @property
    def bronze_schema(self) -> T.StructType:
        """Header, then the flattened row images, then the raw message."""
        images = [T.StructField(f"{side}_{self.key}", self.columns[self.key].dataType)
                  for side in ("after", "before")]
        for side in ("after", "before"):
            images += [T.StructField(f"{side}_{name}", self.columns[name].dataType)
                       for name in self.attributes]
        return T.StructType(EVENT_HEADER.fields + images + [T.StructField("value", T.StringType())])

    def with_column(self, name: str, data_type: T.DataType) -> TableSpec:
        """The same table after a column was added at the source."""
        return replace(self, columns=T.StructType(self.columns.fields + [T.StructField(name, data_type)]))


CUSTOMERS = TableSpec("customers", "id", T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("country", T.StringType()),
]))

DRIVERS = TableSpec("drivers", "id", T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("license_number", T.StringType()),
    T.StructField("rating", T.DoubleType(), True, {"decimal_scale": 2}),
    T.StructField("city", T.StringType()),
    T.StructField("active", T.BooleanType()),
]))


def with_created_at(spec: TableSpec) -> TableSpec:
    """Adds the creation time, which the envelope carries in microseconds."""
    field = T.StructField("created_at", T.TimestampType(), True, {"micros": True})
    return replace(spec, columns=T.StructType(spec.columns.fields + [field]))


# Columns of a trip file that the cleaning step reads, with their clean types.
TRIP_COLUMNS = {
    "PULocationID": "int",
    "DOLocationID": "int",
    "fare_amount": "double",
    "tip_amount": "double",
    "payment_type": "int",
    "trip_distance": "double",
    "tpep_pickup_datetime": "timestamp",
    "tpep_dropoff_datetime": "timestamp",
}

# All fields of a yellow-taxi trip record, as of 2025.
TRIP_EVENT = T.StructType([
    T.StructField("VendorID", T.IntegerType()),
    T.StructField("tpep_pickup_datetime", T.TimestampType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampType()),
    T.StructField("passenger_count", T.LongType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("RatecodeID", T.LongType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("payment_type", T.IntegerType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("extra", T.DoubleType()),
    T.StructField("mta_tax", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("improvement_surcharge", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("congestion_surcharge", T.DoubleType()),
    T.StructField("Airport_fee", T.DoubleType()),
    T.StructField("cbd_congestion_fee", T.DoubleType()),
])
