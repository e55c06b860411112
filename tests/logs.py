"""Small change logs used by several tests."""

from __future__ import annotations

import json

from pyspark.sql import types as T

from tidemark.schemas import MESSAGE, TOPIC_PREFIX, TableSpec

PEOPLE = TableSpec("people", "id", T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
]))

# (offset, op, before id, after id, name, ts_ms); op None is a tombstone.
EDGES = [
    (0, "r", None, 1, "Alice", 100),
    (1, "r", None, 2, "Bob", 100),
    (2, "c", None, 3, "Carol", 110),
    (3, "u", 2, 2, "Bob2", 120),
    (4, "u", 2, 2, "Bob3", 120),
    (5, "d", 3, None, None, 130),
    (6, None, None, None, None, None),
    (7, "u", 1, 1, "AliceLate", 90),
    (8, "u", 3, 3, "CarolLate", 125),
    (9, "c", None, 0, "Zero", 140),
    (10, "d", 9, None, None, 150),
    (11, "c", None, 4, "Dan", 160),
    (12, "d", 4, None, None, 170),
    (13, "c", None, 4, "Dan2", 180),
    (14, "t", None, None, None, 190),
]

EDGES_MIRROR = {(0, "Zero", 140), (1, "Alice", 100), (2, "Bob3", 120), (4, "Dan2", 180)}


def envelope(op, ts_ms, before=None, after=None, lsn=None, wrapped=True):
    body = {"before": before, "after": after, "source": {"lsn": lsn}, "op": op, "ts_ms": ts_ms}
    return json.dumps({"schema": {"type": "struct"}, "payload": body} if wrapped else body)


def message(offset, value, table="people", partition=0):
    return (None, None if value is None else value.encode(), TOPIC_PREFIX + table, partition, offset, None)


def log(spark, messages):
    return spark.createDataFrame(messages, MESSAGE)


def edge_log(spark, rows=EDGES):
    def one(offset, op, before, after, name, ts_ms):
        if op is None:
            return message(offset, None)
        image = lambda key: None if key is None else {"id": key, "name": name}
        return message(offset, envelope(op, ts_ms, image(before), image(after), wrapped=offset % 2 == 0))
    return log(spark, [one(*row) for row in rows])


def rows(df):
    return {tuple(r) for r in df.collect()}
