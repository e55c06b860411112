"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialize

#: Rows an Arrow batch holds at most, so that a batch of very long texts still fits in a worker.
BATCH_ROWS = 512


class Kept(dict):
    """Values worked out once per key, for the keys used lately: at most twice ``most`` of them.

    When it is full, its content becomes the older half and what that held is forgotten; keys still in use come back
    from there. Very long keys are not kept.
    """

    def __init__(self, work: Callable[[str], object], most: int):
        super().__init__()
        self.work, self.most, self.older = work, most, {}

    def __missing__(self, key: str):
        value = self.older.get(key)
        if value is None:
            value = self.work(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        if len(key) <= 64:
            self[key] = value
        return value


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, wherever they start."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        parent, name = os.path.split(package)
        folder = os.path.realpath(tempfile.mkdtemp(prefix=f"{name}-code-"))
        context.addPyFile(shutil.make_archive(os.path.join(folder, name), "zip", parent, name))
        _shipped.add(context.applicationId)


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema) -> DataFrame:
    """``mapInArrow`` with batches small enough for long texts."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(function, schema)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The columns of exactly these names, renamed to the keywords; others may differ from them only by case."""
    places = [f"_{i}" for i in range(len(df.columns))]
    found = {name: places[df.columns.index(source)] for name, source in columns.items()}
    return df.toDF(*places).select(*[F.col(place).alias(name) for name, place in found.items()])


def with_whole_rows(df: DataFrame, **columns: str) -> DataFrame:
    """``pick``, and all columns of ``df`` together as ``whole``, whatever their names."""
    places = [f"_{i}" for i in range(len(df.columns))]
    found = [F.col(places[df.columns.index(source)]).alias(name) for name, source in columns.items()]
    return df.toDF(*places).select(*found, F.struct(*places).alias("whole"))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column of exactly this name; other columns may differ from it only by case."""
    return batch.column(batch.schema.get_field_index(name))


def replace_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return batch.set_column(batch.schema.get_field_index(name), batch.schema.field(name), values)


def map_whole_rows(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch], dict], Iterator[pa.RecordBatch]],
                   *columns: str) -> DataFrame:
    """``mapInArrow`` over all columns that keeps the schema; ``function`` also gets the columns' names in the batches.

    Columns have other names on the way, so that two of ``df`` may differ by case only.
    """
    places = [f"_{i}" for i in range(len(df.columns))]
    named = {c: places[df.columns.index(c)] for c in columns}
    plain = df.toDF(*places)
    return map_batches(plain, lambda batches: function(batches, named), plain.schema).toDF(*df.columns)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe from lost executors."""
    return materialize(df, label)


def fold(doc_id: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus
