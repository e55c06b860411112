"""Folding the small files of an append-only log into large ones, in order of partition and offset.

Micro-batches leave many small files, each with a few offsets of every partition. A fold copies the files that are not
folded yet into a segment of few files, sorted by partition and offset, and stores which files it took and which offsets
each new one holds. Reading a stretch of the log opens the files of segments that overlap it, and the small files that
are not folded yet. A segment counts once its bounds are stored; what a fold that died has left is never read. One writer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from tidemark.sources.event_log import Offsets, read_offsets
from tidemark.sources.files import finished, folders, read_if_present, remove

#: Rows of a file of a segment, about.
FILE_ROWS = 5_000_000
_BOUNDS = "file string, topic string, kafka_partition int, low long, high long"


def _segments(path: str) -> str:
    return f"{path}_segments"


def _parts(spark: SparkSession, path: str, kind: str, schema: str) -> list[Row]:
    """Rows on all segments that count: their files' bounds, or the files they took in. A row per file."""
    where = _segments(path)
    done = [name for name in folders(spark, f"{where}/bounds") if finished(spark, f"{where}/bounds/{name}")]
    return spark.read.schema(schema).parquet(*[f"{where}/{kind}/{name}" for name in done]).collect() if done else []


def _loose(spark: SparkSession, path: str, schema: T.StructType | None) -> tuple[DataFrame | None, list[str]]:
    """The log's small files that are not folded yet, as a frame, and their names."""
    everything = read_if_present(spark, path, schema)
    if everything is None:
        return None, []
    taken = {row.file for row in _parts(spark, path, "sources", "file string")}
    names = list(everything.inputFiles())
    left = [name for name in names if name not in taken]
    if len(left) == len(names):
        return everything, left
    if not left:
        return everything.filter(F.lit(False)), left
    return spark.read.schema(everything.schema).option("basePath", path).parquet(*left), left


def read_log(spark: SparkSession, path: str, schema: T.StructType | None = None, end: Offsets | None = None,
             start: Offsets | None = None) -> DataFrame | None:
    """The log, folded or not, or its rows with start <= offset < end; None when nothing was written.

    With bounds, files of segments that hold none of the offsets are not opened.
    """
    start = start or {}

    def overlaps(row: Row) -> bool:
        key = (row.topic, row.kafka_partition)
        return end is None or (row.low < end.get(key, 0) and row.high >= start.get(key, 0))

    folded = _parts(spark, path, "bounds", _BOUNDS)
    rows, _ = _loose(spark, path, schema)
    files = sorted({row.file for row in folded if overlaps(row)})
    if rows is None and not folded:
        return None
    if files or rows is None:
        # Without small files and without an overlap, one file gives the columns.
        known = schema or (spark.read.parquet(folded[0].file).schema if rows is None else rows.schema)
        large = spark.read.schema(known).parquet(*files) if files else spark.createDataFrame([], known)
        rows = large if rows is None else rows.unionByName(large)
    return rows if end is None else read_offsets(rows, end, start, "kafka_partition", "kafka_offset")


def fold_log(spark: SparkSession, path: str, schema: T.StructType | None = None, file_rows: int = FILE_ROWS) -> int:
    """Copy the files that are not folded yet into a new segment; returns how many rows that are.

    The files are listed first: those that are added meanwhile wait for the next fold.
    """
    loose, names = _loose(spark, path, schema)
    count = loose.count() if names else 0  # from the files' footers
    if not count:
        return 0
    key, where = ["topic", "kafka_partition", "kafka_offset"], _segments(path)
    number = max((int(n.removeprefix("segment=")) for n in folders(spark, f"{where}/rows")), default=-1) + 1
    target = f"{where}/rows/segment={number}"
    loose.repartitionByRange(max(1, -(-count // file_rows)), *key).sortWithinPartitions(*key).write.parquet(target)
    taken = spark.createDataFrame([(name,) for name in names], "file string")
    taken.coalesce(1).write.parquet(f"{where}/sources/segment={number}")
    bounds = spark.read.schema(loose.schema).parquet(target).groupBy(F.col("_metadata.file_path").alias("file"), "topic", "kafka_partition") \
        .agg(F.min("kafka_offset").alias("low"), F.max("kafka_offset").alias("high"))
    bounds.coalesce(1).write.parquet(f"{where}/bounds/segment={number}")
    return count


def drop_folded(spark: SparkSession, path: str) -> int:
    """Delete the small files that are in segments; returns how many.

    Streams that read the folder must have taken them in by then, as must queries that run.
    """
    return sum(remove(spark, row.file) for row in _parts(spark, path, "sources", "file string"))
