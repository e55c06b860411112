"""Session settings and the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators assume.

    Shuffle partitions are left to AQE: it starts from many small partitions and coalesces them to
    the advisory size, so one setting serves a laptop and a large cluster. Keyword arguments override
    any setting, with ``__`` standing for a dot.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.parquet.filterPushdown": "true",
    }
    settings.update({name.replace("__", "."): value for name, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


Item, Found = TypeVar("Item"), TypeVar("Found")

#: So many jobs at most are run side by side.
MOST_JOBS = 4


def side_by_side(spark: SparkSession, work: Callable[[Item], Found], items: Iterable[Item]) -> list[Found]:
    """``work`` on every item, results in order. Jobs of one item use the cores that another's last tasks leave idle.

    Waits for all; the first failure, in order of the items, is raised then.
    """
    items = list(items)
    if len(items) < 2:
        return [work(item) for item in items]
    with ThreadPoolExecutor(min(MOST_JOBS, len(items))) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(work), item) for item in items]
    return [job.result() for job in started]


def pin_utc(spark: SparkSession) -> None:
    """Hours, days and epoch values are defined in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local-mode session, as in tests, falls back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="tidemark-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has used before, below the shared root."""
    return os.path.join(shared_root(spark), f"{label}-{uuid.uuid4().hex}")


_written: list[str] = []


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared area and read it back.

    Cuts the lineage with files that outlive any executor, and freezes values that would otherwise
    be recomputed, such as row positions. The copy stays until :func:`clear_scratch`.
    """
    path = scratch_dir(df.sparkSession, label)
    _written.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the copies that this process made with :func:`materialize`; returns how many were still there.

    For the end of a run: frames that read from a copy cannot be used any more.
    """
    found = 0
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        found += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return found
