"""Current state of source tables, kept up to date by merging batches of events.

A state is plain Parquet, partitioned by a hash bucket of the key. A merge reads and replaces the buckets that hold a
changed key and leaves the others alone. Where a catalog offers MERGE, ``merge_sql`` does the same in one statement.
Earlier points in time are not kept here: they are read from the append-only log with ``state_as_of``.

Replacing a bucket means deleting its files before the new ones are in place, so a run that dies in between leaves it
empty. Every write is therefore announced: the numbers of the buckets that it replaces are stored first and deleted
last. While they are there the mirror cannot be read, and the next merge first rebuilds those buckets from the log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark import schemas as S
from tidemark.operators.changelog import (
    ORDER, fold_state, horizons, keyed_events, latest_per_key, live_rows, split_late, without_old_markers)
from tidemark.sinks.tables import Counted, write_run
from tidemark.sources.event_log import Offsets
from tidemark.sources.files import files, finished, folders, read_if_present, remove

#: Gives the whole bronze log of a table; called only where buckets have to be rebuilt.
Log = Callable[[], DataFrame]


class MirrorUnfinished(RuntimeError):
    """A run died while it replaced buckets of a mirror; the next merge that is given the log repairs it."""


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def state_schema(spec: S.TableSpec) -> T.StructType:
    order = [S.EVENT_HEADER[name] for name in ORDER]
    columns = [spec.columns[spec.key], *[spec.columns[name] for name in spec.attributes], *order]
    return T.StructType([*[T.StructField(c.name, c.dataType) for c in columns], T.StructField("deleted", T.BooleanType())])


def _path(table: str, buckets: int) -> str:
    # The number is part of the path: a key's bucket depends on it.
    return f"{table}/of_{buckets}"


def _announced(table: str, buckets: int) -> str:
    return f"{table}/unfinished_of_{buckets}"


def read_state(spark: SparkSession, table: str, spec: S.TableSpec, buckets: int = 16) -> DataFrame | None:
    """The state with its ``bucket``; columns added to the spec since a bucket was written are NULL in it."""
    if finished(spark, _announced(table, buckets)):
        raise MirrorUnfinished(f"a run died while it wrote {table}; merge again, with the log")
    return _stored(spark, table, spec, buckets)


def _stored(spark: SparkSession, table: str, spec: S.TableSpec, buckets: int) -> DataFrame | None:
    schema = T.StructType([*state_schema(spec), T.StructField("bucket", T.IntegerType())])
    return read_if_present(spark, _path(table, buckets), schema)


def announce(spark: SparkSession, touched: list[int], table: str, buckets: int) -> None:
    """Store the numbers of the buckets that are about to be replaced."""
    rows = spark.createDataFrame([(n,) for n in touched], "bucket int")
    rows.coalesce(1).write.mode("overwrite").parquet(_announced(table, buckets))


def _write(state: DataFrame, table: str, buckets: int, mode: str) -> None:
    # Rebalancing by bucket makes one file of a small bucket and several of a large one.
    (state.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", mode)
     .partitionBy("bucket").parquet(_path(table, buckets)))


def _fill(state: DataFrame, touched: list[int], table: str, spec: S.TableSpec, buckets: int) -> None:
    """Replace the rows of announced buckets; the announcement is withdrawn when all are in place.

    Spark leaves a bucket alone that gets no rows, as when all its keys were deleted and their markers dropped: a bucket
    whose files are still the same is removed.
    """
    spark = state.sparkSession
    where = {bucket: f"{_path(table, buckets)}/bucket={bucket}" for bucket in touched}
    before = {bucket: files(spark, path) for bucket, path in where.items()}
    _write(state.withColumn("bucket", bucket_of(spec.key, buckets)), table, buckets, "dynamic")
    for bucket, path in where.items():
        if before[bucket] and files(spark, path) == before[bucket]:
            remove(spark, path)
    remove(spark, _announced(table, buckets))


def repair(spark: SparkSession, table: str, spec: S.TableSpec, buckets: int, log: Log | None) -> bool:
    """Rebuild from the log the buckets that a run left unfinished; returns whether there were any.

    Only events of those buckets are folded. The other buckets are read by nobody and stay as they are. Doing it
    again does no harm, so a repair that dies is repaired the same way.
    """
    where = _announced(table, buckets)
    if not finished(spark, where):
        return False
    if log is None:
        raise MirrorUnfinished(f"a run died while it wrote {table}, and there is no log to rebuild its buckets from")
    # At most ``buckets`` numbers.
    lost = [row.bucket for row in spark.read.schema("bucket int").parquet(where).collect()]
    events = keyed_events(log(), spec).withColumn("bucket", bucket_of(spec.key, buckets)).filter(F.col("bucket").isin(lost))
    _fill(latest_per_key(events.drop("bucket"), spec.key), lost, table, spec, buckets)
    return True


def merge_into_mirror(bronze: DataFrame, table: str, spec: S.TableSpec, buckets: int = 16, log: Log | None = None,
                      horizon: Offsets | None = None) -> int:
    """Merge a batch of events into the stored state; returns by how much its live rows grew.

    Merging a batch again, in part or late changes nothing: of what is stored and what arrives, the later event
    wins. A run that dies while it writes is repaired by the next one from ``log``, which has to hold everything merged
    so far; without a log such a mirror is refused. One writer at a time, and no readers meanwhile.

    With a ``horizon``, deletion markers below it leave the buckets that are rewritten. Rows are counted by the job that
    writes them.
    """
    spark, live = bronze.sparkSession, F.count_if(~F.col("deleted"))
    repair(spark, table, spec, buckets, log)
    events = keyed_events(bronze, spec)
    # A look at the keys alone; at most ``buckets`` numbers, which prune the scan of the state.
    touched = sorted(row.bucket for row in events.filter(F.col(spec.key).isNotNull())
                     .select(bucket_of(spec.key, buckets).alias("bucket")).distinct().collect())
    changes = latest_per_key(events, spec.key)
    stored = _stored(spark, table, spec, buckets)
    if stored is not None:
        before = Counted(stored.filter(F.col("bucket").isin(touched)).drop("bucket"), live=live)
        changes = latest_per_key(before.rows.unionByName(changes).select(*before.rows.columns), spec.key)
    if horizon is not None:
        changes = without_old_markers(changes, spec, horizon)
    if not touched and stored is not None:
        return 0
    announce(spark, touched, table, buckets)
    after = Counted(changes, live=live)
    _fill(after.rows, touched, table, spec, buckets)
    return after.get()["live"] - (0 if stored is None else before.get()["live"])


def drop_markers(spark: SparkSession, table: str, spec: S.TableSpec, run: int, buckets: int = 16) -> list[int]:
    """Rewrite the buckets that hold deletion markers which ``run`` has no use for, without these; returns the buckets.

    A run refuses what is older than the horizon that the runs before it left, so only markers below that one go:
    those above may be needed when the run is repeated. Earlier runs must not be repeated after this.
    """
    horizon = _horizon_before(spark, table, run)
    stored = read_state(spark, table, spec, buckets)
    if stored is None:
        return []
    kept = without_old_markers(stored, spec, horizon)
    counts = [df.groupBy("bucket").agg(F.count(F.lit(1)).alias(name)) for df, name in ((stored, "rows"), (kept, "kept"))]
    touched = sorted(r.bucket for r in counts[0].join(counts[1], "bucket", "left")
                     .filter(F.col("rows") > F.coalesce("kept", F.lit(0))).select("bucket").collect())
    if touched:
        announce(spark, touched, table, buckets)
        _fill(kept.filter(F.col("bucket").isin(touched)).drop("bucket"), touched, table, spec, buckets)
    return touched


def merge_within_horizon(bronze: DataFrame, table: str, spec: S.TableSpec, retention_ms: int, run: int, buckets: int = 16,
                         log: Log | None = None) -> Offsets:
    """Merge a run's events but those older than the horizon, and keep deletion markers for ``retention_ms`` only.

    The horizon of a run is what the runs before it left; its own events raise the next one's, which is returned. Refused
    events are kept with a reason, see :func:`read_refused`. Repeating a run refuses the same events again, and finds the
    markers that these needed. Buckets that get no events keep their markers until :func:`drop_markers`.
    """
    spark = bronze.sparkSession
    known = _horizon_before(spark, table, run)
    taken, refused = split_late(bronze, spec, known)
    write_run(refused.withColumn("run", F.lit(run)), f"{table}/refused", "run", str(run))
    horizon = horizons(bronze, retention_ms, known)
    applied = None if log is None else lambda: log().join(read_refused(spark, table, spec).select(*S.EVENT_ID), S.EVENT_ID, "left_anti")
    merge_into_mirror(taken, table, spec, buckets, applied, known)
    rows = spark.createDataFrame([(*p, ms) for p, ms in sorted(horizon.items())], "topic string, kafka_partition int, horizon_ms long")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{table}/horizons/run={run}")
    return horizon


def _horizon_before(spark: SparkSession, table: str, run: int) -> Offsets:
    where = f"{table}/horizons"
    runs = [int(name.removeprefix("run=")) for name in folders(spark, where) if finished(spark, f"{where}/{name}")]
    last = max((r for r in runs if r < run), default=None)
    if last is None:
        return {}
    found = spark.read.parquet(f"{where}/run={last}").collect()  # a row per topic partition
    return {(r.topic, r.kafka_partition): r.horizon_ms for r in found}


def read_refused(spark: SparkSession, table: str, spec: S.TableSpec) -> DataFrame:
    """Events that came too late to be merged: bronze rows, the reason, and the run they came with."""
    schema = T.StructType([*spec.bronze_schema, T.StructField("reason", T.StringType()), T.StructField("run", T.IntegerType())])
    found = read_if_present(spark, f"{table}/refused", schema)
    return spark.createDataFrame([], schema) if found is None else found


def replace_state(state: DataFrame, table: str, spec: S.TableSpec, buckets: int = 16) -> None:
    """Replace the whole state by another, which must not be read from the same place.

    What dies half-way is repaired like a merge: from the whole log, for all buckets.
    """
    spark = state.sparkSession
    announce(spark, list(range(buckets)), table, buckets)
    _fill(state.select(*state_schema(spec).names), list(range(buckets)), table, spec, buckets)


def rebuild_mirror(bronze: DataFrame, table: str, spec: S.TableSpec, buckets: int = 16) -> None:
    """Backfill: replace the state by what the log says, perhaps in another number of buckets."""
    replace_state(fold_state(bronze, spec), table, spec, buckets)


def read_mirror(spark: SparkSession, table: str, spec: S.TableSpec, buckets: int = 16) -> DataFrame:
    """Live rows of a stored state; none before the first event of the table."""
    stored = read_state(spark, table, spec, buckets)
    if stored is None:
        stored = spark.createDataFrame([], state_schema(spec))
    return live_rows(stored, spec)


def merge_sql(target: str, changes: str, spec: S.TableSpec) -> str:
    """MERGE statement for a catalog table that supports it; ``changes`` is a view of one state row per key."""
    names = state_schema(spec).names
    later = " OR ".join(
        "(" + " AND ".join([*[f"t.{c} <=> s.{c}" for c in ORDER[:i]],
                            f"(s.{ORDER[i]} > t.{ORDER[i]} OR (t.{ORDER[i]} IS NULL AND s.{ORDER[i]} IS NOT NULL))"]) + ")"
        for i in range(len(ORDER)))
    return (f"MERGE INTO {target} t USING {changes} s ON t.{spec.key} = s.{spec.key} "
            f"WHEN MATCHED AND ({later}) THEN UPDATE SET {', '.join(f't.{c} = s.{c}' for c in names)} "
            f"WHEN NOT MATCHED THEN INSERT ({', '.join(names)}) VALUES ({', '.join(f's.{c}' for c in names)})")
