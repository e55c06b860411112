"""Writing tables: replace, append without repeats, overwrite one run."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F

from tidemark.schemas import EVENT_ID
from tidemark.sinks.compaction import read_log
from tidemark.sources.event_log import Offsets, per_partition


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def replace_table(df: DataFrame, target: str, partition_by: list[str] | None = None) -> None:
    """Create or replace a catalog table, or a Parquet folder when the target is a path."""
    writer = df.write.mode("overwrite").format("parquet").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target:
        writer.save(target)
    else:
        writer.saveAsTable(target)


def replace_from_query(spark: SparkSession, query: str, target: str) -> None:
    """Create or replace a table from a SQL query over registered views."""
    replace_table(spark.sql(query), target)


def write_run(df: DataFrame, path: str, run_key: str, run: str | None = None) -> None:
    """Write the rows of a run. Repeating it replaces what that run wrote before and nothing else.

    With ``run``, all rows belong to that value of ``run_key``, and a repetition without rows leaves none. Without it,
    the runs that ``df`` has rows of are replaced.
    """
    if run is None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(run_key).parquet(path))
    else:
        rows = df.drop(run_key).coalesce(1) if df.isEmpty() else df.drop(run_key)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{run_key}={run}")


#: So many low bits of an offset tell which bit of a number of 64 bits it sets.
_SHIFT = 6


def _word() -> Column:
    return F.call_function("shiftright", F.col("kafka_offset"), F.lit(_SHIFT))


def _bit() -> Column:
    place = F.pmod(F.col("kafka_offset"), F.lit(1 << _SHIFT)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def batch_bounds(events: DataFrame) -> list[Row]:
    """Per (topic, kafka_partition): least and greatest offset of a batch, whether each offset in it occurs ``once``, and
    whether all between do (``whole``).

    Offsets that lie close together set bits of one number, which is combined map-side; an offset is repeated where fewer
    bits are set than there are rows. So a batch with gaps, as tombstones leave them, is known to be free of repeats.
    """
    at = F.col("kafka_offset")
    words = events.groupBy("topic", "kafka_partition", _word().alias("word")).agg(
        F.min(at).alias("low"), F.max(at).alias("high"), F.count(F.lit(1)).alias("n"), F.bit_or(_bit()).alias("bits"))
    once = F.coalesce(F.bit_count("bits") == F.col("n"), F.lit(False))
    bounds = words.groupBy("topic", "kafka_partition").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"), F.bool_and(once).alias("once"))
    whole = F.coalesce(F.col("once") & (F.col("n") == F.col("high") - F.col("low") + 1), F.lit(False))
    return bounds.withColumn("whole", whole).collect()  # a row per topic partition


def _tail(bounds: list[Row]) -> Column:
    """Condition on stored rows: within the offsets of the batch, partition by partition."""
    key = (F.col("topic"), F.col("kafka_partition"))
    lows = {(r.topic, r.kafka_partition): r.low for r in bounds}
    highs = {(r.topic, r.kafka_partition): r.high for r in bounds}
    at = F.col("kafka_offset")
    return ((at >= min(lows.values())) & (at <= max(highs.values()))
            & (at >= per_partition(lows, *key)) & (at <= per_partition(highs, *key)))


def _first_new(events: DataFrame, seen: DataFrame) -> Offsets | None:
    """Per (topic, kafka_partition) the offset from which a batch's events are new, None unless all stored ones lie below it.

    Both sides set bits of one number per 64 offsets, in one aggregate that combines map-side.
    """
    both = events.select(*EVENT_ID, F.lit(False).alias("stored")).unionByName(seen.select(*EVENT_ID, F.lit(True).alias("stored")))
    words = both.groupBy("topic", "kafka_partition", _word().alias("word")).agg(
        F.coalesce(F.bit_or(F.when(~F.col("stored"), _bit())), F.lit(0)).alias("batch"),
        F.coalesce(F.bit_or(F.when(F.col("stored"), _bit())), F.lit(0)).alias("old"))
    words = words.withColumn("new", F.col("batch").bitwiseAND(F.bitwise_not("old")))

    new, old = F.bin("new"), F.bin("old")  # from the highest bit that is set to the lowest of all
    first = F.col("word") * (1 << _SHIFT) + F.length(new) - F.length(F.rtrim(new, F.lit("0")))
    last = F.col("word") * (1 << _SHIFT) + F.length(old) - 1
    found = words.groupBy("topic", "kafka_partition").agg(
        F.min(F.when(F.col("new") != 0, first)).alias("first"),
        F.max(F.when(F.col("old") != 0, last)).alias("last")).collect()  # a row per topic partition
    starts = {}
    for row in found:
        if row.first is not None and row.last is not None and row.last > row.first:
            return None
        starts[row.topic, row.kafka_partition] = row.last + 1 if row.first is None else row.first
    return starts if all(at >= 0 for at in starts.values()) else None


class Counted:
    """Counts rows of a frame in the job that writes them, so that they need not be read again.

    ``given`` are columns that the counts share, worked out once a row; the rows come without them.
    """

    def __init__(self, df: DataFrame, given: dict[str, Column] | None = None, **counts: Column):
        self._seen, self._names = Observation(), list(counts)
        given = given or {}
        watched = df.withColumns(given).observe(self._seen, *[count.alias(name) for name, count in counts.items()])
        self.rows = watched.drop(*given)

    def get(self) -> dict[str, int | None]:
        """The counts, after the write. Spark has none for a frame that it finds to be empty while it runs."""
        try:
            return self._seen.get
        except Py4JJavaError:
            return {name: 0 for name in self._names}


def new_events(events: DataFrame, stored: DataFrame | None, bounds: list[Row] | None = None) -> DataFrame:
    """Events that are not stored yet, each once.

    Only stored rows within the offsets of the batch can be repeats, and that condition is pushed into the scan, so
    the check reads that stretch of the log and not its history. It looks at the three id columns alone; whole rows
    are shuffled only where offsets repeat within the batch or stored ones lie above new ones.
    """
    return _new_events(events, stored, batch_bounds(events) if bounds is None else bounds)[0]


def _new_events(events: DataFrame, stored: DataFrame | None, bounds: list[Row]) -> tuple[DataFrame, bool]:
    """The new events, and whether these are all events of the batch's stretch, as none of them is stored."""
    once = all(row.once for row in bounds)
    if not once:
        events = events.dropDuplicates(EVENT_ID)
    if stored is not None and bounds:
        seen = stored.filter(_tail(bounds)).select(*EVENT_ID)
        if not seen.isEmpty():
            starts = _first_new(events, seen) if once else None
            if not starts:
                return events.join(seen, EVENT_ID, "left_anti"), False
            # A log read again from an earlier point: the filter goes below the parsing, so stored events are not parsed.
            at, first = F.col("kafka_offset"), per_partition(starts, F.col("topic"), F.col("kafka_partition"))
            return events.filter((at >= min(starts.values())) & (at >= first)), False
    return events, True


def append_events(events: DataFrame, path: str, partition_by: list[str] | None = None, bounds: list[Row] | None = None,
                  counts: dict[str, Column] | None = None, given: dict[str, Column] | None = None) -> dict[str, int | None] | None:
    """Append to an event log. Repeating a batch, or part of it, adds nothing.

    ``bounds``, from :func:`batch_bounds`, saves looking at the batch again. ``counts`` are worked out while the rows
    are written and returned; None if some of the batch was stored already, so that what was written is not all of it.
    ``given`` are columns that only the counts use.
    """
    bounds = batch_bounds(events) if bounds is None else bounds
    # Folded or not, and of segments only the files that overlap the batch.
    lows, highs = ({(r.topic, r.kafka_partition): at for r, at in zip(bounds, ends)}
                   for ends in ([r.low for r in bounds], [r.high + 1 for r in bounds]))
    stored = read_log(events.sparkSession, path, None, highs, lows)
    if stored is not None and not bounds:
        return None
    fresh, whole = _new_events(events, stored, bounds)
    counted = Counted(fresh, given, **counts) if counts else None
    fresh = counted.rows if counted else fresh
    if partition_by:
        # Evens out file sizes: a source with most of the events is spread over several tasks.
        fresh.hint("rebalance", *partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)
    else:
        fresh.write.mode("append").parquet(path)
    return counted.get() if counted and whole else None
