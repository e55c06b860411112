"""The whole run in dependency order: changes to mirrors, trips to tipping tables, then the checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas as S
from tidemark.operators.changelog import fold_state, live_rows
from tidemark.operators.envelope import PROBLEMS, problem
from tidemark.operators.ids import assign_ids, numbered
from tidemark.operators.quality import reconcile
from tidemark.operators.tips import (
    behavior_from_totals, daily_totals, driver_tip_report, rankings_from_totals, roll_up)
from tidemark.operators.trips import clean_trips, enrich_zones
from tidemark.session import materialize, scratch_dir, side_by_side
from tidemark.sinks import deltas
from tidemark.sinks.allocations import allocate
from tidemark.sinks.compaction import drop_folded, fold_log, read_log
from tidemark.sinks.kept import keep_state, reached, state_at
from tidemark.sinks.mirrors import Log, merge_into_mirror, read_mirror, read_state, repair, replace_state
from tidemark.sinks.runs import list_runs, live_rows_after, load_offsets, newest_run, return_to, save_run
from tidemark.sinks.tables import replace_table, write_run
from tidemark.sources.event_log import (
    Offsets, complete_start, per_partition, read_event_log, read_kafka, read_offsets)
from tidemark.sources.files import remove
from tidemark.streaming.ingest import bronze_path, ingest_messages


@dataclass(frozen=True)
class Layout:
    """Where the tables of one lakehouse live, and how mirrors are kept.

    ``buckets``: into how many parts a mirror is split by key. ``fold_share``: keep mirrors as a base and deltas instead,
    with a new base whenever the deltas exceed that share of it. ``keep_every``: keep a copy of each state after every
    so many runs, from which earlier points are reached; with deltas the bases are such copies.
    """

    root: str
    buckets: int = 16
    fold_share: float | None = None
    keep_every: int = 0

    def mirror(self, spec: S.TableSpec) -> str:
        return f"{self.root}/silver_{spec.name}"

    def kept(self, spec: S.TableSpec) -> str:
        return f"{self.root}/kept_{spec.name}"

    @property
    def runs(self) -> str:
        return f"{self.root}/runs"

    def trips(self, layer: str) -> str:
        return f"{self.root}/{layer}_trips"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold_{name}"


#: Reads messages of a stretch of the log: from the start offsets on (all there is for a partition without one), up to
#: the end offsets if given.
Reader = Callable[[Offsets, Offsets | None], DataFrame]


def file_log(log: DataFrame) -> Reader:
    """Reader of a log in files or a table."""
    def read(start: Offsets, end: Offsets | None) -> DataFrame:
        if end is not None:
            return read_offsets(log, end, start)
        if not start:
            return log
        low = per_partition(start, F.col("topic"), F.col("partition"))
        return log.filter(F.col("offset") >= F.coalesce(low, F.lit(0)))
    return read


def kafka_log(spark: SparkSession, servers: str, specs: list[S.TableSpec], partitions: dict[str, int],
              min_partitions: int | None = None) -> Reader:
    """Reader of the tables' topics. Kafka itself starts at the offsets asked for, so old messages are not sent again.

    ``partitions``: how many each topic has. Kafka wants every one in a start map, also those never read before.
    """
    everything = {(topic, number): 0 for topic, count in partitions.items() for number in range(count)}

    def read(start: Offsets, end: Offsets | None) -> DataFrame:
        begin = complete_start(start, everything)
        # A partition that is not to be read ends where it starts.
        stop = None if end is None else {p: end.get(p, begin[p]) for p in everything}
        return read_kafka(spark, servers, specs, begin, stop, min_partitions)
    return read


def mirror_of(spark: SparkSession, layout: Layout, spec: S.TableSpec) -> DataFrame:
    """Live rows of a table's mirror, however it is kept."""
    if layout.fold_share is not None:
        return deltas.read_mirror(spark, layout.mirror(spec), spec)
    return read_mirror(spark, layout.mirror(spec), spec, layout.buckets)


def mirror_as_of(spark: SparkSession, layout: Layout, spec: S.TableSpec, run: int) -> DataFrame:
    """Live rows as a run left them, from the nearest earlier state that is stored and what came after it."""
    if layout.fold_share is not None:
        return deltas.read_mirror(spark, layout.mirror(spec), spec, run)
    bronze = read_log(spark, bronze_path(layout.root, spec), spec.bronze_schema)
    bronze = spark.createDataFrame([], spec.bronze_schema) if bronze is None else bronze
    return live_rows(state_at(bronze, spec, reached(spark, layout.runs, spec, run), layout.kept(spec), layout.runs), spec)


def _merge(new: DataFrame, layout: Layout, spec: S.TableSpec, run: int) -> int | None:
    """Merge into a table's mirror; returns by how much its live rows grew, None where the merge does not tell."""
    spark = new.sparkSession
    if layout.fold_share is None:
        return merge_into_mirror(new, layout.mirror(spec), spec, layout.buckets, _bronze_log(spark, layout, spec))
    deltas.append_delta(new, layout.mirror(spec), spec, run)
    return None


#: A write counts events of so many partitions of a topic each; with more they are counted by reading them again.
MOST_COUNTED = 64


def _counts(new: DataFrame, spec: S.TableSpec, numbers: list[int], seen: dict[str, int | None] | None) -> tuple[dict, dict]:
    """(events, applied) per partition, and rejected events by reason, of a run: from its write, else from bronze."""
    if seen is None or len(numbers) > MOST_COUNTED:
        reason = problem(spec)
        seen = new.agg(*[F.count_if(reason == name).alias(f"rejected_{name}") for name in PROBLEMS]).head().asDict()
        for row in new.groupBy("kafka_partition").agg(F.count(F.lit(1)).alias("n"), F.count_if(reason.isNull()).alias("ok")).collect():
            seen |= {f"events_read_{row.kafka_partition}": row.n, f"applied_{row.kafka_partition}": row.ok}
    counts = {n: (seen.get(f"events_read_{n}", 0), seen.get(f"applied_{n}", 0)) for n in numbers}
    return counts, {name: seen[f"rejected_{name}"] for name in PROBLEMS if seen[f"rejected_{name}"]}


def refresh_changes(spark: SparkSession, reader: Reader, layout: Layout, specs: list[S.TableSpec]) -> DataFrame | None:
    """Take in what is new in the log of the given tables; returns the stored summary of the run, None if nothing was new.

    The gate looks at offsets alone, from where the last run ended; an idle run reads no message and writes nothing.
    The offsets stored are those read in this run, of these tables: what arrives meanwhile, and tables declared later,
    wait for their run. Mirrors that an earlier run left half-written are rebuilt first, also by an idle run.
    """
    if layout.fold_share is None:
        for spec in specs:
            repair(spark, layout.mirror(spec), spec, layout.buckets, _bronze_log(spark, layout, spec))
    known = {(r.topic, r.kafka_partition): r.next_offset for r in load_offsets(spark, layout.runs).collect()}
    wanted = {spec.topic for spec in specs}
    start = {p: at for p, at in known.items() if p[0] in wanted}
    news = read_event_log(reader(start, None), specs).groupBy("topic", "partition").agg(F.max("offset").alias("last"))
    # One row per partition. The numbers are fixed here: recomputing them later could see more of the log.
    end = {(r.topic, r.partition): r["last"] + 1 for r in news.collect()}
    end = {p: at for p, at in end.items() if at > start.get(p, 0)}
    if not end:
        return None
    numbers = {spec.topic: sorted(number for topic, number in end if topic == spec.topic) for spec in specs}
    watched = {topic: found for topic, found in numbers.items() if len(found) <= MOST_COUNTED}
    seen = ingest_messages(read_event_log(reader({p: start.get(p, 0) for p in end}, end), specs), specs, layout.root, watched)
    last = newest_run(spark, layout.runs)
    run = 0 if last is None else last + 1

    def merge(spec: S.TableSpec) -> dict:
        here = {p: at for p, at in end.items() if p[0] == spec.topic}
        new = read_log(spark, bronze_path(layout.root, spec), spec.bronze_schema, here, start)
        grown = _merge(new, layout, spec, run)
        # What the last run counted holds only if this run's events were new: an earlier attempt may have merged others.
        before = live_rows_after(spark, layout.runs, spec.topic) if seen[spec.name] is not None and grown is not None else None
        live = mirror_of(spark, layout, spec).count() if before is None else before + grown
        of_partition, rejected = _counts(new, spec, numbers[spec.topic], seen[spec.name])
        found = {}
        for number, (n, ok) in of_partition.items():
            found[spec.topic, number] = (n, ok, live, rejected)
            live, rejected = None, None  # once per table
        return found

    counts = {}
    for found in side_by_side(spark, merge, [spec for spec in specs if numbers[spec.topic]]):
        counts |= found
    rows = [(topic, number, end.get((topic, number), at), at if (topic, number) in end else None,
             *counts.get((topic, number), (0, 0, None, None)))
            for (topic, number), at in sorted(({p: 0 for p in end} | known).items())]
    columns = ("topic string, kafka_partition int, next_offset long, from_offset long, events_read long, applied long, "
               "live_rows long, rejected map<string,bigint>")
    save_run(spark.createDataFrame(rows, columns), layout.runs)
    for spec in specs:
        if layout.fold_share is not None:
            deltas.fold(spark, layout.mirror(spec), spec, layout.fold_share)
        elif layout.keep_every and run % layout.keep_every == 0:
            state = read_state(spark, layout.mirror(spec), spec, layout.buckets)
            if state is not None:
                keep_state(state.drop("bucket"), layout.kept(spec), run)
    return list_runs(spark, layout.runs).filter(F.col("run") == run)


def _bronze_log(spark: SparkSession, layout: Layout, spec: S.TableSpec) -> Log:
    return lambda: read_log(spark, bronze_path(layout.root, spec), spec.bronze_schema)


def fold_bronze(spark: SparkSession, layout: Layout, specs: list[S.TableSpec], drop: bool = False) -> dict[str, int]:
    """Fold the small files of bronze into large ones, and delete them if asked to; returns the rows folded per table."""
    found = {}
    for spec in specs:
        path = bronze_path(layout.root, spec)
        found[spec.name] = fold_log(spark, path, spec.bronze_schema)
        if drop:
            drop_folded(spark, path)
    return found


def backfill(spark: SparkSession, layout: Layout, specs: list[S.TableSpec], from_log: bool = False) -> None:
    """Rebuild the mirrors from bronze. With ``from_log`` the next run also reads the tables' topics again from the start."""
    for spec in specs:
        bronze = read_log(spark, bronze_path(layout.root, spec), spec.bronze_schema)
        if bronze is not None:
            _rebuild(fold_state(bronze, spec), layout, spec)
    if from_log:
        topics = [spec.topic for spec in specs]
        at = F.when(F.col("topic").isin(*topics), F.lit(0)).otherwise(F.col("next_offset"))
        save_run(load_offsets(spark, layout.runs).withColumn("next_offset", at), layout.runs, "backfill")


def _rebuild(state: DataFrame, layout: Layout, spec: S.TableSpec) -> None:
    spark = state.sparkSession
    if layout.fold_share is None:
        replace_state(state, layout.mirror(spec), spec, layout.buckets)
    else:
        deltas.replace_state(state, layout.mirror(spec), spec, newest_run(spark, layout.runs) or 0)


def return_to_run(spark: SparkSession, layout: Layout, specs: list[S.TableSpec], run: int) -> None:
    """Put mirrors and offsets back to where a run left them; events after it return with the next refresh.

    Mirrors start from the nearest state that was kept at or before that run; see :func:`mirror_as_of`.
    """
    for spec in specs:
        bronze = read_log(spark, bronze_path(layout.root, spec), spec.bronze_schema)
        if layout.fold_share is not None:
            deltas.return_to(spark, layout.mirror(spec), spec, run, newest_run(spark, layout.runs) + 1)
        elif bronze is not None:
            cut = reached(spark, layout.runs, spec, run)
            replace_state(state_at(bronze, spec, cut, layout.kept(spec), layout.runs), layout.mirror(spec), spec, layout.buckets)
    return_to(spark, layout.runs, run)


def refresh_trips(spark: SparkSession, trips: DataFrame, zones: DataFrame, layout: Layout,
                  id_mode: str = "fast", id_keys: list[str] | None = None, batch: str | None = None) -> None:
    """Trips to bronze with ids, then cleaned and enriched to silver.

    Without ``batch`` both tables are replaced, silver by day of pickup. With it, the trips are those of one batch, such
    as a month: they are added, or replace what that batch brought before, and other batches are not touched. Ids of a
    batch have no gaps and lie in a range of its own, which it keeps when it is repeated; earlier trips are not read.
    """
    bronze_path, silver_path = layout.trips("bronze"), layout.trips("silver")
    if batch is None:
        replace_table(assign_ids(trips, id_mode, id_keys), bronze_path)
        silver = enrich_zones(clean_trips(spark.read.parquet(bronze_path)), zones)
        silver = silver.withColumn("pickup_date", F.to_date("tpep_pickup_datetime"))
        replace_table(silver.hint("rebalance", "pickup_date"), silver_path, ["pickup_date"])
        return
    if id_mode == "hash":
        rows = assign_ids(trips, id_mode, id_keys)
    else:
        keys = id_keys or trips.columns if id_mode == "dense" else None
        rows = numbered(trips, keys, first=lambda n: allocate(spark, layout.trips("ids"), batch, n))
    write_run(rows, bronze_path, "batch", batch)
    bronze = spark.read.parquet(f"{bronze_path}/batch={batch}")
    write_run(enrich_zones(clean_trips(bronze), zones), silver_path, "batch", batch)


def refresh_gold(spark: SparkSession, layout: Layout, drivers: S.TableSpec = S.DRIVERS, mode: str = "id") -> None:
    """The three tipping tables. Behaviour and rankings share one scan of the trips through their totals."""
    silver = spark.read.parquet(layout.trips("silver"))
    # In files: as many small tasks as a cached shuffle has would each write a part for as many others.
    stored = scratch_dir(spark, "totals")
    replace_table(daily_totals(silver), stored)
    totals = spark.read.parquet(stored)
    try:
        by_payment = roll_up(totals, "PULocationID", "pickup_hour", "payment_type")
        replace_table(behavior_from_totals(by_payment), layout.gold("tipping_behavior"))
        replace_table(rankings_from_totals(totals), layout.gold("tip_rankings"))
    finally:
        remove(spark, stored)
    report = driver_tip_report(silver, mirror_of(spark, layout, drivers), mode)
    replace_table(report, layout.gold("driver_tip_report"))


def check_mirrors(spark: SparkSession, sources: dict[str, DataFrame], layout: Layout,
                  specs: list[S.TableSpec]) -> dict[str, DataFrame]:
    """Rows that differ between each source table and its mirror; run it whether or not anything was new."""
    return {spec.name: reconcile(sources[spec.name].select(*spec.columns.names),
                                 mirror_of(spark, layout, spec), spec.key)
            for spec in specs if spec.name in sources}


class MirrorsDiffer(RuntimeError):
    """A mirror does not hold what its source table holds."""


def assert_mirrors(differences: dict[str, DataFrame]) -> None:
    """Fail when any table differs from its source."""
    counts = {name: found.count() for name, found in differences.items()}
    wrong = {name: n for name, n in counts.items() if n}
    if wrong:
        raise MirrorsDiffer(", ".join(f"{name}: {n} rows differ" for name, n in sorted(wrong.items())))


def run_medallion(spark: SparkSession, reader: Reader, trips: DataFrame, zones: DataFrame, layout: Layout,
                  specs: tuple[S.TableSpec, ...] = (S.CUSTOMERS, S.DRIVERS),
                  sources: dict[str, DataFrame] | None = None, must_match: bool = True,
                  **trip_ids) -> dict[str, DataFrame]:
    """Everything once. Changes and trips are taken in side by side, gold comes after both, the checks come last and always.

    Fails with MirrorsDiffer if a source table and its mirror differ, unless ``must_match`` is off; either way the
    tables are written by then. With ``must_match`` the differences are stored, so that sources are read once.
    """
    specs = list(specs)
    # Neither needs the other.
    side_by_side(spark, lambda refresh: refresh(), [lambda: refresh_changes(spark, reader, layout, specs),
                                                    lambda: refresh_trips(spark, trips, zones, layout, **trip_ids)])
    refresh_gold(spark, layout, next((s for s in specs if s.name == S.DRIVERS.name), S.DRIVERS))
    differences = check_mirrors(spark, sources or {}, layout, specs)
    if must_match:
        differences = {name: materialize(found, "differences") for name, found in differences.items()}
        assert_mirrors(differences)
    return differences
