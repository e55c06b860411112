"""Every operator as a query over the test tables. Each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark import schemas as S
from tidemark.operators import (
    changelog as C, envelope as E, offsets as O, quality as Q, tips, trips as R, undeclared as N)
from tidemark.functions.values import typed_value
from tidemark.operators.ids import assign_ids
from tidemark.plans import testbed as B
from tidemark.plans.medallion import Layout, backfill, file_log, refresh_changes, refresh_trips, run_medallion
from tidemark.plans.testbed import USERS
from tidemark.session import materialize, scratch_dir
from tidemark.sinks import compaction as Z, deltas as D, kept as K, messages as M, mirrors as V, runs as U
from tidemark.sinks.tables import append_events, replace_from_query, replace_table, write_run
from tidemark.sources import event_log as L
from tidemark.sources.files import read_dimension, read_source_table, remove
from tidemark.sources.trips import read_trips, unreadable_values
from tidemark.streaming import ingest as I

# Columns of a streamed trip that the fixture fills.
TRIP_SHOWN = ("VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID", "payment_type",
              "trip_distance", "fare_amount", "tip_amount", "passenger_count", "total_amount")

Query = Callable[[SparkSession, str], DataFrame]

BOTH = (S.CUSTOMERS, S.DRIVERS)

# Cut points in the thirty days the events cover, in milliseconds.
DAY_8, DAY_15, DAY_22 = 1704672000000, 1705276800000, 1705881600000


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Means to a fixed number of digits, so that the order of summation does not show."""
    return df.select(*[F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema])


def plain(df: DataFrame) -> DataFrame:
    """Dates as text and timestamps as microseconds, which every engine compares alike."""
    def column(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.DateType):
            return F.col(field.name).cast("string").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.unix_micros(field.name).alias(field.name)
        return F.col(field.name)
    return df.select(*[column(f) for f in df.schema])


# Change log


def cdc_parse_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables; the columns of the one are NULL for the other."""
    log = B.messages(spark, sf_dir)
    customers, drivers = (E.bronze_table(log, spec).drop("value") for spec in (S.CUSTOMERS, S.DRIVERS))
    return plain(drivers.unionByName(customers, allowMissingColumns=True))


def cdc_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.count_by_table(L.read_event_log(B.messages(spark, sf_dir), BOTH))


def cdc_undeclared_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = L.read_topic(B.messages(spark, sf_dir), S.CUSTOMERS.topic)
    parsed = E.parse_envelope(log)
    image = F.coalesce("after", "before")
    return parsed.groupBy(image.getItem("country").alias("country")).agg(
        F.count(F.lit(1)).alias("events"), F.min(image.getItem("email")).alias("first_email"))


def cdc_variant_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mirror of a table that nobody declared, under the declaration that its changes propose."""
    sent = M.to_envelope(B.user_log(spark, sf_dir), USERS, F.col("op") != S.UPDATE, tombstones=True)
    parsed = N.parse_variants(sent)
    spec = N.propose_spec(parsed, USERS.name, "id")
    return C.current_state(N.flatten_variants(parsed, spec), spec)


def cdc_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = E.quarantine(B.damaged_messages(spark, sf_dir), BOTH)
    return found.select("topic", "kafka_partition", "kafka_offset", "reason", F.col("value").isNotNull().alias("raw_kept"))


def cdc_all_accounted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of a table is applied, in quarantine or a tombstone."""
    log = B.damaged_messages(spark, sf_dir)
    bronze = {spec: E.bronze_table(log, spec) for spec in BOTH}
    applied = reduce(DataFrame.unionByName, [
        rows.filter(E.problem(spec).isNull()).groupBy("topic").agg(F.count(F.lit(1)).alias("n")) for spec, rows in bronze.items()])
    lost = E.quarantine(log, BOTH).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    silent = log.filter(F.col("value").isNull()).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    parts = {"applied": applied, "quarantine": lost, "tombstone": silent, "all": log.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))}
    return reduce(DataFrame.unionByName, [df.select("topic", F.lit(name).alias("part"), "n") for name, df in parts.items()])


def cdc_quarantined_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = B.damaged_messages(spark, sf_dir)
    found = reduce(DataFrame.unionByName, [E.quarantined(E.bronze_table(log, spec), spec) for spec in BOTH])
    return found.groupBy("source_table", "reason").agg(F.count(F.lit(1)).alias("messages"))


def cdc_mirror_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.current_state(E.bronze_table(B.messages(spark, sf_dir), S.CUSTOMERS), S.CUSTOMERS)


def cdc_mirror_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.current_state(E.bronze_table(B.messages(spark, sf_dir), S.DRIVERS), S.DRIVERS)


def cdc_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.current_state(B.user_log(spark, sf_dir), USERS)


def cdc_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.first_rows(cdc_current_state(spark, sf_dir), "id", 5)


def cdc_latest_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.lit(86_400_000)
    log = B.user_log(spark, sf_dir).withColumn("ts_ms", F.col("ts_ms") - F.pmod("ts_ms", day))
    return C.current_state(log, USERS)


def cdc_apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = B.user_log(spark, sf_dir)
    state = C.fold_state(log.filter(F.col("ts_ms") < DAY_15), USERS)
    return C.live_rows(C.apply_changes(state, log.filter(F.col("ts_ms") >= DAY_15), USERS), USERS)


def cdc_replay_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = B.user_log(spark, sf_dir)
    ts = F.col("ts_ms")
    first, second = log.filter(ts < DAY_8), log.filter((ts >= DAY_8) & (ts < DAY_15))
    third, last = log.filter((ts >= DAY_15) & (ts < DAY_22)), log.filter(ts >= DAY_22)
    return C.live_rows(C.replay([third, first, last, second, first], USERS), USERS)


def cdc_state_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.state_as_of(B.user_log(spark, sf_dir), USERS, DAY_15 - 1, by="ts")


def cdc_state_as_of_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = B.user_log(spark, sf_dir)
    return C.state_as_of(log, USERS, _arrived(log, DAY_15), by="offset")


def _arrived(log: DataFrame, at: int) -> DataFrame:
    """Offsets reached by what had arrived at a time."""
    return O.high_water(log.filter(F.unix_millis("kafka_timestamp") < at))


def cdc_deleted_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.deleted_keys(B.user_log(spark, sf_dir), USERS)


def cdc_resurrected_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = B.user_log(spark, sf_dir)
    earlier = C.state_as_of(log, USERS, DAY_15 - 1, by="ts")
    return C.resurrected(C.deleted_keys(log, USERS), earlier, USERS).select("id")


def cdc_offset_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.apply_in_offset_order(B.user_log(spark, sf_dir), USERS)


def cdc_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = B.user_log(spark, sf_dir)
    return O.run_summary(log, C.current_state(log, USERS), USERS)


def cdc_observed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of a run, from the jobs that write its bronze and its mirror."""
    root, log = scratch_dir(spark, "lake"), B.user_log(spark, sf_dir)
    seen = append_events(log, f"{root}/bronze", counts=O.event_counts(USERS))
    live = V.merge_into_mirror(spark.read.parquet(f"{root}/bronze"), f"{root}/mirror", USERS, 8)
    row = tuple(seen[name] for name in ("events_read", "from_offset", "to_offset", "applied"))
    return spark.createDataFrame([(*row, live)], "events_read long, from_offset long, to_offset long, applied long, live_rows long")


def cdc_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    diff = _diff(B.user_log(spark, sf_dir))
    return diff.select("op", C.event_key(USERS).alias("id"), "before_event_type", "before_amount",
                       "after_event_type", "after_amount")


def _diff(log: DataFrame) -> DataFrame:
    old, new = (C.state_as_of(log, USERS, at, by="ts") for at in (DAY_8 - 1, DAY_22 - 1))
    return C.snapshot_diff(old, new, USERS, ts_ms=DAY_22)


def cdc_diff_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = B.user_log(spark, sf_dir)
    state = C.fold_state(C.before_point(log, DAY_8 - 1), USERS)
    return C.live_rows(C.apply_changes(state, _diff(log), USERS), USERS).drop("updated_ts")


def cdc_pending_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = B.messages(spark, sf_dir)
    stored = O.high_water(_as_bronze(log.filter(F.unix_millis("timestamp") < DAY_15)))
    return O.pending(log, stored)


def _as_bronze(log: DataFrame) -> DataFrame:
    return log.withColumnsRenamed({"partition": "kafka_partition", "offset": "kafka_offset"})


def cdc_offset_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = B.messages(spark, sf_dir)
    start, end = O.offset_ranges(cdc_pending_offsets(spark, sf_dir).collect())
    return (L.read_offsets(log, end, start).groupBy("topic", "partition")
            .agg(F.count(F.lit(1)).alias("messages"), F.min("offset").alias("first_offset"),
                 F.max("offset").alias("last_offset")))


def cdc_checkpoint_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved JSON batches of both tables, a folder per partition, read back."""
    root = scratch_dir(spark, "batches")
    event = F.struct("offset", F.col("value").cast("string").alias("value"))
    found = []
    for spec in BOTH:
        log = L.read_topic(B.messages(spark, sf_dir), spec.topic).filter(F.col("value").isNotNull())
        # A batch is a file, and a file costs more than a thousand of its events.
        batches = log.groupBy("partition", F.floor(F.col("offset") / 10_000).alias("part")).agg(
            F.min("offset").alias("from"), (F.max("offset") + 1).alias("to"), F.collect_list(event).alias("events"))
        batches.drop("part").write.option("maxRecordsPerFile", 1) \
            .partitionBy("partition").json(f"{root}/{spec.name}")
        bronze = E.bronze_table(L.read_checkpoint_batches(spark, f"{root}/{spec.name}", spec.topic), spec)
        found.append(bronze.select("topic", "kafka_partition", "kafka_offset", "op", "after_id", "after_name", "before_id"))
    return reduce(DataFrame.unionByName, found)


def cdc_batches_two_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of two partitions that share their offsets: all events are kept, twice appended once stored."""
    where = scratch_dir(spark, "log")
    log = B.user_log(spark, sf_dir)
    event = F.struct(F.expr("kafka_offset div 2").alias("offset"), F.lit("{}").alias("value"))
    batches = log.select(F.pmod("kafka_offset", F.lit(2)).cast("int").alias("partition"), F.array(event).alias("events"))
    rows = _as_bronze(L.messages_of_batches(batches, USERS.topic)).select("topic", "kafka_partition", "kafka_offset")
    for _ in range(2):
        append_events(rows, where)
    return spark.read.parquet(where).groupBy("kafka_partition").agg(
        F.count(F.lit(1)).alias("events"), F.max("kafka_offset").alias("last_offset"))


def cdc_decimal_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals of many widths sent as base64 of their bytes come back as they were."""
    amounts = B.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") * 100).cast("decimal(38,0)").alias("cents"))
    power = F.element_at(F.array(*[F.lit(Decimal(10 ** n)) for n in (0, 6, 12, 18, 24)]), (F.col("l_linenumber") % 5 + 1).cast("int"))
    sign = F.when(F.col("l_orderkey") % 2 == 0, F.lit(1)).otherwise(F.lit(-1))
    value = (F.col("cents").cast("decimal(12,0)") * power.cast("decimal(25,0)")).cast("decimal(38,0)") * sign
    sent = amounts.withColumn("value", value.cast("decimal(38,0)")).withColumn("text", B.base64_of_decimal(F.col("value")))
    field = T.StructField("amount", T.DecimalType(38, 2), True, {"decimal_scale": 2, "base64_only": True})
    read = typed_value(F.col("text"), field)
    return sent.groupBy((F.col("l_linenumber") % 5).cast("int").alias("width")).agg(
        F.count(F.lit(1)).alias("values"), F.count(F.when(read * 100 == F.col("value"), 1)).alias("equal"))


def cdc_wide_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of a topic of five hundred partitions: the middle of each, by its own least and greatest offset."""
    log = B.messages(spark, sf_dir).select("topic", F.pmod("offset", F.lit(500)).cast("int").alias("partition"), "offset")
    bounds = L.read_topic(log, S.CUSTOMERS.topic).groupBy("topic", "partition").agg(
        F.min("offset").alias("low"), F.max("offset").alias("high")).collect()
    start = {(r.topic, r.partition): r.low + (r.high - r.low) // 5 for r in bounds}
    end = {(r.topic, r.partition): r.high - (r.high - r.low) // 5 for r in bounds if r.partition < 400}
    return L.read_offsets(log, end, start).groupBy("partition").agg(
        F.count(F.lit(1)).alias("messages"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))


def cdc_string_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose key is text: what the mirror holds is not in quarantine."""
    spec = S.TableSpec("accounts", "id", T.StructType([T.StructField("id", T.StringType()), T.StructField("amount", T.DoubleType())]))
    log = B.user_log(spark, sf_dir)
    named = log.select("*", *[F.concat(F.lit("user-"), F.col(f"{side}_id").cast("string")).alias(f"{side}_key") for side in ("after", "before")])
    named = named.drop("after_id", "before_id").withColumnsRenamed({"after_key": "after_id", "before_key": "before_id"}) \
        .withColumn("topic", F.lit(spec.topic)).withColumn("source_table", F.lit(spec.name))
    sent = M.to_envelope(named, spec)
    bronze = E.bronze_table(sent, spec)
    bad = E.quarantine(sent, [spec]).groupBy(F.lit("quarantine").alias("part")).agg(F.count(F.lit(1)).alias("n"))
    live = C.current_state(bronze, spec).agg(F.lit("live").alias("part"), F.count(F.when(F.col("id").startswith("user-"), 1)).alias("n"))
    return live.unionByName(bad)


def _message_log(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """The messages as a log in files, written by all tasks, in row groups small enough for many tasks to read one file."""
    B.messages(spark, sf_dir, spread=True).write.option("parquet.block.size", 8 << 20).parquet(path)
    return spark.read.parquet(path)


def _landed(spark: SparkSession, sf_dir: str, *cuts: int | None) -> tuple[Layout, DataFrame]:
    """The messages as a file log, taken in by runs that each see what had arrived by a time."""
    root = scratch_dir(spark, "lake")
    log, layout = _message_log(spark, sf_dir, f"{root}/messages"), Layout(root, 8)
    for cut in cuts:
        seen = log if cut is None else log.filter(F.unix_millis("timestamp") < cut)
        refresh_changes(spark, file_log(seen), layout, list(BOTH))
    return layout, log


def cdc_incremental_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over a growing log and an idle one; the mirrors and the runs' summaries."""
    layout, _ = _landed(spark, sf_dir, DAY_8, DAY_22, None, None)
    runs = U.list_runs(spark, layout.runs).select(F.concat(F.lit("run "), F.col("run")).alias("part"), F.col("events_read").alias("n"))
    live = [V.read_mirror(spark, layout.mirror(spec), spec, 8).agg(F.lit(f"live {spec.name}").alias("part"), F.count(F.lit(1)).alias("n"))
            for spec in BOTH]
    return reduce(DataFrame.unionByName, live, runs)


def cdc_crashed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge dies after it has deleted some of its buckets; the next one rebuilds these from the log."""
    root = scratch_dir(spark, "lake")
    log, mirror = B.user_log(spark, sf_dir), f"{root}/mirror"
    replace_table(log, f"{root}/bronze")
    bronze = spark.read.parquet(f"{root}/bronze")
    V.merge_into_mirror(bronze.filter(F.unix_millis("kafka_timestamp") < DAY_15), mirror, USERS, 8)
    V.announce(spark, [1, 2, 5], mirror, 8)
    for bucket in (1, 5):
        remove(spark, f"{mirror}/of_8/bucket={bucket}")
    V.merge_into_mirror(bronze.filter(F.unix_millis("kafka_timestamp") >= DAY_15), mirror, USERS, 8, log=lambda: bronze)
    return V.read_mirror(spark, mirror, USERS, 8)


def cdc_marker_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs that keep deletion markers for two days: live keys, markers left, and events that came too late."""
    root, days = scratch_dir(spark, "lake"), 2 * 86_400_000
    replace_table(B.user_log(spark, sf_dir), f"{root}/bronze")
    bronze, arrived = spark.read.parquet(f"{root}/bronze"), F.unix_millis("kafka_timestamp")
    for run, part in enumerate((bronze.filter(arrived < DAY_15), bronze.filter(arrived >= DAY_15))):
        V.merge_within_horizon(part, f"{root}/mirror", USERS, days, run, 8, lambda: bronze)
    V.drop_markers(spark, f"{root}/mirror", USERS, 2, 8)
    state = V.read_state(spark, f"{root}/mirror", USERS, 8)
    kept = state.select(F.when(F.col("deleted"), "marker").otherwise("live").alias("part"), "id", "ts_ms")
    refused = V.read_refused(spark, f"{root}/mirror", USERS)
    return kept.unionByName(refused.select("reason", E.event_key(USERS).alias("id"), "ts_ms").withColumnRenamed("reason", "part"))


def cdc_delta_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A base and deltas, the second of them written twice: as one run left them, before a fold and after it."""
    where, log = scratch_dir(spark, "mirror"), B.user_log(spark, sf_dir)
    arrived = F.unix_millis("kafka_timestamp")
    parts = [log.filter(arrived < DAY_8), log.filter((arrived >= DAY_8) & (arrived < DAY_22)), log.filter(arrived >= DAY_22)]
    for run in (0, 1, 1, 2):
        D.append_delta(parts[run], where, USERS, run)
        if run == 0:
            D.fold(spark, where, USERS)
    shown = [D.read_mirror(spark, where, USERS, 1).withColumn("phase", F.lit("run 1")),
             D.read_mirror(spark, where, USERS).withColumn("phase", F.lit("before"))]
    shown = [materialize(df, "shown") for df in shown]  # as read before the fold
    D.fold(spark, where, USERS)
    D.drop_before(spark, where, 2)
    return reduce(DataFrame.unionByName, shown, D.read_mirror(spark, where, USERS).withColumn("phase", F.lit("after")))


def cdc_new_table_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drivers are declared only after a run: all of their events arrive with the next."""
    layout, log = _landed(spark, sf_dir)
    refresh_changes(spark, file_log(log), layout, [S.CUSTOMERS])
    refresh_changes(spark, file_log(log), layout, list(BOTH))
    return V.read_mirror(spark, layout.mirror(S.DRIVERS), S.DRIVERS, 8)


def cdc_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mirrors rebuilt from bronze after the offsets were forgotten and the log read again."""
    layout, log = _landed(spark, sf_dir, DAY_15)
    backfill(spark, layout, list(BOTH), from_log=True)
    refresh_changes(spark, file_log(log), layout, list(BOTH))
    return V.read_mirror(spark, layout.mirror(S.CUSTOMERS), S.CUSTOMERS, 8)


def cdc_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = C.current_state(B.user_log(spark, sf_dir), USERS).drop("updated_ts")
    amount = F.col("amount")
    changed = source.filter(amount >= 5).withColumn(
        "amount", F.when(amount < 20, amount + 1).otherwise(amount))
    extra = source.filter(F.col("event_type") == "view").withColumn("id", F.col("id") + 1_000_000)
    found = Q.reconcile(source, changed.unionByName(extra), "id")
    return found.select("id", "status", F.array_join("columns", ",").alias("columns"),
                        F.col("source.amount").alias("source_amount"), F.col("mirror.amount").alias("mirror_amount"))


def cdc_row_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = B.user_log(spark, sf_dir)
    old, new = (C.state_as_of(log, USERS, at, by="ts").drop("updated_ts") for at in (DAY_15 - 1, DAY_22 - 1))
    return Q.row_diff(old, new)


def cdc_bucket_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``cdc_row_diff``, from the key buckets whose sums differ."""
    log = B.user_log(spark, sf_dir)
    old, new = (C.state_as_of(log, USERS, at, by="ts").drop("updated_ts") for at in (DAY_15 - 1, DAY_22 - 1))
    return Q.bucket_diff(old, new, ["id"])


def cdc_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = USERS.with_column("phone", T.StringType())
    log = B.user_log(spark, sf_dir)
    phone = F.concat(F.lit("+1-"), F.col("kafka_offset").cast("string"))
    log = (log.withColumn("after_phone", F.when(F.col("op") != S.DELETE, phone))
           .withColumn("before_phone", F.when(F.col("op") == S.DELETE, phone)))
    before = E.bronze_table(M.to_envelope(log.filter(F.col("ts_ms") < DAY_15), USERS), USERS)
    after = E.bronze_table(M.to_envelope(log.filter(F.col("ts_ms") >= DAY_15), wide), wide)
    return C.current_state(E.evolve(before, wide).unionByName(after), wide)


def cdc_reparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze of both tables, kept under narrow specs, read again under the full ones."""
    found = []
    for spec in BOTH:
        bronze = E.bronze_table(B.messages(spark, sf_dir), S.TableSpec(spec.name, "id", T.StructType(spec.columns[:2])))
        found.append(C.current_state(E.reparse(bronze, spec), spec).select("id", "name", "updated_ts"))
    return reduce(DataFrame.unionByName, found)


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of a source and its mirror, which must not differ by more than the source's extra row."""
    source = C.current_state(B.user_log(spark, sf_dir), USERS)
    counts = Q.assert_counts(source.unionByName(source.orderBy("id").limit(1)), source, tolerance=1)
    return spark.createDataFrame([counts], "source_rows long, mirror_rows long")


def quality_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.describe(B.table(spark, sf_dir, "lineitem")).select("position", "column", "type")


def source_trip_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip files of which some have a column that others lack, next to files of another kind."""
    root = scratch_dir(spark, "files")
    trips, early = B.trips(spark, sf_dir), F.col("trip_id") % 3 == 0
    trips.filter(early).drop("total_amount").write.mode("append").parquet(root)
    trips.filter(~early).write.mode("append").parquet(root)
    B.zones(spark, sf_dir).write.mode("append").json(root)
    return read_trips(spark, root, "part-*.parquet").agg(
        F.count(F.lit(1)).alias("trips"), F.count("total_amount").alias("with_total"), F.sum("passenger_count").alias("passengers"))


def source_drifted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip files that disagree on types: whole numbers, doubles and text, a column renamed by case, and one absent.

    Per kind of file: its trips, those with a passenger count and their sum, and the clean trips among them; and per type
    the counts that do not convert.
    """
    root, n = scratch_dir(spark, "files"), F.col("trip_id") % 5
    trips, passengers = B.trips(spark, sf_dir), F.col("passenger_count")
    halves = F.when(F.col("trip_id") % 25 == 1, passengers + 0.5).otherwise(passengers.cast("double"))
    text = F.when(F.col("trip_id") % 25 == 2, "n/a").when(F.col("trip_id") % 25 == 7, F.concat(passengers.cast("string"), F.lit(".0"))) \
        .otherwise(passengers.cast("string"))
    written = F.date_format("tpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    kinds = [trips, trips.withColumn("passenger_count", halves),
             trips.withColumn("passenger_count", text).withColumn("tpep_pickup_datetime", written),
             trips.withColumnRenamed("passenger_count", "Passenger_Count"), trips.drop("passenger_count")]
    for kind, rows in enumerate(kinds):
        rows.filter(n == kind).write.mode("append").parquet(root)
    read = read_trips(spark, root, "part-*.parquet").withColumn("n", n.cast("string"))
    clean = R.clean_trips(read).groupBy((F.col("trip_id") % 5).cast("string").alias("n")).agg(F.count(F.lit(1)).alias("clean"))
    found = read.groupBy("n").agg(F.count(F.lit(1)).alias("trips"), F.count("passenger_count").alias("known"),
                                  F.sum("passenger_count").alias("passengers")).join(clean, "n")
    lost = unreadable_values(spark, root, "part-*.parquet").groupBy(F.concat_ws(" ", "column", "given").alias("n")) \
        .agg(F.sum("rows").alias("trips"))
    return found.unionByName(lost, allowMissingColumns=True).withColumnRenamed("n", "kind")


def source_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced from a query twice, read as a lookup and as a named source."""
    where = scratch_dir(spark, "lookup") + "/customers"
    B.table(spark, sf_dir, "customer").createOrReplaceTempView("tidemark_customers")
    replace_from_query(spark, "SELECT c_custkey FROM tidemark_customers", where)
    replace_from_query(spark, "SELECT c_custkey, lower(c_name) AS name FROM tidemark_customers WHERE c_nationkey > 3", where)
    named = read_source_table(spark, "tidemark_customers").select("c_custkey", F.col("c_name").alias("source_name"))
    return read_dimension(spark, where).join(named, "c_custkey")


# Trips


def trips_text_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips whose times come as text, some of it unreadable, in a file that spells its columns otherwise."""
    shown = F.date_format("tpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    raw = B.trips(spark, sf_dir).withColumn("tpep_pickup_datetime", F.when(F.col("trip_id") % 50 != 0, shown).otherwise("?")) \
        .withColumnRenamed("fare_amount", "Fare_Amount")
    return plain(R.clean_trips(raw).select("trip_id", "tpep_pickup_datetime", "fare_amount"))


def trips_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_silver(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str, zones: int = 25) -> DataFrame:
    return R.clean_trips(B.trips(spark, sf_dir, zones))


def trips_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(R.rejected_trips(B.trips(spark, sf_dir)))


def trips_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(R.enrich_zones(_silver(spark, sf_dir), B.zones(spark, sf_dir)))


def trips_events_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    vendor = B.trips(spark, sf_dir).withColumn("VendorID", F.col("PULocationID"))
    sent = M.to_events(vendor.drop("trip_id"), "VendorID")
    return plain(M.from_events(sent).select(*TRIP_SHOWN))


def trips_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that are no trips are kept with their text and a reason."""
    sent = M.to_events(B.trips(spark, sf_dir), "trip_id")
    cut = F.when(F.col("key").cast("bigint") % 5 == 0, F.expr("left(value, length(value) - 3)"))
    read = M.from_events(sent.withColumn("value", F.coalesce(cut, F.col("value"))), rejects=True)
    return read.groupBy(F.col(M.REJECT_REASON).alias("reason")).agg(
        F.count(F.lit(1)).alias("messages"), F.count(M.RAW_VALUE).alias("with_text"), F.count("fare_amount").alias("with_fare"))


def trips_event_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = B.trips(spark, sf_dir).select("trip_id", "payment_type", "tpep_pickup_datetime")
    return M.to_events(times, "trip_id")


def ids_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = assign_ids(B.trips(spark, sf_dir).drop("trip_id"), "dense", ["tpep_pickup_datetime"])
    return plain(numbered.select("trip_id", "tpep_pickup_datetime", "fare_amount"))


def ids_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of trips, the first of them once more after the second: ids without gaps, the same as before."""
    layout, zones = Layout(scratch_dir(spark, "lake")), B.zones(spark, sf_dir)
    trips, early = B.trips(spark, sf_dir).drop("trip_id"), F.col("tpep_pickup_datetime") < "2024-01-15"
    for batch, part in (("1", trips.filter(early)), ("2", trips.filter(~early)), ("1", trips.filter(early))):
        refresh_trips(spark, part, zones, layout, "dense", ["tpep_pickup_datetime"], batch)
    bronze = spark.read.parquet(layout.trips("bronze"))
    return plain(bronze.select(F.col("batch").cast("int").alias("batch"), "trip_id", "tpep_pickup_datetime", "fare_amount"))


def _doubtful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of which every other lacks one of two values and the rest the other, each row twice."""
    k = F.col("trip_id") % 2
    rows = B.trips(spark, sf_dir).select(F.expr("trip_id div 2").alias("pair"), F.when(k == 0, F.lit(1.5)).alias("a"),
                                         F.when(k == 1, F.lit(1.5)).alias("b"))
    return rows.unionByName(rows)


def ids_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _doubtful(spark, sf_dir)
    swapped = assign_ids(rows.select("b", "pair", "a"), "hash").select("trip_id")
    ids = assign_ids(rows, "hash").select("trip_id")
    frames = {"rows": ids, "ids": ids.distinct(), "ids_in_any_order": ids.union(swapped).distinct()}
    return Q.layer_counts(**frames)


def ids_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_ids(_doubtful(spark, sf_dir), "fast").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("trip_id").alias("ids"))


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = B.trips(spark, sf_dir)
    return Q.layer_counts(bronze=raw, silver=R.clean_trips(raw))


# Tips


def tips_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tips.tip_behavior(_silver(spark, sf_dir)))


def tips_mode_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tips.high_tip_mode(_silver(spark, sf_dir))


def tips_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(rounded(tips.tip_rankings(_silver(spark, sf_dir))))


def tips_rankings_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(rounded(tips.tip_rankings(_silver(spark, sf_dir, zones=15))))


def tips_rankings_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(rounded(tips.tip_rankings(_silver(spark, sf_dir, zones=15), both=True)))


def tips_best_zone_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tips.best_zone_hour(_silver(spark, sf_dir)))


def tips_top15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tips.top_behavior(_silver(spark, sf_dir), 15).drop("high_tip_common_payment_type", "trips_count"))


def tips_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tips.top_behavior(_silver(spark, sf_dir), 20))


def tips_best_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tips.best_hour(_silver(spark, sf_dir)))


def tips_driver_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tips.driver_tip_report(_silver(spark, sf_dir), B.drivers(spark, sf_dir)))


def tips_driver_report_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tips.driver_tip_report(_silver(spark, sf_dir), B.drivers(spark, sf_dir), "dense"))


def tips_top_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tips.top_drivers(tips.driver_tip_report(_silver(spark, sf_dir), B.drivers(spark, sf_dir))))


def tips_driver_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tips.driver_tip_by_key(B.keyed_trips(spark, sf_dir), B.drivers(spark, sf_dir)))


def _report_by_whole_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver report with ratings in steps of a thousand, so that several drivers share one."""
    drivers = B.drivers(spark, sf_dir).withColumn("rating", F.floor(F.col("rating") / 1000))
    return tips.driver_tip_report(_silver(spark, sf_dir), drivers)


def tips_rating_vs_tip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tips.rating_vs_tip(_report_by_whole_rating(spark, sf_dir)))


def tips_rating_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tips.rating_tip_correlation(tips.driver_tip_report(_silver(spark, sf_dir), B.drivers(spark, sf_dir))))


# Tables


def _three_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """The log of users, and the offsets that three runs reached in it."""
    where, log = scratch_dir(spark, "runs"), B.user_log(spark, sf_dir)
    for at in (DAY_8, DAY_22, 1 << 62):
        U.save_run(_arrived(log, at), where)
    return log, where


def table_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs, newest first, after a return to the second; with the sum of the offsets they reached."""
    _, where = _three_runs(spark, sf_dir)
    U.return_to(spark, where, 1)
    return U.list_runs(spark, where).select("run", "operation", "offsets")


def table_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as two runs left it, read from the log."""
    log, where = _three_runs(spark, sf_dir)
    read = [C.state_as_of(log, USERS, U.load_offsets(spark, where, run), by="offset").withColumn("version", F.lit(run))
            for run in (0, 2)]
    return reduce(DataFrame.unionByName, read)


def table_as_of_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as each of three runs left it, from the state kept after the first and third run and the log after it."""
    log, where = _three_runs(spark, sf_dir)
    bronze, kept = scratch_dir(spark, "bronze"), scratch_dir(spark, "kept")
    replace_table(log, bronze)
    log = spark.read.parquet(bronze)
    for run in (0, 2):
        cut = {p: at for p, at in K.reached(spark, where, USERS, run).items()}
        K.keep_state(K.state_at(log, USERS, cut, kept, where), kept, run)
    read = [C.live_rows(K.state_at(log, USERS, K.reached(spark, where, USERS, run), kept, where), USERS)
            .withColumn("version", F.lit(run)) for run in range(3)]
    return reduce(DataFrame.unionByName, read)


def table_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored mirror put back to where the second of three runs left it."""
    log, where = _three_runs(spark, sf_dir)
    mirror = scratch_dir(spark, "mirror")
    V.merge_into_mirror(log, mirror, USERS, 8)
    U.return_to(spark, where, 1)
    V.rebuild_mirror(C.before_point(log, U.load_offsets(spark, where), by="offset"), mirror, USERS, 8)
    return V.read_mirror(spark, mirror, USERS, 8)


def table_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = scratch_dir(spark, "log")
    log = B.user_log(spark, sf_dir)
    append_events(log.filter(F.col("ts_ms") < DAY_15), where, ["op"])
    append_events(log.filter(F.col("ts_ms") >= DAY_8), where, ["op"])
    append_events(log, where, ["op"])
    return spark.read.parquet(where).select("kafka_offset", F.col("op").cast("string").alias("op"), "after_id", "before_id")


def table_compacted_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log that arrives in eight batches, is folded after the sixth, and gets some of its events once more."""
    where, log = scratch_dir(spark, "log"), B.user_log(spark, sf_dir)
    part = F.pmod(F.expr("kafka_offset div 200"), F.lit(8))
    for number in range(8):
        append_events(log.filter(part == number), where)
        if number == 5:
            Z.fold_log(spark, where, file_rows=1000)
            Z.drop_folded(spark, where)
    append_events(log.filter(F.col("ts_ms") >= DAY_8), where)
    return Z.read_log(spark, where).select("kafka_offset", F.col("op").cast("string").alias("op"), "after_id", "before_id")


def table_run_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = scratch_dir(spark, "runs")
    log = B.user_log(spark, sf_dir).select("kafka_offset", "op", F.to_date("kafka_timestamp").alias("day"))
    write_run(log, where, "day")
    write_run(log.filter((F.col("op") == S.DELETE) & (F.col("day") < "2024-01-15")), where, "day")  # part of the runs again
    day = "2024-01-20"
    write_run(log.filter((F.col("day") == day) & (F.col("op") == "none")), where, "day", day)  # a run without rows
    return spark.read.parquet(where).groupBy(F.col("day").cast("string").alias("day"), "op").agg(
        F.count(F.lit(1)).alias("events"))


def table_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = scratch_dir(spark, "offsets")
    log = B.user_log(spark, sf_dir)
    for at in (DAY_8, DAY_22):
        U.save_run(_arrived(log, at), where)
    return U.load_offsets(spark, where)


# Streams


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "stream")
    # Three files, a batch each, in row groups small enough for many tasks to read one file.
    B.messages(spark, sf_dir).repartitionByRange(3, "offset").write.option("parquet.block.size", 8 << 20).parquet(f"{root}/log")
    for _ in range(2):  # the second start finds nothing new
        I.stream_bronze(I.message_stream(spark, f"{root}/log", 1), [S.CUSTOMERS, S.DRIVERS], root,
                        f"{root}/checkpoint").awaitTermination()
    columns = ["topic", "kafka_partition", "kafka_offset", "op", "ts_ms", "after_id", "before_id", "after_name"]
    return reduce(DataFrame.unionByName, [
        spark.read.parquet(I.bronze_path(root, spec)).select(*columns) for spec in (S.CUSTOMERS, S.DRIVERS)])


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "stream")
    log = B.user_log(spark, sf_dir)
    log.repartitionByRange(3, F.desc("ts_ms")).write.parquet(I.bronze_path(root, USERS))
    I.stream_silver(I.bronze_stream(spark, root, USERS, 1), f"{root}/mirror", USERS, f"{root}/checkpoint",
                    buckets=8).awaitTermination()
    return V.read_mirror(spark, f"{root}/mirror", USERS, 8)


def stream_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "stream")
    sent = B.trips(spark, sf_dir).withColumn("VendorID", F.col("PULocationID"))
    (M.to_events(sent, "VendorID").select("value").repartitionByRange(3, "value").write.text(f"{root}/events"))
    I.stream_trips(I.trip_stream(spark, f"{root}/events", files_per_batch=1), f"{root}/trips",
                   f"{root}/checkpoint").awaitTermination()
    return plain(spark.read.parquet(f"{root}/trips").select(*TRIP_SHOWN))


def stream_trips_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip events to bronze and on to silver, both as streams."""
    root = scratch_dir(spark, "stream")
    M.to_events(B.trips(spark, sf_dir), "trip_id").select("value").repartitionByRange(3, "value").write.text(f"{root}/events")
    I.stream_trips(I.trip_stream(spark, f"{root}/events"), f"{root}/bronze", f"{root}/c1").awaitTermination()
    I.stream_trips_silver(I.bronze_trip_stream(spark, f"{root}/bronze"), B.zones(spark, sf_dir), f"{root}/silver",
                          f"{root}/c2").awaitTermination()
    silver = spark.read.parquet(f"{root}/silver")
    return plain(silver.select("tpep_pickup_datetime", "fare_amount", "trip_duration_minutes", "pickup_zone", "dropoff_zone"))


# Everything together


def _medallion(spark: SparkSession, sf_dir: str) -> tuple[Layout, dict[str, DataFrame]]:
    root = scratch_dir(spark, "lake")
    log = _message_log(spark, sf_dir, f"{root}/messages")
    source = C.current_state(E.bronze_table(log, S.CUSTOMERS), S.CUSTOMERS).drop("updated_ts")
    layout = Layout(root)
    checks = run_medallion(spark, file_log(log), B.trips(spark, sf_dir).drop("trip_id"), B.zones(spark, sf_dir), layout,
                           sources={"customers": source}, id_mode="dense", id_keys=["tpep_pickup_datetime"])
    return layout, checks


def medallion_driver_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout, _ = _medallion(spark, sf_dir)
    return rounded(spark.read.parquet(layout.gold("driver_tip_report")))


def medallion_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout, checks = _medallion(spark, sf_dir)
    read = spark.read.parquet
    return Q.layer_counts(
        bronze_customers=read(I.bronze_path(layout.root, S.CUSTOMERS)),
        bronze_drivers=read(I.bronze_path(layout.root, S.DRIVERS)),
        silver_customers=V.read_mirror(spark, layout.mirror(S.CUSTOMERS), S.CUSTOMERS),
        silver_drivers=V.read_mirror(spark, layout.mirror(S.DRIVERS), S.DRIVERS),
        customers_differing=checks["customers"],
        bronze_trips=read(layout.trips("bronze")),
        silver_trips=read(layout.trips("silver")),
        gold_tipping_behavior=read(layout.gold("tipping_behavior")),
        gold_tip_rankings=read(layout.gold("tip_rankings")))


def trips_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips that come in two batches, the second of them twice: rows, ids and clean rows."""
    layout, zones = Layout(scratch_dir(spark, "lake")), B.zones(spark, sf_dir)
    trips, early = B.trips(spark, sf_dir).drop("trip_id"), F.col("tpep_pickup_datetime") < "2024-01-15"
    for batch, part in (("1", trips.filter(early)), ("2", trips.filter(~early)), ("2", trips.filter(~early))):
        refresh_trips(spark, part, zones, layout, batch=batch)
    bronze = spark.read.parquet(layout.trips("bronze"))
    return Q.layer_counts(bronze=bronze, ids=bronze.select("trip_id").distinct(), silver=spark.read.parquet(layout.trips("silver")))


ALL: tuple[Query, ...] = (
    cdc_parse_envelope, cdc_route_counts, cdc_undeclared_table, cdc_variant_table, cdc_quarantine, cdc_quarantined_bronze, cdc_all_accounted,
    cdc_batches_two_partitions, cdc_decimal_widths, cdc_wide_topic, cdc_string_keys, cdc_incremental_run, cdc_new_table_later,
    cdc_backfill, cdc_crashed_merge, cdc_marker_horizon, cdc_delta_mirror,
    cdc_mirror_customers, cdc_mirror_drivers, cdc_current_state, cdc_first_rows, cdc_latest_ties, cdc_apply_changes, cdc_replay_equals_batch,
    cdc_state_as_of, cdc_state_as_of_offsets, cdc_deleted_keys, cdc_resurrected_keys, cdc_offset_order,
    cdc_run_summary, cdc_observed_run, cdc_snapshot_diff, cdc_diff_applied, cdc_pending_offsets, cdc_offset_range,
    cdc_checkpoint_batches, cdc_reconcile, cdc_row_diff, cdc_bucket_diff, cdc_schema_evolution, cdc_reparse,
    quality_counts, quality_describe, source_trip_files, source_drifted_files, source_lookups, trips_text_times,
    trips_clean, trips_rejects, trips_enriched, trips_events_roundtrip, trips_event_text, trips_bad_lines, trips_appended, ids_dense, ids_batches, ids_hash,
    ids_fast, layer_counts,
    tips_behavior, tips_mode_payment, tips_rankings, tips_rankings_overlap, tips_rankings_both,
    tips_best_zone_hour, tips_top15, tips_top20, tips_best_hour, tips_driver_report, tips_driver_report_dense,
    tips_top_drivers, tips_driver_by_key, tips_rating_vs_tip, tips_rating_correlation,
    table_versions, table_as_of, table_as_of_tail, table_rollback, table_append_twice, table_compacted_log, table_run_overwrite, table_offsets,
    stream_bronze, stream_silver, stream_trips, stream_trips_silver, medallion_driver_report, medallion_layers,
)


def catalog() -> dict[str, Query]:
    return {query.__name__: query for query in ALL}
