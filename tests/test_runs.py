"""Scenarios over several runs, in batch and as streams."""

import pytest

from logs import EDGES, EDGES_MIRROR, PEOPLE, edge_log, envelope, log, message, rows
from test_trips import COLUMNS, trip
from tidemark.operators.changelog import current_state
from tidemark.operators.envelope import bronze_table
from tidemark.plans.medallion import (
    Layout, MirrorsDiffer, backfill, file_log, refresh_changes, return_to_run, run_medallion)
from tidemark.schemas import CUSTOMERS, DRIVERS
from tidemark.session import scratch_dir
from tidemark.sinks import mirrors as V, runs as U
from tidemark.sinks.messages import to_events
from tidemark.streaming import ingest as I


def customers(*events):
    """Messages of (offset, op, id, name); name None is a delete."""
    made = []
    for offset, op, key, name in events:
        image = {"id": key, "name": name, "email": f"{name}@example.com", "country": "X"}
        before, after = (image, None) if op == "d" else (None, image)
        made.append(message(offset, envelope(op, 1000 + offset, before, after), "customers"))
    return made


FIRST = customers((0, "r", 1, "Alice"), (1, "r", 2, "Bob"), (2, "r", 3, "Carol"))
CHANGES = customers((3, "c", 4, "David"), (4, "u", 1, "Alice2"), (5, "d", 3, "Carol"))
LATER = customers((6, "c", 5, "Eva"))


def names(spark, layout):
    return {r.name for r in V.read_mirror(spark, layout.mirror(CUSTOMERS), CUSTOMERS, layout.buckets).collect()}


def test_scenarios(spark):
    layout = Layout(scratch_dir(spark, "lake"), 4)

    def run(messages):
        summary = refresh_changes(spark, file_log(log(spark, messages)), layout, [CUSTOMERS])
        return None if summary is None else summary.first().events_read

    assert run(FIRST) == 3
    # insert, update and delete reach the mirror
    assert run(FIRST + CHANGES) == 3
    assert names(spark, layout) == {"Alice2", "Bob", "David"}
    # an idle run changes nothing
    assert run(FIRST + CHANGES) is None
    assert U.newest_run(spark, layout.runs) == 1
    # a new row after an idle run arrives
    assert run(FIRST + CHANGES + LATER) == 1
    assert names(spark, layout) == {"Alice2", "Bob", "David", "Eva"}
    # back to the first run, and forward again
    return_to_run(spark, layout, [CUSTOMERS], 0)
    assert names(spark, layout) == {"Alice", "Bob", "Carol"}
    assert run(FIRST + CHANGES + LATER) == 4
    assert names(spark, layout) == {"Alice2", "Bob", "David", "Eva"}
    # a backfill from offset zero changes nothing either
    backfill(spark, layout, [CUSTOMERS], from_log=True)
    assert run(FIRST + CHANGES + LATER) == 7
    assert names(spark, layout) == {"Alice2", "Bob", "David", "Eva"}
    bronze = spark.read.parquet(I.bronze_path(layout.root, CUSTOMERS))
    assert bronze.count() == 7
    assert rows(current_state(bronze, CUSTOMERS)) == rows(V.read_mirror(spark, layout.mirror(CUSTOMERS), CUSTOMERS, 4))


def test_idle_run_reads_no_messages(spark, monkeypatch):
    from tidemark.plans import medallion

    root = scratch_dir(spark, "lake")
    log(spark, FIRST).write.parquet(f"{root}/log")
    reader, layout = file_log(spark.read.parquet(f"{root}/log")), Layout(root, 4)
    assert refresh_changes(spark, reader, layout, [CUSTOMERS]).first().live_rows == 3
    asked = []

    def watched(start, end):
        asked.append((start, end))
        return reader(start, end)

    assert refresh_changes(spark, watched, layout, [CUSTOMERS]) is None
    assert asked == [({(CUSTOMERS.topic, 0): 3}, None)]
    gate = reader(*asked[0]).groupBy("topic", "partition").agg({"offset": "max"})
    plan = gate._jdf.queryExecution().executedPlan().toString()
    assert "value" not in plan.split("ReadSchema")[1]


def test_tables_without_a_spec_wait(spark):
    """Offsets are stored for what was taken in; a table declared later gets all of its events."""
    layout = Layout(scratch_dir(spark, "lake"), 2)
    driver = message(0, envelope("c", 5, after={"id": 1, "name": "Tom", "rating": "4.85"}), "drivers")
    reader = file_log(log(spark, [*FIRST, driver]))
    assert refresh_changes(spark, reader, layout, [CUSTOMERS]).first().events_read == 3
    assert refresh_changes(spark, reader, layout, [CUSTOMERS, DRIVERS]).first().events_read == 1
    assert V.read_mirror(spark, layout.mirror(DRIVERS), DRIVERS, 2).first().rating == 4.85


def test_any_topic(spark):
    """A spec of another server and table is as good as the two usual ones."""
    from dataclasses import replace

    layout, spec = Layout(scratch_dir(spark, "lake"), 2), replace(PEOPLE, prefix="eu-1.sales.")
    raw = log(spark, [message(0, envelope("c", 5, after={"id": 1, "name": "Tom"}))])
    from pyspark.sql import functions as F

    refresh_changes(spark, file_log(raw.withColumn("topic", F.lit("eu-1.sales.people"))), layout, [spec])
    assert V.read_mirror(spark, layout.mirror(spec), spec, 2).first().name == "Tom"


def test_table_without_events(spark):
    layout = Layout(scratch_dir(spark, "lake"), 2)
    refresh_changes(spark, file_log(log(spark, FIRST)), layout, [CUSTOMERS, DRIVERS])
    drivers = V.read_mirror(spark, layout.mirror(DRIVERS), DRIVERS, 2)
    assert drivers.isEmpty() and drivers.columns == [*DRIVERS.columns.names, "updated_ts"]


def test_medallion(spark):
    root = scratch_dir(spark, "lake")
    drivers = [message(i, envelope("c", 5, after={"id": i + 1, "name": f"d{i}", "rating": "4.5"}), "drivers")
               for i in range(2)]
    trips = spark.createDataFrame([trip(trip_id=i, tip_amount=float(i % 3)) for i in range(20)], COLUMNS).drop("trip_id")
    zones = spark.createDataFrame([(10, "Ten")], "LocationID int, Zone string")
    source = spark.createDataFrame([(1, "Alice", "Alice@example.com", "X"), (2, "Bob", "changed", "X")],
                                   CUSTOMERS.columns)
    layout, reader = Layout(root, 4), file_log(log(spark, FIRST + drivers))
    with pytest.raises(MirrorsDiffer, match="customers: 2 rows differ"):
        run_medallion(spark, reader, trips, zones, layout, sources={"customers": source}, id_mode="dense")
    checks = run_medallion(spark, reader, trips, zones, layout, sources={"customers": source}, must_match=False,
                           id_mode="dense")
    assert {(r.id, r.status) for r in checks["customers"].collect()} == {(2, "changed"), (3, "extra")}
    read = lambda name: spark.read.parquet(layout.gold(name))
    assert read("tipping_behavior").first().trips_count == 20
    assert read("tip_rankings").count() == 1
    assert sorted(r.trips_count for r in read("driver_tip_report").collect()) == [10, 10]
    assert {r.pickup_zone for r in spark.read.parquet(layout.trips("silver")).collect()} == {"Ten"}


def test_streams_agree_with_batch(spark):
    root = scratch_dir(spark, "stream")
    for part in (EDGES[9:], EDGES[4:9], EDGES[:6]):
        edge_log(spark, part).coalesce(1).write.mode("append").parquet(f"{root}/log")

    def run():
        I.stream_bronze(I.message_stream(spark, f"{root}/log", 1), [PEOPLE], root, f"{root}/c1").awaitTermination()
        query = I.stream_silver(I.bronze_stream(spark, root, PEOPLE, 1), f"{root}/mirror", PEOPLE, f"{root}/c2", 4)
        query.awaitTermination()
        return query

    run()
    assert spark.read.parquet(I.bronze_path(root, PEOPLE)).count() == 14
    assert rows(V.read_mirror(spark, f"{root}/mirror", PEOPLE, 4)) == EDGES_MIRROR
    assert sum(p.numInputRows for p in run().recentProgress) == 0
    late = edge_log(spark, [(30, "u", 1, 1, "AliceNew", 999)])
    late.write.mode("append").parquet(f"{root}/log")
    run()
    assert (1, "AliceNew", 999) in rows(V.read_mirror(spark, f"{root}/mirror", PEOPLE, 4))
    whole = bronze_table(spark.read.parquet(f"{root}/log"), PEOPLE)
    assert rows(current_state(whole, PEOPLE)) == rows(V.read_mirror(spark, f"{root}/mirror", PEOPLE, 4))


def test_trip_stream(spark):
    root = scratch_dir(spark, "stream")
    events = to_events(spark.createDataFrame([trip(trip_id=i) for i in range(6)], COLUMNS), "PULocationID")
    events.select("value").repartition(2).write.text(f"{root}/in")
    for _ in range(2):
        I.stream_trips(I.trip_stream(spark, f"{root}/in", files_per_batch=1), f"{root}/out", f"{root}/c").awaitTermination()
    got = spark.read.parquet(f"{root}/out")
    assert got.count() == 6
    assert got.first().fare_amount == 10.0


def test_kafka_is_optional(spark):
    """The readers build the standard source; without its package Spark says so."""
    from tidemark.plans.medallion import kafka_log
    from tidemark.sources.event_log import read_kafka

    for read in (lambda: read_kafka(spark, "localhost:1", [PEOPLE], start={("t", 0): 1}, end={("t", 0): 2}, min_partitions=4),
                 lambda: kafka_log(spark, "localhost:1", [PEOPLE], {PEOPLE.topic: 3})({(PEOPLE.topic, 1): 7}, None),
                 lambda: I.kafka_stream(spark, "localhost:1", [PEOPLE], 1000)):
        with pytest.raises(Exception, match="kafka"):
            read()


def test_checked_sources_are_read_once(spark):
    """The check that fails a run and the differences it hands out come from one reading of the source."""
    from pyspark.sql import functions as F

    raw = log(spark, FIRST + [message(0, envelope("c", 5, after={"id": 1, "name": "Tom", "rating": "4.85"}), "drivers")])
    whole = current_state(bronze_table(raw, CUSTOMERS), CUSTOMERS).select(*CUSTOMERS.columns.names)
    read = spark.sparkContext.accumulator(0)

    def seen(name):
        read.add(1)
        return name

    source = spark.createDataFrame(whole.collect(), CUSTOMERS.columns)
    source = source.withColumn("name", F.udf(seen, "string").asNondeterministic()("name"))
    trips = spark.createDataFrame([trip(trip_id=i) for i in range(4)], COLUMNS).drop("trip_id")
    zones = spark.createDataFrame([(10, "Ten")], "LocationID int, Zone string")
    checks = run_medallion(spark, file_log(raw), trips, zones, Layout(scratch_dir(spark, "lake"), 4), sources={"customers": source})
    assert checks["customers"].count() == 0
    assert read.value == 3


def test_topics_are_taken_in_side_by_side(spark, monkeypatch):
    import threading

    both, append = threading.Barrier(2, timeout=60), I.append_events

    def watched(*args, **kwargs):
        both.wait()
        return append(*args, **kwargs)

    monkeypatch.setattr(I, "append_events", watched)
    layout = Layout(scratch_dir(spark, "lake"), 2)
    driver = message(0, envelope("c", 5, after={"id": 1, "name": "Tom", "rating": "4.85"}), "drivers")
    assert refresh_changes(spark, file_log(log(spark, [*FIRST, driver])), layout, [CUSTOMERS, DRIVERS]).first().events_read == 4
    assert names(spark, layout) == {"Alice", "Bob", "Carol"}


def test_side_by_side_keeps_order_and_fails(spark):
    from tidemark.session import side_by_side

    assert side_by_side(spark, lambda n: spark.range(n).count(), [3, 1, 2]) == [3, 1, 2]
    assert side_by_side(spark, lambda n: n, []) == []
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, lambda n: 1 // n, [1, 0])


def test_gold_does_not_run_a_task_per_shuffle_partition(spark):
    from tidemark.plans.medallion import refresh_gold, refresh_trips

    layout, context = Layout(scratch_dir(spark, "lake"), 2), spark.sparkContext
    trips = spark.createDataFrame([trip(trip_id=i, tip_amount=float(i % 3)) for i in range(20)], COLUMNS).drop("trip_id")
    refresh_changes(spark, file_log(log(spark, [message(0, envelope("c", 5, after={"id": 1, "name": "Tom"}), "drivers")])), layout, [DRIVERS])
    refresh_trips(spark, trips, spark.createDataFrame([(10, "Ten")], "LocationID int, Zone string"), layout)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    context.setJobGroup("gold", "gold")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "100")
        refresh_gold(spark, layout)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = {stage for job in tracker.getJobIdsForGroup("gold") for stage in tracker.getJobInfo(job).stageIds}
    assert 0 < sum(tracker.getStageInfo(stage).numCompletedTasks for stage in stages) < 100
    assert spark.read.parquet(layout.gold("tipping_behavior")).first().trips_count == 20
