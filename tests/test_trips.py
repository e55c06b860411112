import glob
import json
import os
import shutil
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from logs import rows
from tidemark.operators import quality as Q, trips as R
from tidemark.operators.ids import assign_ids
from tidemark.session import scratch_dir
from tidemark.sinks.messages import from_events, to_events
from tidemark.sources.drift import file_groups
from tidemark.sources.trips import read_trips, unreadable_values

COLUMNS = ("trip_id long, PULocationID int, DOLocationID int, fare_amount double, tip_amount double, "
           "payment_type int, trip_distance double, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz")


def at(hour, minute=0, second=0):
    return datetime(2025, 1, 1, hour, minute, second)


GOOD = (1, 10, 20, 10.0, 2.0, 1, 5.0, at(8), at(8, 30))


def trip(**changes):
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    return tuple({**dict(zip(names, GOOD)), **changes}.values())


def test_cleaning(spark):
    data = [
        trip(), trip(trip_id=2, tpep_dropoff_datetime=at(8)), trip(trip_id=3, tip_amount=0.0, payment_type=None),
        trip(trip_id=4, fare_amount=0.0), trip(trip_id=5, tip_amount=-0.1), trip(trip_id=6, trip_distance=0.0),
        trip(trip_id=7, tpep_dropoff_datetime=at(7)), trip(trip_id=8, fare_amount=None), trip(trip_id=9, tip_amount=None),
        trip(trip_id=10, trip_distance=None), trip(trip_id=11, tpep_pickup_datetime=None),
        trip(trip_id=12, tpep_dropoff_datetime=None), trip(trip_id=13, fare_amount=-1.0, tip_amount=-1.0)]
    df = spark.createDataFrame(data, COLUMNS)
    clean = {r.trip_id: r for r in R.clean_trips(df).collect()}
    assert set(clean) == {1, 2, 3}
    assert (clean[1].trip_duration_minutes, clean[1].trip_speed_kmh) == (30.0, 10.0)
    assert (clean[2].trip_duration_minutes, clean[2].trip_speed_kmh) == (0.0, None)
    assert R.clean_trips(df, 1.5).filter("trip_id = 1").first().trip_speed_kmh == 15.0
    report = {r.measure: r.trips for r in R.rejected_trips(df).collect()}
    assert report == {"fare_present": 1, "tip_present": 1, "distance_present": 1, "pickup_present": 1,
                      "dropoff_present": 1, "dropoff_not_before_pickup": 1, "fare_positive": 2, "tip_not_negative": 2,
                      "distance_positive": 1, "all_trips": 13, "kept_trips": 3}


def test_text_columns_in_any_case(spark):
    data = [("1", "10", "20", "9.5", "1", "2", "3", "2025-01-01 08:00:00", "2025-01-01 08:10:59.9"),
            ("2", "10", "20", "dear", "1", "2", "3", "2025-01-01 08:00:00", "2025-01-01 08:10:00"),
            ("3", "10", "20", "9.5", "1", "x", "3", "2025-01-01 08:00:00", "soon")]
    names = [c.split()[0].lower() for c in COLUMNS.split(", ")]
    clean = R.clean_trips(spark.createDataFrame(data, names)).collect()
    assert [(r.trip_id, r.PULocationID, r.fare_amount) for r in clean] == [("1", 10, 9.5)]
    assert clean[0].trip_duration_minutes == pytest.approx(659 / 60)
    with pytest.raises(ValueError, match="tip_amount"):
        R.clean_trips(spark.createDataFrame(data, names).drop("tip_amount"))


def test_filters_reach_the_scan(spark):
    where = scratch_dir(spark, "trips")
    spark.createDataFrame([trip()], COLUMNS).write.parquet(where)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = R.clean_trips(spark.read.parquet(where))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(fare_amount,0.0)" in plan and "GreaterThanOrEqual(tip_amount,0.0)" in plan


def test_zones(spark):
    zones = spark.createDataFrame([(10, "Alphabet City"), (30, "Bay Ridge")], "locationid int, zone string")
    df = spark.createDataFrame([trip(), trip(trip_id=2, PULocationID=30, DOLocationID=10)], COLUMNS)
    found = R.enrich_zones(R.clean_trips(df), zones).select("trip_id", "pickup_zone", "dropoff_zone")
    assert rows(found) == {(1, "Alphabet City", None), (2, "Bay Ridge", "Alphabet City")}
    with pytest.raises(Exception, match="several rows"):
        R.enrich_zones(R.clean_trips(df), zones.union(zones)).collect()


def test_zones_without_broadcast(spark):
    """The same result when the lookup is too large to broadcast and one zone holds nearly all trips."""
    zones = spark.range(500).selectExpr("cast(id AS int) AS LocationID", "concat('zone-', id) AS Zone")
    df = spark.range(20_000).selectExpr("id AS trip_id", "cast(if(id % 50 = 0, id % 500, 7) AS int) AS PULocationID",
                                        "cast(id % 700 AS int) AS DOLocationID")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    expected = rows(R.enrich_zones(df, zones))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert rows(R.enrich_zones(df, zones)) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_dense_ids(spark):
    """Dense and in key order, also when a third of the rows share one key and some are identical."""
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id % 5 AS v").repartition(7)
    got = assign_ids(df, "dense", ["k"]).orderBy("trip_id").collect()
    assert [r.trip_id for r in got] == list(range(3000))
    assert [r.k for r in got] == sorted(r.k for r in df.collect())
    again = assign_ids(df.repartition(3), "dense", ["k"])
    assert rows(again) == {tuple(r) for r in got}


def test_dense_ids_do_not_shuffle_rows_again(spark):
    """Where each partition begins is a row per partition, however large Spark takes it to be."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = assign_ids(spark.range(300).selectExpr("id AS k"), "dense", ["k"])
        assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.trip_id for r in got.collect()) == list(range(300))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_other_ids(spark):
    df = spark.range(100).selectExpr("id AS a", "cast(id AS string) AS b")
    assert assign_ids(df, "fast").select("trip_id").distinct().count() == 100
    assert rows(assign_ids(df, "hash")) == rows(assign_ids(df.repartition(5), "hash"))
    with pytest.raises(ValueError):
        assign_ids(df, "guess")


def test_reading_trip_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_trips(spark, str(tmp_path / "nowhere"))
    (tmp_path / "empty").mkdir()
    spark.range(1).write.parquet(str(tmp_path / "empty" / "taxi_zone_lookup.parquet"))
    with pytest.raises(FileNotFoundError):
        read_trips(spark, str(tmp_path / "empty"))
    folder = tmp_path / "trips"
    spark.createDataFrame([trip()], COLUMNS).coalesce(1).write.parquet(str(folder / "yellow_tripdata_2025-01.parquet"))
    names = "*.parquet"
    nested = str(folder / "yellow_tripdata_2025-01.parquet")
    assert read_trips(spark, nested, names).count() == 1
    spark.createDataFrame([], COLUMNS).coalesce(1).write.parquet(str(tmp_path / "none"))
    with pytest.raises(ValueError):
        read_trips(spark, str(tmp_path / "none"), names)


def monthly(spark, folder, **months):
    """A file per month of one column ``v`` or as given, named so that the order is that of the keywords."""
    for i, (name, (schema, values)) in enumerate(months.items()):
        spark.createDataFrame([(v if isinstance(v, tuple) else (v,)) for v in values], schema).coalesce(1) \
            .write.parquet(f"{folder}/{i}_{name}.parquet")
    return str(folder)


def test_files_of_differing_types(spark, tmp_path):
    folder = monthly(
        spark, tmp_path / "in",
        whole=("passenger_count bigint, fare_amount double", [(1, 1.0), (2 ** 53 + 1, 2.0), (None, 3.0)]),
        same=("passenger_count bigint, extra double", [(3, 0.5)]),
        real=("passenger_count double, fare_amount double", [(4.0, 1.0), (4.5, 1.0), (float("nan"), 1.0), (1e30, 1.0)]),
        text=("Passenger_Count string, fare_amount string", [("5", "1.25"), ("6.0", "x"), ("6.5", None), ("", "2")]),
        exact=("passenger_count decimal(5,1), fare_amount decimal(5,2)", [(Decimal("7.0"), Decimal("1.10")), (Decimal("7.5"), None)]),
        lacking=("fare_amount float", [1.5]))
    files = [f"{folder}/{name}/*.parquet" for name in sorted(os.listdir(folder))]
    groups = file_groups(spark, [f for pattern in files for f in glob.glob(pattern)], folder)
    # A file that lacks a column agrees with what is there; float and decimal fares differ.
    assert [len(g.files) for g in groups] == [2, 1, 1, 1, 1]
    flat = str(tmp_path / "flat")
    os.makedirs(flat)
    for name in sorted(os.listdir(folder)):
        shutil.copy(glob.glob(f"{folder}/{name}/*.parquet")[0], f"{flat}/{name}")
    read = read_trips(spark, flat, "*.parquet")
    assert {f.name: f.dataType.simpleString() for f in read.schema} == {
        "passenger_count": "bigint", "fare_amount": "double", "extra": "double"}
    found = sorted((r.passenger_count or 0, r.fare_amount or 0, r.extra or 0) for r in read.collect())
    assert found == sorted([(1, 1.0, 0), (2 ** 53 + 1, 2.0, 0), (0, 3.0, 0), (3, 0, 0.5), (4, 1.0, 0), (0, 1.0, 0), (0, 1.0, 0),
                            (0, 1.0, 0), (5, 1.25, 0), (6, 0, 0), (0, 0, 0), (0, 2.0, 0), (7, 1.1, 0), (0, 0, 0), (0, 1.5, 0)])
    lost = {(r.file[0], r.column, r.given, r.wanted): (r.rows, r.example) for r in unreadable_values(spark, flat, "*.parquet").collect()}
    assert lost == {("2", "passenger_count", "double", "bigint"): (3, "1.0E30"), ("3", "passenger_count", "string", "bigint"): (2, ""),
                    ("3", "fare_amount", "string", "double"): (1, "x"), ("4", "passenger_count", "decimal(5,1)", "bigint"): (1, "7.5")}
    one = glob.glob(f"{folder}/0_whole.parquet/*.parquet")[0]
    assert unreadable_values(spark, one, "*.parquet").count() == 0 and read_trips(spark, one, "*.parquet").count() == 3


def test_undeclared_column_that_drifts_is_text(spark, tmp_path):
    folder = monthly(spark, tmp_path / "in", a=("note int, fare_amount double", [(1, 1.0)]),
                     b=("note boolean, fare_amount double", [(True, 2.0)]))
    flat = tmp_path / "flat"
    flat.mkdir()
    for name in os.listdir(folder):
        shutil.copy(glob.glob(f"{folder}/{name}/*.parquet")[0], flat / name)
    assert rows(read_trips(spark, str(flat), "*.parquet").select("note", "fare_amount")) == {("1", 1.0), ("true", 2.0)}


def test_events(spark):
    sent = to_events(spark.createDataFrame([trip(payment_type=None, tip_amount=float("nan"))], COLUMNS)
                     .withColumn("VendorID", F.lit(2)), "vendorid")
    message = sent.first()
    assert message.key == "2"
    body = json.loads(message.value)
    assert body["tpep_pickup_datetime"] == "2025-01-01T08:00:00" and body["payment_type"] is None
    back = from_events(sent).first()
    assert (back.fare_amount, back.tpep_dropoff_datetime, back.VendorID) == (10.0, at(8, 30), 2)
    bare = spark.createDataFrame([('{"tip_amount": NaN, "fare_amount": 3.5}',)], "value string")
    assert from_events(bare).first().fare_amount == 3.5


def test_quality_checks(spark):
    frame = lambda data: spark.createDataFrame(data, "id int, a string, b int")
    source, mirror = frame([(1, "x", 1), (2, "y", None), (3, "z", 3)]), frame([(1, "x", 1), (2, "y", 5), (4, "w", 4)])
    found = {(r.id, r.status, tuple(r["columns"] or ())) for r in Q.reconcile(source, mirror, "id").collect()}
    assert found == {(2, "changed", ("b",)), (3, "missing", ()), (4, "extra", ())}
    assert Q.assert_counts(source, mirror) == (3, 3)
    assert Q.assert_counts(source, mirror.limit(2), tolerance=1) == (3, 2)
    with pytest.raises(Q.MismatchError):
        Q.assert_counts(source, mirror.limit(2))
    assert Q.same_rows(source, source.orderBy("b")) and not Q.same_rows(source, source.union(source))
    assert rows(Q.row_diff(frame([(1, "x", 1)] * 2), frame([(1, "x", 1)]))) == {(1, "x", 1, 2, 1)}
    assert rows(Q.layer_counts(a=source, b=source.limit(1))) == {("a", 3), ("b", 1)}
    assert [r.column for r in Q.describe(source).orderBy("position").collect()] == ["id", "a", "b"]
