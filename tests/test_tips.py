import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logs import rows
from tidemark.operators import tips

COLUMNS = ("trip_id long, PULocationID int, fare_amount double, tip_amount double, payment_type int, "
           "tpep_pickup_datetime timestamp")


@pytest.fixture(scope="module")
def data():
    """Trips with a zone that holds a third of them, ties and missing payment types."""
    pick = random.Random(3)
    start = datetime(2025, 1, 1)
    return [(i, 0 if i % 3 == 0 else pick.randrange(14), float(pick.choice([5, 8, 10, 40])),
             float(pick.choice([0, 0, 1, 2, 3, 4])), pick.choice([None, 1, 2, 3]),
             start + timedelta(minutes=pick.randrange(3 * 24 * 60))) for i in range(3000)]


@pytest.fixture
def trips(spark, data):
    return spark.createDataFrame(data, COLUMNS)


def mean(values):
    return sum(values) / len(values)


def grouped(data, key):
    groups = defaultdict(list)
    for row in data:
        groups[key(row)].append(row)
    return groups


def pct(row):
    return row[3] / row[2] * 100


def test_behavior(trips, data):
    expected = {}
    for key, group in grouped(data, lambda r: (r[1], r[5].hour)).items():
        high = Counter(r[4] for r in group if pct(r) > 20)
        mode = min(high, key=lambda p: (-high[p], -1 if p is None else p)) if high else None
        expected[key] = (mean([r[3] for r in group]), mean([pct(r) for r in group]),
                         100 * mean([r[3] == 0 for r in group]), 100 * mean([pct(r) > 20 for r in group]),
                         len(group), mode)
    found = {(r.PULocationID, r.pickup_hour): r for r in tips.tip_behavior(trips).collect()}
    assert found.keys() == expected.keys()
    for key, want in expected.items():
        row = found[key]
        assert (row.avg_tip_amount, row.avg_tip_percentage, row.pct_zero_tip, row.pct_high_tip, row.trips_count) == \
            pytest.approx(want[:5])
        assert row.high_tip_common_payment_type == want[5]
    best = tips.best_zone_hour(trips).first()
    top = min(expected, key=lambda k: (-round(expected[k][1], 9), k))
    assert (best.PULocationID, best.pickup_hour) == top
    assert [r.PULocationID for r in tips.top_zone_hours(trips, 5).collect()] == \
        [r.PULocationID for r in tips.top_behavior(trips, 5).collect()]


def test_rankings(trips, data):
    zones = {k: mean([pct(r) for r in g]) for k, g in grouped(data, lambda r: (r[5].date(), r[1])).items()}
    hours = {k: mean([pct(r) for r in g]) for k, g in grouped(data, lambda r: (r[5].date(), r[5].hour)).items()}
    expected, overlap = {}, 0
    for day in {k[0] for k in zones}:
        of_day = [z for d, z in zones if d == day]
        top = sorted(of_day, key=lambda z: (-zones[day, z], z))[:10]
        bottom = sorted(of_day, key=lambda z: (zones[day, z], z))[:10]
        best = min((h for d, h in hours if d == day), key=lambda h: (-hours[day, h], h))
        overlap += len(set(top) & set(bottom))
        for zone in {*top, *bottom}:
            expected[day, zone] = ("top10" if zone in top else "bottom10", best)
    found = {(r.trip_date, r.PULocationID): (r.ranking_bucket, r.best_hour_global)
             for r in tips.tip_rankings(trips).collect()}
    assert found == expected
    assert overlap > 0
    assert tips.tip_rankings(trips, both=True).count() == len(expected) + overlap


def test_hour_without_a_tiebreak_loser(spark):
    same = [(i, 1, 10.0, 2.0, 1, datetime(2025, 1, 1, hour)) for i, hour in enumerate((9, 4, 7))]
    trips = spark.createDataFrame(same, COLUMNS)
    assert tips.best_hour(trips).first().pickup_hour == 4
    assert tips.tip_rankings(trips).first().best_hour_global == 4
    assert tips.best_zone_hour(trips).first().pickup_hour == 4


def test_one_scan_for_all_rankings(spark, trips):
    from tidemark.session import materialize

    ranked = tips.tip_rankings(materialize(trips, "scan"))
    ranked.collect()
    final = ranked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1


def test_tables_from_shared_totals(trips):
    totals = tips.daily_totals(trips)
    by_payment = tips.roll_up(totals, "PULocationID", "pickup_hour", "payment_type")
    keys = lambda df: {(r.PULocationID, r.pickup_hour, r.high_tip_common_payment_type, r.trips_count) for r in df.collect()}
    assert keys(tips.behavior_from_totals(by_payment)) == keys(tips.tip_behavior(trips))
    labels = lambda df: {(r.trip_date, r.PULocationID, r.ranking_bucket) for r in df.collect()}
    assert labels(tips.rankings_from_totals(totals)) == labels(tips.tip_rankings(trips))


def test_drivers(spark, trips, data):
    drivers = spark.createDataFrame([(6, 4.9), (3, 4.5), (1, 4.5), (7, None)], "id int, rating double")
    by_id = {r.driver_id: r for r in tips.driver_tip_report(trips, drivers).collect()}
    assert {k: r.trips_count for k, r in by_id.items()} == {1: 750, 3: 750}
    assert by_id[3].avg_tip_pct == pytest.approx(mean([pct(r) for r in data if r[0] % 4 == 2]))
    dense = {r.driver_id: r for r in tips.driver_tip_report(trips, drivers, "dense").collect()}
    assert {k: r.trips_count for k, r in dense.items()} == {1: 750, 3: 750, 6: 750, 7: 750}
    assert dense[6].avg_tip_amount == pytest.approx(mean([r[3] for r in data if r[0] % 4 == 2]))
    report = tips.driver_tip_report(trips, drivers, "dense")
    assert [r.driver_id for r in tips.top_drivers(report, 1).collect()] == [6]
    assert {(r.driver_rating, r.drivers) for r in tips.rating_vs_tip(report).collect()} == {(4.9, 1), (4.5, 2), (None, 1)}
    assert tips.rating_tip_correlation(report).first().correlation is not None
    assert tips.rating_tip_correlation(report.filter("driver_rating = 4.5")).first().correlation is None
    assert tips.driver_tip_report(trips, drivers.limit(0)).isEmpty()
    with pytest.raises(ValueError):
        tips.driver_tip_report(trips, drivers, "random")


def test_negative_ids_still_find_a_driver(spark):
    trips = spark.createDataFrame([(-3, 1, 10.0, 1.0, 1, datetime(2025, 1, 1))], COLUMNS)
    drivers = spark.createDataFrame([(1, 4.0), (2, 4.0)], "id int, rating double")
    assert [r.driver_id for r in tips.driver_tip_report(trips, drivers).collect()] == [2]


def test_keyed_trips(spark):
    trips = spark.createDataFrame([(1, 10.0, 1.0), (1, 0.0, 1.0), (2, 10.0, 3.0), (9, 1.0, 1.0)],
                                  "driver_id int, fare_amount double, tip_amount double")
    drivers = spark.createDataFrame([(1, 4.0), (2, 5.0)], "id int, rating double")
    assert rows(tips.driver_tip_by_key(trips, drivers)) == {(1, 4.0, 10.0), (2, 5.0, 30.0)}


def test_mode_counts_null_as_smallest(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), ("b", 2), ("b", 1), ("b", 2), ("c", None)], "k string, v int")
    assert rows(tips.mode_per_group(df, ["k"], "v")) == {("a", None, 1), ("b", 2, 2), ("c", None, 1)}
    assert tips.high_tip_mode(df.select(F.lit(1).alias("PULocationID"), F.lit(1.0).alias("fare_amount"),
                                        F.lit(0.1).alias("tip_amount"), F.lit(1).alias("payment_type"),
                                        F.current_timestamp().alias("tpep_pickup_datetime"))).isEmpty()
