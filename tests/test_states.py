import os
import shutil

import pytest
from pyspark.sql import functions as F, types as T

from logs import EDGES, EDGES_MIRROR, PEOPLE, edge_log, rows
from plans import total
from tidemark.operators.changelog import current_state, fold_state, horizons, live_rows
from tidemark.operators.envelope import bronze_table
from tidemark.plans.medallion import (
    Layout, backfill, file_log, mirror_as_of, mirror_of, refresh_changes, return_to_run)
from tidemark.session import scratch_dir
from tidemark.sinks import deltas as D, kept as K, mirrors as V, runs as U


@pytest.fixture
def where(spark):
    return scratch_dir(spark, "test")


def bronze(spark, part):
    return bronze_table(edge_log(spark, part), PEOPLE)


def mirror(spark, part):
    return rows(current_state(bronze(spark, part), PEOPLE))


CUTS = (4, 9, 12, len(EDGES))


def parts():
    return [EDGES[a:b] for a, b in zip((0, *CUTS), CUTS)]


# A base and deltas


def test_deltas_before_and_after_folds(spark, where):
    assert D.read_mirror(spark, where, PEOPLE).count() == 0 and not D.fold(spark, where, PEOPLE)
    for run, part in enumerate(parts()):
        D.append_delta(bronze(spark, part), where, PEOPLE, run)
        if run == 1:
            assert D.fold(spark, where, PEOPLE)
    for run, cut in enumerate(CUTS):
        if run != 0:  # the base holds run 1, so that what run 0 left is still in the deltas
            assert rows(D.read_mirror(spark, where, PEOPLE, run)) == mirror(spark, EDGES[:cut])
    assert rows(D.read_mirror(spark, where, PEOPLE, 0)) == mirror(spark, EDGES[:CUTS[0]])
    assert rows(D.read_mirror(spark, where, PEOPLE)) == EDGES_MIRROR
    assert not D.fold(spark, where, PEOPLE, share=10.0) and D.fold(spark, where, PEOPLE, share=0.1)
    assert rows(D.read_mirror(spark, where, PEOPLE)) == EDGES_MIRROR
    D.return_to(spark, where, PEOPLE, 1, 4)
    assert rows(D.read_mirror(spark, where, PEOPLE)) == mirror(spark, EDGES[:CUTS[1]])
    assert rows(D.read_mirror(spark, where, PEOPLE, 3)) == EDGES_MIRROR


def test_repeated_and_dead_runs(spark, where, monkeypatch):
    D.append_delta(bronze(spark, EDGES[:9]), where, PEOPLE, 0)
    D.fold(spark, where, PEOPLE)
    D.append_delta(bronze(spark, EDGES[9:11]), where, PEOPLE, 1)
    D.append_delta(bronze(spark, EDGES[9:]), where, PEOPLE, 1)  # the repetition saw more of the log
    assert rows(D.read_mirror(spark, where, PEOPLE)) == EDGES_MIRROR
    # A delta and a base whose writes were not finished: files are there, the mark is not.
    for source, target in ((f"{where}/deltas/run=0.0", f"{where}/deltas/run=1.2"), (f"{where}/bases/through=0.0", f"{where}/bases/through=7.0")):
        shutil.copytree(source, target)
        os.remove(f"{target}/_SUCCESS")
    assert rows(D.read_mirror(spark, where, PEOPLE)) == EDGES_MIRROR
    assert D.fold(spark, where, PEOPLE, share=0.0)
    assert D.drop_before(spark, where, 1) == 6 and sorted(os.listdir(f"{where}/bases")) == ["through=1.0"]
    assert rows(D.read_mirror(spark, where, PEOPLE)) == EDGES_MIRROR and not os.listdir(f"{where}/deltas")


def test_base_rows_that_no_delta_mentions_are_not_shuffled(spark, where):
    seed = bronze(spark, [(0, "c", None, 1, "n", 1)]).drop("after_id", "kafka_offset").crossJoin(
        spark.range(5000).selectExpr("cast(id AS int) AS after_id", "id AS kafka_offset"))
    D.append_delta(seed, where, PEOPLE, 0)
    D.fold(spark, where, PEOPLE)
    D.append_delta(bronze(spark, [(6000, "u", 5, 5, "new", 500), (6001, "d", 7, None, None, 501)]), where, PEOPLE, 1)
    state = D.read_state(spark, where, PEOPLE)
    assert len(state.collect()) == 5000 and total(state, "Exchange", "shuffleRecordsWritten") < 100
    assert D.read_mirror(spark, where, PEOPLE).count() == 4999


def test_widened_deltas(spark, where):
    wide = PEOPLE.with_column("phone", T.StringType())
    D.append_delta(bronze(spark, EDGES), where, PEOPLE, 0)
    D.fold(spark, where, PEOPLE)
    later = bronze(spark, [(20, "c", None, 50, "Wide", 900)]).withColumn("after_phone", F.lit("1")).withColumn("before_phone", F.lit(None).cast("string"))
    D.append_delta(later, where, wide, 1)
    assert {(r.id, r.phone) for r in D.read_mirror(spark, where, wide).collect()} == {(0, None), (1, None), (2, None), (4, None), (50, "1")}


# States kept, and the tail of the log


def test_state_from_the_nearest_kept_one(spark, where):
    log = bronze(spark, EDGES)
    log.repartitionByRange(5, "kafka_offset").sortWithinPartitions("kafka_offset").write.parquet(f"{where}/bronze")
    stored = spark.read.parquet(f"{where}/bronze")
    for cut in CUTS:
        U.save_run(spark.createDataFrame([(PEOPLE.topic, 0, EDGES[cut - 1][0] + 1), ("other", 0, 5)], U.OFFSETS), f"{where}/runs")
    reach = [K.reached(spark, f"{where}/runs", PEOPLE, run) for run in range(4)]
    whole = K.state_at(stored, PEOPLE, reach[2], f"{where}/kept", f"{where}/runs")
    assert rows(live_rows(whole, PEOPLE)) == mirror(spark, EDGES[:CUTS[2]])
    for run in (1, 3):
        K.keep_state(fold_state(bronze(spark, EDGES[:CUTS[run]]), PEOPLE), f"{where}/kept", run)
    for run, cut in enumerate(CUTS):
        state = K.state_at(stored, PEOPLE, reach[run], f"{where}/kept", f"{where}/runs")
        assert rows(live_rows(state, PEOPLE)) == mirror(spark, EDGES[:cut])
    # From run 1 to run 2 there are offsets 9 to 11: of five files, those with other offsets are not read.
    state = K.state_at(stored, PEOPLE, reach[2], f"{where}/kept", f"{where}/runs")
    state.collect()
    kept = spark.read.parquet(f"{where}/kept/run=1").count()
    assert total(state, "Scan parquet", "numOutputRows") - kept <= 6
    os.remove(f"{where}/kept/run=3/_SUCCESS")
    assert K.kept_runs(spark, f"{where}/kept") == [1]


@pytest.mark.parametrize("kept_as", [{"buckets": 4}, {"buckets": 4, "keep_every": 2}, {"fold_share": 0.5}])
def test_runs_of_a_lake(spark, where, kept_as):
    layout, cuts = Layout(where, **kept_as), CUTS[1::2]
    for cut in cuts:
        refresh_changes(spark, file_log(edge_log(spark, EDGES[:cut])), layout, [PEOPLE])
    assert refresh_changes(spark, file_log(edge_log(spark)), layout, [PEOPLE]) is None
    assert rows(mirror_of(spark, layout, PEOPLE)) == EDGES_MIRROR
    for run, cut in enumerate(cuts):
        assert rows(mirror_as_of(spark, layout, PEOPLE, run)) == mirror(spark, EDGES[:cut])
    return_to_run(spark, layout, [PEOPLE], 0)
    assert rows(mirror_of(spark, layout, PEOPLE)) == mirror(spark, EDGES[:cuts[0]])
    refresh_changes(spark, file_log(edge_log(spark)), layout, [PEOPLE])
    assert rows(mirror_of(spark, layout, PEOPLE)) == EDGES_MIRROR
    backfill(spark, layout, [PEOPLE])
    assert rows(mirror_of(spark, layout, PEOPLE)) == EDGES_MIRROR
    assert rows(mirror_as_of(spark, layout, PEOPLE, 2)) == mirror(spark, EDGES[:cuts[0]])


# Deletion markers


def test_markers_are_dropped_and_late_events_refused(spark, where):
    first = [(0, "c", None, 1, "a", 1000), (1, "d", 1, None, None, 1100), (2, "c", None, 2, "b", 1200), (3, "d", 2, None, None, 5000),
             (4, "c", None, 3, "c", 9000)]
    late = [(5, "u", 1, 1, "ghost", 1050), (6, "u", 2, 2, "older", 4900), (7, "c", None, 4, "in time", 6000), (8, "c", None, 5, "x", 20_000),
            (9, "t", None, None, None, 1), (10, "c", None, 6, "none", None)]
    log, live = lambda: bronze(spark, first + late), {(3, "c", 9000), (4, "in time", 6000), (5, "x", 20_000)}
    horizon = V.merge_within_horizon(bronze(spark, first), where, PEOPLE, 4500, 0, 4, log)
    assert horizon == {(PEOPLE.topic, 0): 4500} and V.read_refused(spark, where, PEOPLE).count() == 0
    V.drop_markers(spark, where, PEOPLE, 1, 4)
    state = {(r.id, r.deleted) for r in V.read_state(spark, where, PEOPLE, 4).collect()}
    assert state == {(2, True), (3, False)}  # the marker of 1 is gone, that of 2 is still needed
    for _ in range(2):  # the second time is a repetition
        horizon = V.merge_within_horizon(bronze(spark, late), where, PEOPLE, 4500, 1, 4, log)
        assert horizon == {(PEOPLE.topic, 0): 15_500}
        assert rows(V.read_mirror(spark, where, PEOPLE, 4)) == live
        refused = {(r.after_id, r.reason, r.run) for r in V.read_refused(spark, where, PEOPLE).collect()}
        assert refused == {(1, "too_late", 1), (6, "too_late", 1)}
    V.drop_markers(spark, where, PEOPLE, 2, 4)
    assert {r.id for r in V.read_state(spark, where, PEOPLE, 4).collect()} == {3, 4, 5}
    assert V.drop_markers(spark, where, PEOPLE, 2, 4) == []
    # What was refused stays out when buckets are rebuilt from the log.
    V.announce(spark, [0, 1, 2, 3], where, 4)
    V.merge_within_horizon(bronze(spark, []), where, PEOPLE, 4500, 2, 4, log)
    assert rows(V.read_mirror(spark, where, PEOPLE, 4)) == live


def test_a_bucket_that_empties_is_removed(spark, where):
    V.merge_into_mirror(bronze(spark, [(0, "c", None, 1, "a", 10)]), where, PEOPLE, 1)
    V.merge_into_mirror(bronze(spark, [(1, "d", 1, None, None, 20)]), where, PEOPLE, 1, horizon={(PEOPLE.topic, 0): 100})
    assert V.read_state(spark, where, PEOPLE, 1).count() == 0


def test_horizons_never_fall(spark):
    log = bronze(spark, EDGES)
    assert horizons(log, 50) == {(PEOPLE.topic, 0): 140}
    assert horizons(log, 50, {(PEOPLE.topic, 0): 150, (PEOPLE.topic, 1): 7}) == {(PEOPLE.topic, 0): 150, (PEOPLE.topic, 1): 7}
    assert horizons(log.filter("false"), 50, {(PEOPLE.topic, 0): 5}) == {(PEOPLE.topic, 0): 5}
