import glob
import os
import shutil

import pytest

from logs import EDGES, EDGES_MIRROR, PEOPLE, edge_log, rows
from plans import total
from tidemark.operators.envelope import bronze_table
from tidemark.operators.ids import numbered
from tidemark.plans.medallion import Layout, file_log, fold_bronze, mirror_as_of, mirror_of, refresh_changes
from tidemark.session import scratch_dir
from tidemark.sinks import allocations as A, compaction as Z
from tidemark.sinks.tables import append_events


@pytest.fixture
def where(spark):
    return scratch_dir(spark, "test")


def log(spark, offsets, partition=0):
    return spark.createDataFrame([(int(i),) for i in offsets], "i long").selectExpr(
        "'t' AS topic", f"{partition} AS kafka_partition", "i AS kafka_offset", "concat('v', i) AS value")


def offsets(df):
    return sorted(r.kafka_offset for r in df.collect())


def test_folds_and_reads(spark, where):
    assert Z.read_log(spark, where) is None and Z.fold_log(spark, where) == 0
    for a in range(0, 600, 100):
        append_events(log(spark, range(a, a + 100)), where)
    append_events(log(spark, range(50), partition=1), where)
    assert Z.fold_log(spark, where, file_rows=100) == 650 and Z.fold_log(spark, where) == 0
    append_events(log(spark, range(560, 640)), where)  # forty of them are in the segment
    append_events(log(spark, [3000, 700]), where)
    assert offsets(Z.read_log(spark, where)) == sorted([*range(640), *range(50), 700, 3000])
    assert Z.drop_folded(spark, where) > 6 and Z.drop_folded(spark, where) == 0
    append_events(log(spark, range(640)), where)  # all stored, partly in dropped files
    append_events(log(spark, [2000]), where)  # below what came before it
    assert Z.fold_log(spark, where) == 43
    assert offsets(Z.read_log(spark, where)) == sorted([*range(640), *range(50), 700, 2000, 3000])
    Z.drop_folded(spark, where)
    assert offsets(Z.read_log(spark, where)) == sorted([*range(640), *range(50), 700, 2000, 3000])


def test_a_stretch_opens_few_files(spark, where):
    for a in range(0, 1000, 50):
        append_events(log(spark, range(a, a + 50)), where)
    Z.fold_log(spark, where, file_rows=100)
    part = Z.read_log(spark, where, None, {("t", 0): 420}, {("t", 0): 380})
    assert offsets(part) == list(range(380, 420)) and total(part, "Scan parquet", "numFiles") <= 3
    assert len(glob.glob(f"{where}_segments/rows/*/*.parquet")) >= 9
    assert offsets(Z.read_log(spark, where, None, {("t", 5): 10})) == []


def test_a_fold_that_died_is_not_read(spark, where):
    append_events(log(spark, range(10)), where)
    Z.fold_log(spark, where)
    os.remove(f"{where}_segments/bounds/segment=0/_SUCCESS")
    assert offsets(Z.read_log(spark, where)) == list(range(10)) and Z.drop_folded(spark, where) == 0
    shutil.rmtree(f"{where}_segments/sources")
    assert Z.fold_log(spark, where) == 10 and offsets(Z.read_log(spark, where)) == list(range(10))


def test_lake_with_folded_bronze(spark, where):
    layout = Layout(where, 4)
    refresh_changes(spark, file_log(edge_log(spark, EDGES[:9])), layout, [PEOPLE])
    assert fold_bronze(spark, layout, [PEOPLE], drop=True) == {"people": bronze_table(edge_log(spark, EDGES[:9]), PEOPLE).count()}
    refresh_changes(spark, file_log(edge_log(spark)), layout, [PEOPLE])
    assert rows(mirror_of(spark, layout, PEOPLE)) == EDGES_MIRROR == rows(mirror_as_of(spark, layout, PEOPLE, 1))


def test_ranges_of_batches(spark, where):
    assert [A.allocate(spark, where, name, n) for name, n in (("a", 10), ("b", 5), ("a", 10), ("a", 7), ("a", 12), ("c", 0), ("b", 5), ("a", 12))] \
        == [0, 10, 0, 0, 15, 27, 10, 15]
    os.makedirs(f"{where}/number=4")  # of a run that died before its range was stored
    assert A.allocate(spark, where, "d", 1) == 27 and {r.number for r in A.allocations(spark, where).collect()} == {0, 1, 2, 3, 5}


def test_numbers_without_gaps(spark):
    df = spark.range(0, 1000, 1, 7).selectExpr("id % 10 AS k", "id AS v")
    for keys in (["k"], None):
        got = numbered(df, keys, "n", lambda rows: 5 * rows).orderBy("n").collect()
        assert [r.n for r in got] == list(range(5000, 6000)) and sorted(r.v for r in got) == list(range(1000))
    assert [r.k for r in numbered(df, ["k"], "n").orderBy("n").collect()] == sorted(r.k for r in df.collect())
    assert numbered(df.limit(0), ["k"]).count() == 0
