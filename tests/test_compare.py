import pytest
from pyspark.sql import functions as F

from logs import rows
from plans import total
from tidemark.operators import quality as Q

SCHEMA = "id long, a string, b double"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def sides(spark, tmp_path_factory):
    """Two stored tables of 20,000 rows that differ in three."""
    root = str(tmp_path_factory.mktemp("sides"))
    a = spark.range(20_000).selectExpr("id", "concat('row ', id) AS a", "id / 7.0D AS b")
    b = a.filter("id <> 17").withColumn("b", F.when(F.col("id") == 4711, None).otherwise(F.col("b")))
    b = b.unionByName(a.filter("id = 99"))
    a.write.parquet(f"{root}/a")
    b.write.parquet(f"{root}/b")
    return spark.read.parquet(f"{root}/a"), spark.read.parquet(f"{root}/b")


def test_only_differing_buckets_are_shuffled(sides):
    a, b = sides
    found = Q.bucket_diff(a, b, ["id"], 256)
    assert rows(found) == rows(Q.row_diff(a, b)) == {
        (17, "row 17", 17 / 7, 1, 0), (4711, "row 4711", 4711 / 7, 1, 0), (4711, "row 4711", None, 0, 1), (99, "row 99", 99 / 7, 1, 2)}
    assert {r.bucket for r in Q.differing_buckets(a, b, ["id"], 256).collect()} == {
        r.n for r in a.filter("id IN (17, 4711, 99)").select(F.pmod(F.xxhash64("id"), F.lit(256)).alias("n")).collect()}
    # Three buckets of 256, read from both sides, of some 78 rows each.
    assert total(found, "Exchange", "shuffleRecordsWritten") < 3 * 2 * 140
    plain = Q.row_diff(a, b)
    plain.collect()
    assert total(plain, "Exchange", "shuffleRecordsWritten") > 20_000


def test_equal_sides_shuffle_nothing(sides):
    a, _ = sides
    found = Q.bucket_diff(a, a.orderBy(F.desc("id")), ["id"])
    assert found.collect() == [] and total(found, "Exchange", "shuffleRecordsWritten") == 0


def test_values_that_hash_alike(spark):
    a = frame(spark, [(1, None, 2.0), (2, "x", None), (None, None, None), (3, "s", 0.0)])
    moved = frame(spark, [(1, None, None), (2, None, 2.0), (None, "x", None), (3, "s", -0.0)])
    for keys in (None, ["id"]):
        assert rows(Q.bucket_diff(a, moved, keys, 4)) == rows(Q.row_diff(a, moved))
        assert Q.bucket_diff(a, frame(spark, []), keys, 4).count() == 4 and Q.bucket_diff(frame(spark, []), frame(spark, []), keys).count() == 0
    assert Q.bucket_diff(a, a.select("b", "a", "id")).count() == 0  # columns go by name


def test_reconcile_without_keys(spark):
    source = frame(spark, [(None, "x", 1.0), (None, "x", 1.0), (None, "y", None), (1, "a", 1.0), (2, "b", None)])
    mirror = frame(spark, [(None, "x", 1.0), (1, "a", 1.0), (2, "b", 2.0)])
    found = sorted((r.id or 0, r.status, tuple(r["columns"] or ()), (r.source or r.mirror).a) for r in Q.reconcile(source, mirror, "id").collect())
    assert found == [(0, "extra", (), "x"), (0, "missing", (), "x"), (0, "missing", (), "x"), (0, "missing", (), "y"), (2, "changed", ("b",), "b")]


def test_reconcile_reads_each_side_once(sides):
    a, b = sides
    found = Q.reconcile(a, b.dropDuplicates(["id"]), "id")
    assert {(r.id, r.status) for r in found.collect()} == {(17, "missing"), (4711, "changed")}
    assert total(found, "Scan parquet", "numOutputRows") == a.count() + b.count()
