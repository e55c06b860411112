"""Checks of a mirror against its source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


class MismatchError(AssertionError):
    """A mirror does not agree with its source."""


def assert_counts(source: DataFrame, mirror: DataFrame, tolerance: int = 0) -> tuple[int, int]:
    """Both row counts; raises when they differ by more than the tolerance."""
    left, right = source.count(), mirror.count()
    if abs(left - right) > tolerance:
        raise MismatchError(f"source has {left} rows, mirror has {right}")
    return left, right


def reconcile(source: DataFrame, mirror: DataFrame, key: str) -> DataFrame:
    """One row per key that differs: missing in the mirror, extra in it, or changed, with both sides.

    Rows without a key are missing or extra. They take part in the same join under a tag of their side and content, so
    that none finds a partner and they do not all meet in one task; rows with a key have no tag.
    """
    names = [c for c in source.columns if c != key]

    def side(df: DataFrame, name: str) -> DataFrame:
        tag = F.when(F.col(key).isNull(), F.concat(F.lit(name), F.xxhash64(*names).cast("string")))
        return df.select(F.col(key).alias(f"_{name}"), tag.alias(f"_{name}_tag"), F.struct(*names).alias(name))

    left, right = side(source, "source"), side(mirror, "mirror")
    alike = F.col("_source").eqNullSafe(F.col("_mirror")) & F.col("_source_tag").eqNullSafe(F.col("_mirror_tag"))
    both = left.join(right, alike, "full_outer").withColumn(key, F.coalesce("_source", "_mirror"))
    changed = F.array_compact(F.array(*[
        F.when(~F.col(f"source.{c}").eqNullSafe(F.col(f"mirror.{c}")), F.lit(c)) for c in names]))
    status = (F.when(F.col("mirror").isNull(), "missing")
              .when(F.col("source").isNull(), "extra")
              .when(~F.col("source").eqNullSafe(F.col("mirror")), "changed"))
    return (both.withColumn("status", status).filter(F.col("status").isNotNull())
            .select(key, "status",
                    F.when(F.col("status") == "changed", changed).alias("columns"),
                    "source", "mirror"))


def row_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that do not occur equally often on both sides, with both counts.

    One aggregation over the union, combined map-side, in place of two bag differences.
    """
    names = a.columns
    sides = (a.select(*names, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
             .unionByName(b.select(*names, F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    counted = sides.groupBy(*names).agg(F.sum("_a").alias("in_a"), F.sum("_b").alias("in_b"))
    return counted.filter(F.col("in_a") != F.col("in_b"))


def bucket_sums(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Per bucket of the keys' hash: rows, and sums of two hashes of each row, in halves that do not overflow.

    The sums do not depend on the order of rows, and rows that occur twice count twice. A task sends one row per bucket.
    """
    parts = []
    for column in sorted(df.columns):
        parts += [F.col(column).isNull(), F.col(column)]  # a hash skips NULL, so that it could move between columns
    hashes = [F.xxhash64(F.lit(seed), *parts) for seed in (1, 2)]
    halves = [half for h in hashes for half in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    return df.groupBy(_bucket(keys, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(half).alias(f"sum_{i}") for i, half in enumerate(halves)])


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def differing_buckets(a: DataFrame, b: DataFrame, keys: list[str], buckets: int = 1024) -> DataFrame:
    """(bucket, rows_a, rows_b) of the buckets whose rows are not the same on both sides; at most ``buckets`` rows."""
    left, right = (bucket_sums(df.select(*a.columns), keys, buckets) for df in (a, b))
    names = [c for c in left.columns if c != "bucket"]
    both = left.select("bucket", F.struct(*names).alias("a")).join(
        right.select("bucket", F.struct(*names).alias("b")), "bucket", "full_outer")
    zero = F.lit(0).cast("bigint")
    return both.filter(~F.col("a").eqNullSafe(F.col("b"))).select(
        "bucket", F.coalesce("a.rows", zero).alias("rows_a"), F.coalesce("b.rows", zero).alias("rows_b"))


def bucket_diff(a: DataFrame, b: DataFrame, keys: list[str] | None = None, buckets: int = 1024) -> DataFrame:
    """The rows of :func:`row_diff`, found by comparing sums first: buckets that agree are read but not shuffled.

    For two large tables that differ little. ``keys`` say which rows belong together, by default all columns; with the
    key of a table, a changed row is in one bucket on both sides. Different rows with equal sums would go unseen, which
    for two 64-bit hashes does not happen by chance. The numbers of the differing buckets are found at once, by a job.
    """
    keys = keys or a.columns
    wanted = [row.bucket for row in differing_buckets(a, b, keys, buckets).collect()]
    found = _bucket(keys, buckets).isin(wanted) if wanted else F.lit(False)
    return row_diff(a.filter(found), b.select(*a.columns).filter(found))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two frames hold the same rows, in any order."""
    return row_diff(a, b).isEmpty()


def layer_counts(**layers: DataFrame) -> DataFrame:
    """Rows per layer, in one job."""
    counts = [df.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("rows")) for name, df in layers.items()]
    return reduce(DataFrame.unionByName, counts)


def describe(df: DataFrame) -> DataFrame:
    """Columns of a frame as rows."""
    return df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)],
        "position int, column string, type string, nullable boolean")


def first_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """Spot check: the n rows with the smallest key."""
    return df.orderBy(key).limit(n)
