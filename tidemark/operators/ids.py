"""Row ids for trips, which come without one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import materialize

# monotonically_increasing_id() keeps the row position within a partition in its low 33 bits.
_POSITION_BITS = 33


def assign_ids(df: DataFrame, mode: str = "fast", keys: list[str] | None = None, name: str = "trip_id") -> DataFrame:
    """Adds a long id.

    ``fast``   unique, costs nothing; it is fixed by writing the rows, as another split of the files gives others.
    ``hash``   fingerprint of the row's content, whatever the order of columns: the same every time, but equal rows
               share it, and among very many rows some others may. Not an identity.
    ``dense``  0, 1, 2, ... in the order of ``keys``: stable, costs a range shuffle and one write.
    """
    if mode == "fast":
        return df.withColumn(name, F.monotonically_increasing_id())
    if mode == "hash":
        return df.withColumn(name, fingerprint(df))
    if mode == "dense":
        return numbered(df, keys or df.columns, name)
    raise ValueError("mode must be 'fast', 'hash' or 'dense'")


def fingerprint(df: DataFrame) -> Column:
    """xxhash64 of all columns in order of name; a missing value counts, so that values cannot trade places."""
    parts = []
    for column in sorted(df.columns):
        parts += [F.col(column).isNull(), F.col(column)]
    return F.xxhash64(*parts)


def numbered(df: DataFrame, keys: list[str] | None, name: str = "trip_id", first: Callable[[int], int] = lambda rows: 0) -> DataFrame:
    """Adds ids without gaps, in the order of ``keys``, or as the rows come when there are none.

    ``first`` says where ids begin, given the number of rows. The rows are written once, in order, so their positions
    are data and cannot change when a lost task is run again. Row content and input position break ties, which also
    spreads rows that share one key over several partitions.
    """
    columns = df.columns
    rows = df
    if keys:
        order = [*keys, "_content", "_input"]
        rows = (df.withColumn("_content", F.xxhash64(*columns)).withColumn("_input", F.monotonically_increasing_id())
                .repartitionByRange(*order).sortWithinPartitions(*order))
    placed = rows.withColumn("_at", F.monotonically_increasing_id()).select(
        *columns, F.shiftright("_at", _POSITION_BITS).alias("_part"),
        F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_pos"))
    stored = materialize(placed, "ids")
    # One row per partition, so this window and the join stay small however many rows there are. Spark estimates them from
    # the stored rows, and would shuffle all of these by the few numbers of their partitions.
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    begin = first(stored.count())  # from the files' footers
    return stored.join(F.broadcast(starts), "_part").select(*columns, (F.col("_start") + F.col("_pos") + F.lit(begin)).alias(name))
