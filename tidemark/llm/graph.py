"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a and b, bigint): component is the smallest node reached.

    Alternates two steps until nothing changes: each node links its larger neighbours, then its smaller ones, to
    the smallest node it sees. Chains shorten by halves, so the number of rounds grows with the logarithm of the
    longest chain. Edges never get more than at the start; each round is written to the shared folder. Loops and
    repeated edges do no harm, NULL ends are dropped.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")) \
        .filter("a is not null and b is not null and a <> b")
    pairs = stored(pairs.distinct(), "edges")
    state = _state(pairs)
    while state[0]:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        wide = pairs.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u") \
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = pairs.join(least, "u").select("u", F.col("m").alias("v"))
        wide = wide.union(own).filter("u <> v").distinct()
        low = wide.groupBy("u").agg(F.min("v").alias("m"))
        near = wide.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(low.select("u", F.col("m").alias("v")))
        pairs = stored(near.distinct(), "edges")
        before, state = state, _state(pairs)
        if state == before:
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .union(pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _state(pairs: DataFrame) -> tuple:
    """Number of edges and two sums that tell one edge set from another."""
    row = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                    F.sum(F.hash("v", "u").cast("decimal(38,0)"))).head()
    return tuple(row)
