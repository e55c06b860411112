"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors with cosine c are sqrt(2 - 2c) apart. Vectors are rotated, which spreads them evenly over coordinates, and
cut into blocks. The squared distance of a pair is the sum over blocks, so at least one block holds no more than its
share of the greatest allowed one. Each block is range-joined on its own under that share: a k-d tree over all
coordinates of the block makes cells, a vector is at home in one cell and visits those others whose box lies within its
range, as a partner may live there. Pairs within range in some block are candidates; all are verified by the cosine.

The splits of the trees are medians of a bounded sample; where they lie decides how much is compared, never what is
found. Crowded cells are cut into chunks, and chunks meet in pairs, so no task holds more than two chunks.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, map_batches, pick, ship, stored
from tidemark.llm.graph import components

#: Coordinates in a block, and rows of the largest label that a cell has, about. Smaller cells mean fewer comparisons and
#: more visits, which cost a row each; this is where both cost about the same.
BLOCK, CELL = 8, 512
#: Vectors that the trees are fitted to at most: those of least id hash. A cell has at least eight of them.
SAMPLE = 16_384
#: Rows of a cell that a task compares with as many others.
CHUNK = 2048
_SLACK = 1e-9
# Candidates are found with short floats; what these may be off by is allowed for, the cosine decides.
_SHORT_SLACK = 1e-5


def rotation(size: int) -> np.ndarray:
    """A fixed orthogonal matrix: that of the QR factors of normal deviates drawn with ``size`` as seed."""
    q, r = np.linalg.qr(np.random.default_rng(size).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def blocks_of(size: int) -> list[slice]:
    count = max(1, size // BLOCK)
    edges = [size * i // count for i in range(count + 1)]
    return [slice(a, b) for a, b in itertools.pairwise(edges)]


def fitted(points: np.ndarray, leaves: int, first: int = 0):
    """A k-d tree over ``points``: (axis, value, left, right, first and last + 1 leaf), or the number of a leaf.

    Nodes are split at the median of their widest axis; points equal to it go right.
    """
    if leaves < 2 or len(points) < 2:
        return first
    axis = int(np.argmax(points.var(axis=0)))
    value = float(np.median(points[:, axis]))
    side = points[:, axis] >= value
    if side.all():
        return first
    half = leaves // 2
    left = fitted(points[~side], half, first)
    middle = _end(left)
    right = fitted(points[side], leaves - half, middle)
    return axis, value, left, right, first, _end(right)


def _end(tree) -> int:
    return tree + 1 if isinstance(tree, int) else tree[5]


def homes(tree, points: np.ndarray) -> np.ndarray:
    """The leaf that each point falls in."""
    out = np.zeros(len(points), np.int64)
    todo = [(tree, np.arange(len(points)))]
    while todo:
        node, rows = todo.pop()
        if isinstance(node, int):
            out[rows] = node
        elif len(rows):
            side = points[rows, node[0]] >= node[1]
            todo += [(node[2], rows[~side]), (node[3], rows[side])]
    return out


def visits(tree, points: np.ndarray, reach: float, home: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, rows): the points within ``reach`` of the leaf's box that are at home there or in an earlier leaf.

    Of two points in different cells, the one of the earlier cell visits the other.
    """
    todo = [(tree, np.arange(len(points)), np.zeros(points.shape), np.zeros(len(points)))]
    while todo:
        node, rows, beyond, far = todo.pop()
        keep = home[rows] < _end(node)
        rows, beyond, far = rows[keep], beyond[keep], far[keep]
        if not len(rows):
            continue
        if isinstance(node, int):
            yield node, rows
            continue
        axis, gap = node[0], points[rows, node[0]] - node[1]
        for child, crosses in ((node[2], gap >= 0), (node[3], gap < 0)):
            # Distance to a box is that to its planes that lie between; a nearer plane of an axis gives way to a farther.
            new = np.where(crosses, far - beyond[:, axis] ** 2 + gap ** 2, far)
            near = new <= reach * reach
            left = beyond[near].copy()
            left[crosses[near], axis] = gap[near][crosses[near]]
            todo.append((child, rows[near], left, new[near]))


def usable(vector, label):
    """Condition: a label, and a vector of finite components that are not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return label.isNotNull() & vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def rotated(vectors: list, size: int) -> np.ndarray:
    """Unit vectors in the rotated space; scaled by their largest entry first, so that no square overflows."""
    matrix = np.array(vectors, dtype=np.float64)
    matrix /= np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True) @ rotation(size)


def trees(vectors: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> dict[int, list]:
    """A tree per block for each size of vector, fitted to a bounded sample, with cells for the largest label."""
    sizes = vectors.groupBy("label", F.size("vector").alias("size")).agg(F.count("*").alias("n")) \
        .groupBy("size").agg(F.max("n").alias("n")).collect()  # a row per size of vector
    drawn = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").collect()
    found = {}
    for size, most in sizes:
        points = [r.vector for r in drawn if len(r.vector) == size]
        matrix = rotated(points, size) if points else np.zeros((0, size))
        leaves = max(1, min(most // cell, len(points) // 8))
        found[size] = [fitted(matrix[:, cut], leaves) for cut in blocks_of(size)]
    return found


def placed(vectors: DataFrame, threshold: float, known: dict[int, list]) -> DataFrame:
    """Rows (label, size, block, cell, id, home, at) of every vector for its own and its visited cells."""
    budget = 2 - 2 * threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels = column(batch, "id").to_numpy(), column(batch, "label").to_numpy(zero_copy_only=False)
            vectors = column(batch, "vector").to_pylist()
            sizes = np.array([len(v) for v in vectors])
            for size in np.unique(sizes).tolist():
                chosen = np.flatnonzero(sizes == size)
                matrix = rotated([vectors[i] for i in chosen], size)
                cuts = blocks_of(size)
                reach = math.sqrt(budget / len(cuts)) + _SLACK
                for number, cut in enumerate(cuts):
                    part = np.ascontiguousarray(matrix[:, cut])
                    short, home = part.astype(np.float32), homes(known[size][number], part)
                    met = [(leaf, rows) for leaf, rows in visits(known[size][number], part, reach, home)]
                    rows = np.concatenate([rows for _, rows in met])
                    cells = np.repeat([leaf for leaf, _ in met], [len(rows) for _, rows in met])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(labels[chosen][rows], pa.int64()), pa.array(np.full(len(rows), size), pa.int32()),
                         pa.array(np.full(len(rows), number), pa.int32()), pa.array(cells, pa.int64()),
                         pa.array(ids[chosen][rows], pa.int64()), pa.array(home[rows] == cells, pa.bool_()),
                         pa.array([p.tobytes() for p in short[rows]], pa.binary())],
                        names=["label", "size", "block", "cell", "id", "home", "at"])

    return map_batches(vectors, run, "label bigint, size int, block int, cell bigint, id bigint, home boolean, at binary")


def candidates(vectors: DataFrame, threshold: float, chunk: int = CHUNK) -> DataFrame:
    """Pairs (a, b), a < b, of vectors (id, label, vector) within range in some block. Loses no pair above ``threshold``."""
    budget = 2 - 2 * threshold
    rows = stored(placed(vectors, threshold, trees(vectors)), "cells")
    key = ["label", "size", "block", "cell"]
    counts = rows.groupBy(*key).agg(F.count("*").alias("rows"), F.sum(F.col("home").cast("long")).alias("homes")) \
        .filter("homes > 0 and rows > 1").withColumn("chunks", F.ceil(F.col("rows") / chunk)).drop("rows", "homes")
    own = F.pmod(F.xxhash64("id", "home"), F.col("chunks"))
    split = rows.join(counts, key).withColumn("own", own) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    task = split.select(*key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                        (F.col("own") > F.col("other")).alias("second"), "id", "home", "at")

    def compare(table: pa.Table) -> pa.Table:
        size = table.column("size")[0].as_py()
        reach = budget / len(blocks_of(size)) + _SHORT_SLACK
        ids = table.column("id").to_numpy()
        home = table.column("home").to_numpy()
        points = np.frombuffer(b"".join(table.column("at").to_pylist()), dtype=np.float32).astype(np.float64).reshape(len(ids), -1)
        second = table.column("second").to_numpy()
        one = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        pairs = []
        sides = [(home, np.ones(len(ids), bool))] if one else [(home & ~second, second), (home & second, ~home & ~second)]
        for left, right in sides:
            x, y = np.flatnonzero(left), np.flatnonzero(right)
            if not len(x) or not len(y):
                continue
            far = (points[x] ** 2).sum(1)[:, None] + (points[y] ** 2).sum(1)[None, :] - 2 * points[x] @ points[y].T
            p, q = np.nonzero(far <= reach)
            pairs.append(np.stack([ids[x[p]], ids[y[q]]], axis=1))
        found = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
        found.sort(axis=1)
        found = np.unique(found[found[:, 0] < found[:, 1]], axis=0)
        return pa.table({"a": pa.array(found[:, 0], pa.int64()), "b": pa.array(found[:, 1], pa.int64())})

    ship(vectors.sparkSession)
    return task.groupBy(*key, "i", "j").applyInArrow(compare, "a bigint, b bigint").distinct()


def cosine(x, y):
    """In double precision; both vectors have the same size and are not zero."""
    def total(terms):
        return F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)

    def squares(v):
        return total(F.transform(v, lambda a: a.cast("double") * a.cast("double")))

    dot = total(F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double")))
    return dot / (F.sqrt(squares(x)) * F.sqrt(squares(y)))


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, vec_id: str = "vec_id", vector: str = "embedding",
                    label: str = "label") -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id and kept.

    Vectors of one label link when their cosine is at least ``threshold``. n_links counts the other vectors linked,
    component_id is the smallest vec_id reached over links, kept says whether that is the vector's own. Vectors that
    are NULL, zero or hold NULL or non-finite components, vectors without label, and rows without id link with
    nothing and are kept; vectors of different sizes do not link. Equal vectors of a label are one node of the join,
    so copies add no pairs. Repeated rows come back as often as given and count once.
    """
    all_rows = pick(vectors, vec_id=vec_id, vector=vector, label=label) \
        .select(F.col("vec_id").cast("long").alias("vec_id"), "vector", F.col("label").cast("long").alias("label"))
    good = all_rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"), F.col("label"))).distinct()
    nodes = good.groupBy("label", "vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    nodes = stored(nodes, "vectors")
    pairs = candidates(nodes.select("id", "label", "vector"), threshold)
    one, two = (nodes.select(F.col("id").alias(n), F.col("label").alias(f"l{n}"), F.col("vector").alias(f"v{n}"),
                             F.col("copies").alias(f"c{n}")) for n in "ab")
    links = pairs.join(one, "a").join(two, "b").filter((F.col("la") == F.col("lb")) & (cosine(F.col("va"), F.col("vb")) >= threshold)) \
        .select("a", "b", "ca", "cb")
    links = stored(links, "links")
    degrees = links.select(F.col("a").alias("id"), F.col("cb").alias("n")) \
        .union(links.select(F.col("b").alias("id"), F.col("ca").alias("n"))).groupBy("id").agg(F.sum("n").alias("n"))
    groups = components(links.select("a", "b")).withColumnRenamed("node", "id")
    named = nodes.join(degrees, "id", "left").join(groups, "id", "left").select(
        "label", "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    linked = good.join(named, ["label", "vector"]).groupBy("vec_id") \
        .agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    return all_rows.select("vec_id").join(linked, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"))
