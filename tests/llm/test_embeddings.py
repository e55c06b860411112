import math

import numpy as np
import pytest
from frames import result
from pyspark.sql import functions as F, types as T

from tidemark.llm import embeddings

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType())])


def near(rng, centre, spread):
    v = centre + spread * rng.standard_normal(len(centre))
    return (v / np.linalg.norm(v) * rng.uniform(0.5, 2)).astype(np.float32).tolist()


def vectors(seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for group in range(25):
        centre = rng.standard_normal(64)
        centre /= np.linalg.norm(centre)
        for _ in range(rng.integers(1, 8)):
            rows.append((near(rng, centre, rng.choice([0.01, 0.03, 0.045, 0.06])), group % 3))
    rows += [rows[0], rows[0], rows[5]]
    rows += [([0.0] * 64, 1), (None, 1), ([float("nan")] + [1.0] * 63, 1), ([float("inf")] + [1.0] * 63, 2), ([None] + [1.0] * 63, 1),
             (rows[0][0], None), ([1.0, 2.0], 1), ([1.0, 2.1], 1), ([1.0, 2.0], 2), ([3.0], 0), ([4.0], 0), ([-4.0], 0), ([], 0)]
    return [(i, v, label) for i, (v, label) in enumerate(rows)]


def slow(rows, threshold=0.93):
    def good(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    usable = [(i, np.array(v, np.float64), label) for i, v, label in rows if good(v, label)]
    links = {i: set() for i, _, _ in rows}
    for i, v, a in usable:
        for j, w, b in usable:
            if i < j and a == b and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= threshold:
                links[i].add(j)
                links[j].add(i)
    component = {i: i for i in links}
    changed = True
    while changed:
        changed = False
        for i, own in links.items():
            for j in own:
                if component[j] < component[i]:
                    component[i], changed = component[j], True
    return {(i, len(links[i]), component[i], component[i] == i) for i in links}


@pytest.mark.parametrize("seed, chunk, cell, sample", [(1, 2048, 128, 16_384), (2, 3, 2, 16_384), (3, 2048, 3, 40), (4, 2048, 2, 0)])
def test_equals_brute_force(spark, monkeypatch, seed, chunk, cell, sample):
    rows = vectors(seed)
    monkeypatch.setattr(embeddings.candidates, "__defaults__", (chunk,))
    monkeypatch.setattr(embeddings.trees, "__defaults__", (sample, cell))
    found = embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert {tuple(r) for r in found.collect()} == slow(rows)
    assert sum(n for _, n, _, _ in slow(rows)) > 40


def test_cells_and_visits():
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.standard_normal((400, 5)), np.ones((30, 5)), rng.integers(0, 2, (70, 5))])
    tree = embeddings.fitted(points[::3], 20)
    home = embeddings.homes(tree, points)
    assert 10 < len(set(home)) <= 20 and max(home) < embeddings._end(tree)
    for reach in (0.0, 0.4, 1.5):
        met = {(leaf, row) for leaf, rows in embeddings.visits(tree, points, reach, home) for row in rows.tolist()}
        assert {(leaf, row) for leaf, row in met if home[row] == leaf} == {(h, i) for i, h in enumerate(home.tolist())}
        near = np.argwhere(((points[:, None] - points[None]) ** 2).sum(axis=2) <= reach * reach)
        assert all(home[a] == home[b] or (max(home[a], home[b]), a if home[a] < home[b] else b) in met for a, b in near.tolist())
        assert all(home[row] <= leaf for leaf, row in met)
    assert embeddings.fitted(np.ones((50, 3)), 8) == 0 and embeddings.fitted(np.zeros((0, 3)), 8) == 0


def test_comparisons_per_pair(spark):
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(rng.standard_normal((10_000, 64)).astype(np.float32))]
    frame = spark.createDataFrame(rows, "id long, vector array<float>, label long").repartition(8)
    for cell, most in ((96, 2), (embeddings.CELL, 3.6)):  # two coordinates as a grid made 4.2
        placed = embeddings.placed(frame, 0.93, embeddings.trees(frame, cell=cell)).groupBy("block", "cell") \
            .agg(F.count_if("home").alias("h"), F.count_if(~F.col("home")).alias("v"))
        compared = placed.agg(F.sum(F.expr("h * (h - 1) / 2 + h * v"))).head()[0]
        assert compared < most * len(rows) * (len(rows) - 1) / 2


def test_rotation_keeps_distances():
    q = embeddings.rotation(64)
    assert np.allclose(q @ q.T, np.eye(64)) and np.array_equal(q, embeddings.rotation(64))
    assert [b.stop - b.start for b in embeddings.blocks_of(64)] == [8] * 8
    assert embeddings.blocks_of(3) == [slice(0, 3)]


def test_frames(spark):
    rows = vectors()[:20]
    repeated = spark.createDataFrame([*rows, rows[3], (None, rows[0][1], 1)], SCHEMA)
    found = embeddings.near_duplicates(repeated).collect()
    assert len(found) == 22
    assert {tuple(r) for r in found if r.vec_id is not None} == slow(rows)
    assert [tuple(r) for r in found if r.vec_id is None] == [(None, 0, None, True)]
    wide = repeated.selectExpr("*", "1 AS id", "2 AS LABEL", "3 AS vector", "4 AS n_links", "5 AS kept", "6 AS block")
    assert result(embeddings.near_duplicates(wide)) == result(embeddings.near_duplicates(repeated))
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
