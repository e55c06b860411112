import math

import numpy as np
import pytest

from frames import CLASHING
from tidemark.llm import whitening


def frame(spark, rows, extra=()):
    names = ["vec_id bigint", "embedding array<float>", *[f"{c} bigint" for c in extra]]
    return spark.createDataFrame([(*r, *range(len(extra))) for r in rows], ", ".join(names))


def by_hand(rows, components=16):
    """n, sums, values and vectors of the covariance of the distinct x, from numpy's own decomposition."""
    x = {i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for i, v in rows}
    fit = np.array(sorted(set(map(tuple, x.values()))))
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True))
    return x, fit, values[::-1][:components], vectors[:, ::-1][:, :components]


def check(got, rows, components=16):
    x, fit, values, vectors = by_hand(rows, components)
    n, sums = len(fit), fit.sum(axis=0)
    assert len(got) == len(rows) * len(values)
    trace = np.trace(np.cov(fit.T, bias=True))
    signs = {}
    for r in got:
        k = r.component - 1
        apart = [n * a - int(s) for a, s in zip(x[r.vec_id], sums)]
        assert r.n == n and r.deviation == sum(a * a for a in apart)
        assert abs(r.explained - values[k] / trace) <= 1e-9 * values[k] / trace and r.identity_error < 1e-8
        expected = np.dot(np.array(apart) / n, vectors[:, k]) / math.sqrt(values[k])
        if abs(expected) > 1e-3:
            assert signs.setdefault(k, np.sign(expected * r.whitened)) == np.sign(expected * r.whitened)
        assert abs(abs(expected) - abs(r.whitened)) < 1e-7


def gaussian(seed, n, size):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, size)) * np.linspace(3, 0.3, size)).tolist()


def test_rank_one_updates():
    rng = np.random.default_rng(5)
    for size in (1, 2, 9, 40):
        held = np.zeros((size, size))
        values, vectors = np.zeros(size), np.eye(size)
        for step in range(3 * size):
            direction = rng.standard_normal(size) * 10.0 ** rng.integers(-3, 4)
            if step % 3 == 0:
                direction[rng.random(size) < 0.5] = 0  # some directions are left alone
            held += 0.7 * np.outer(direction, direction)
            values, vectors = whitening.raised(values, vectors, direction, 0.7)
        scale = np.abs(held).max()
        assert np.abs(vectors @ np.diag(values) @ vectors.T - held).max() < 1e-12 * scale * size
        assert np.abs(vectors.T @ vectors - np.eye(size)).max() < 1e-12 * size


def test_equal_eigenvalues_and_no_change():
    values, vectors = whitening.raised(np.ones(6), np.eye(6), np.ones(6), 2.0)
    assert np.allclose(values, [1] * 5 + [13]) and np.allclose(vectors @ np.diag(values) @ vectors.T, np.eye(6) + 2)
    same, _ = whitening.raised(values, vectors, np.zeros(6), 2.0)
    assert (same == values).all()


def test_combined_spectra():
    data = np.array(gaussian(2, 300, 12)) + 5
    parts = [whitening.Spectrum(12) for _ in range(3)]
    for i, v in enumerate(data):
        parts[i * i % 3].add(v)
    for part in parts[1:]:
        parts[0].combine(part)
    scatter = np.cov(data.T, bias=True) * len(data)
    assert parts[0].n == 300 and np.allclose(parts[0].mean, data.mean(axis=0))
    assert np.allclose(parts[0].values, np.linalg.eigvalsh(scatter), rtol=1e-9)


@pytest.mark.parametrize("size, n", [(64, 700), (3, 50)])
def test_equals_numpy(spark, size, n):
    rows = list(enumerate(gaussian(1, n, size)))
    rows += [(n + i, v) for i, v in rows[:20]]  # copies count once
    check(whitening.whiten(frame(spark, rows).repartition(40)).collect(), rows)


def test_unusable_vectors_and_sizes(spark):
    wide, narrow = list(enumerate(gaussian(1, 60, 8))), [(1000 + i, v) for i, v in enumerate(gaussian(2, 40, 4))]
    bad = [(1, None), (2, []), (3, [1.0, None, *[0.0] * 6]), (4, [math.nan] * 8), (5, [math.inf] * 8), (6, [1e30] * 8)]
    table = frame(spark, wide + narrow + bad, [c for c in CLASHING if c not in ("id",)] + ["id", "x", "component", "n"])
    got = whitening.whiten(table).collect()
    check([r for r in got if r.vec_id < 1000], wide)
    check([r for r in got if r.vec_id >= 1000], narrow)


def test_degenerate_tables(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(30)] + [(None, [1.0, 2.0, 0.0])]
    got = whitening.whiten(frame(spark, line + line[:1])).collect()
    assert len(got) == 32 and {r.component for r in got} == {1} and sum(r.vec_id is None for r in got) == 1
    assert all(abs(r.explained - 1) < 1e-9 for r in got)


def test_exact_beyond_longs(spark):
    rows = [(i, [float(i % 7) * 2.0 ** 43, 1.0 * i]) for i in range(14)]
    got = whitening.whiten(frame(spark, rows)).collect()
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    for r in got:
        value = sum((len(rows) * a - s) ** 2 for a, s in zip(x[r.vec_id], sums))
        assert r.deviation == (value if value < 1 << 63 else None)
