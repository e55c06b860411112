"""Whitening of embeddings by an incremental eigendecomposition.

Every task keeps the mean of the vectors it has seen and the spectrum (eigenvalues and eigenvectors) of their scatter
about it. A vector changes the scatter by a rank-one term along its distance from the mean, which changes the spectrum by
the roots of a secular equation; directions that the term does not touch, and equal eigenvalues, are deflated first.
Spectra of tasks are combined in rounds, each by one rank-one update per eigenvector of the other and one for the
distance of the means. A last pass over the vectors takes the covariance in the basis found (Rayleigh-Ritz), which
corrects what rounding has added up.

Vectors are whole numbers here, so their count, sums and distances from the mean are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, map_batches, pick, ship, stored

#: A component c becomes floor(STEPS * c) + SHIFT.
STEPS, SHIFT = 64, 1_000_000
#: Spectra that are combined in one task.
FAN = 16
#: Guesses at a root at most, and when the last two are close enough, as guesses get twice the digits each time.
_GUESSES, _CLOSE = 60, 1e-9
#: Entries beyond this size have no exact floor.
_BOUND = float(1 << 46)
#: Eigenvalues below this share of the trace are zero but for rounding.
_NOTHING = 1e-12
_EPS = np.finfo(float).eps


def secular_roots(poles: np.ndarray, z: np.ndarray, rho: float) -> np.ndarray:
    """distance[i, j] = root j - pole i of 1 + rho * sum(z^2 / (poles - x)); root j lies between poles j and j + 1.

    Distances are kept and not the roots, as differences to the near pole would lose all their digits. ``poles`` rise,
    no two are equal, no z is zero, and the squares of z add up to one. The two poles next to a root make a curve that
    has the function's value and slope and the weight of the nearer pole; its root is the next guess. Where that leaves
    the interval known to hold the root, the interval is halved instead.
    """
    width = np.r_[poles[1:] - poles[:-1], 2 * rho]  # above the last root, a pole without weight
    weights = rho * z * z
    above = np.r_[weights[1:], 0.0]
    column = weights[:, None]
    gaps = poles[:, None] - poles[None, :]
    # Each root is measured from the nearer pole.
    near = 1 + (column / (gaps - width / 2)).sum(axis=0) >= 0
    gaps = np.where(near, gaps, gaps - width)
    low, high = np.where(near, 0.0, -width / 2), np.where(near, width / 2, 0.0)
    if not near[-1]:  # the last pole is the only one near the last root
        near[-1], gaps[:, -1], low[-1], high[-1] = True, gaps[:, -1] + width[-1], width[-1] / 2, width[-1]
    at, found = np.where(near, width / 2, -width / 2), False
    for _ in range(_GUESSES):
        terms = column / (gaps - at)
        value, slope = 1 + terms.sum(axis=0), (terms / (gaps - at)).sum(axis=0)
        low, high = np.where(value < 0, at, low), np.where(value < 0, high, at)
        one, two = np.where(near, -at, -width - at), np.where(near, width - at, -at)
        c = np.where(near, value - two * slope + width * weights / one ** 2, value - one * slope - width * above / two ** 2)
        a, b = (one + two) * value - one * two * slope, one * two * value
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = at + step
        new = np.where((new >= low) & (new <= high) & (new != 0), new, (low + high) / 2)
        new = np.where(found, at, new)
        found = np.abs(new - at) <= _CLOSE * np.abs(new)
        at = new
        if found.all():
            break
    return at - gaps


def raised(values: np.ndarray, vectors: np.ndarray, direction: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of vectors @ diag(values) @ vectors.T + rho * direction @ direction.T; values rise, rho is not negative."""
    z = vectors.T @ direction
    length = np.linalg.norm(z)
    rho = rho * length * length
    if not rho > 0:
        return values, vectors
    z = z / length
    tiny = 8 * _EPS * max(abs(values[-1]), rho)
    alive = rho * np.abs(z) > tiny
    vectors = vectors.copy()
    last = -1
    for i in np.flatnonzero(alive):
        # Of equal eigenvalues one takes the whole direction; a turn of the two eigenvectors sees to that.
        if last >= 0 and (values[i] - values[last]) * abs(z[i] * z[last]) <= tiny * (z[i] ** 2 + z[last] ** 2):
            r = np.hypot(z[last], z[i])
            c, s = z[i] / r, z[last] / r
            one, two = vectors[:, last].copy(), vectors[:, i].copy()
            vectors[:, last], vectors[:, i] = c * one - s * two, s * one + c * two
            # The values differ by no more than rounding, but stay with the turned vectors.
            values = values.copy()
            values[last], values[i] = (c * c * values[last] + s * s * values[i], s * s * values[last] + c * c * values[i])
            z[last], z[i] = 0.0, r
            alive[last] = False
        last = i
    at = np.flatnonzero(alive)
    at = at[np.argsort(values[at], kind="stable")]
    poles = values[at]
    if len(at) == 1:
        new = values.copy()
        new[at] += rho * z[at] ** 2
    else:
        weight = np.linalg.norm(z[at])
        with np.errstate(divide="ignore", invalid="ignore"):
            distance = secular_roots(poles, z[at] / weight, rho * weight * weight)
        # The direction for which these roots are exact: with it the new eigenvectors are orthogonal.
        gaps = poles[None, :] - poles[:, None]
        np.fill_diagonal(gaps, 1.0)
        fitted = np.sqrt(np.abs(np.prod(distance / gaps, axis=1))) * np.sign(z[at])
        turn = fitted[:, None] / -distance
        turn /= np.linalg.norm(turn, axis=0)
        vectors[:, at] = vectors[:, at] @ turn
        new = values.copy()
        new[at] = poles + np.diag(distance)
    order = np.argsort(new, kind="stable")
    return new[order], vectors[:, order]


class Spectrum:
    """Number and mean of vectors, and the eigenvalues and eigenvectors of their scatter about the mean."""

    def __init__(self, size: int, n: int = 0, mean=None, values=None, vectors=None):
        self.n = n
        self.mean = np.zeros(size) if mean is None else np.asarray(mean, float)
        self.values = np.zeros(size) if values is None else np.asarray(values, float)
        self.vectors = np.eye(size) if vectors is None else np.asarray(vectors, float).reshape(size, size)

    def add(self, vector: np.ndarray) -> None:
        apart = vector - self.mean
        self.values, self.vectors = raised(self.values, self.vectors, apart, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + apart / self.n

    def combine(self, other: Spectrum) -> None:
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T):
            self.values, self.vectors = raised(self.values, self.vectors, vector, max(value, 0.0))
        apart, n = other.mean - self.mean, self.n + other.n
        self.values, self.vectors = raised(self.values, self.vectors, apart, self.n * other.n / n)
        self.mean, self.n = self.mean + apart * (other.n / n), n

    def row(self) -> tuple:
        return self.n, self.mean.tolist(), self.values.tolist(), self.vectors.ravel().tolist()


_SPECTRUM = "n bigint, mean array<double>, values array<double>, vectors array<double>"
_KINDS = [pa.int64(), *[pa.list_(pa.float64())] * 3]
_NAMES = ["n", "mean", "values", "vectors"]


def matrix(batch, name: str, size: int) -> np.ndarray:
    """A column of lists of one size as a matrix."""
    values = column(batch, name)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), size)


def whole_numbers(rows: DataFrame) -> DataFrame:
    """Rows (id, x) of the usable ones of (id, vector)."""
    value = lambda c: c.cast("double") * F.lit(float(STEPS))
    good = F.forall("vector", lambda c: F.coalesce(~F.isnan(c) & (F.abs(value(c)) <= F.lit(_BOUND * STEPS)), F.lit(False)))
    return rows.filter(F.col("vector").isNotNull() & (F.size("vector") > 0)).filter(good) \
        .select("id", F.transform("vector", lambda c: F.floor(value(c)).cast("bigint") + F.lit(SHIFT).cast("bigint")).alias("x"))


def added(sent: DataFrame, name: str, kind: str) -> list:
    """The sums, place by place, of a column of equally long lists; one row per place comes to the driver."""
    places = sent.select(F.posexplode(name).alias("place", "value")) \
        .groupBy("place").agg(F.sum(F.col("value").cast(kind)).alias("value"))
    return [r.value for r in sorted(places.collect(), key=lambda r: r.place)]


def incremental_spectrum(distinct: DataFrame, size: int, centre: np.ndarray) -> Spectrum:
    """Spectrum of rows (x), less ``centre``: a pass of rank-one updates per task, then rounds of combining."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum(size)
        for batch in batches:
            for vector in matrix(batch, "x", size) - centre:
                own.add(vector)
        if own.n:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(own.row(), _KINDS)], names=_NAMES)

    def combine(table: pa.Table) -> pa.Table:
        parts = [Spectrum(size, r["n"], r["mean"], r["values"], r["vectors"]) for r in table.to_pylist()]
        whole = parts[0]
        for part in parts[1:]:
            whole.combine(part)
        return pa.table([pa.array([v], k) for v, k in zip(whole.row(), _KINDS)], names=_NAMES)

    parts = stored(map_batches(distinct.select("x"), run, _SPECTRUM), "spectra")
    count = parts.count()
    while count > 1:
        # Ids tell tasks apart but do not count from zero, so parts are dealt by hash: some groups have one part.
        tasks = -(-count // FAN)
        dealt = parts.withColumn("task", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(count)), F.lit(tasks)))
        parts = stored(dealt.groupBy("task").applyInArrow(lambda t: combine(t.drop_columns(["task"])), _SPECTRUM), "spectra")
        count = parts.count()
    return Spectrum(size, *parts.head())


def _refined(distinct: DataFrame, size: int, n: int, sums: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors of the covariance, from its projection on ``basis``."""
    basis = np.linalg.qr(basis)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((size, size))
        for batch in batches:
            seen = centred(matrix(batch, "x", size), n, sums)[1] @ basis
            held += seen.T @ seen
        yield pa.RecordBatch.from_arrays([pa.array([held.ravel().tolist()], pa.list_(pa.float64()))], names=["held"])

    held = np.array(added(map_batches(distinct.select("x"), run, "held array<double>"), "held", "double")).reshape(size, size)
    values, turn = np.linalg.eigh((held + held.T) / (2 * n))
    return values[::-1], (basis @ turn)[:, ::-1]


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n * x - sums as whole numbers, and x less the mean."""
    wide = n * int(np.abs(x).max(initial=0)) >= 1 << 62 or int(max(map(abs, sums), default=0)) >= 1 << 62
    apart = (x.astype(object) if wide else x) * n - (sums if wide else sums.astype(np.int64))
    return apart, apart.astype(float) / n


def deviation(apart: np.ndarray) -> list[int | None]:
    """Sums of squares, None beyond the range of a long."""
    most = int(np.abs(apart).max(initial=0))
    if most * most * max(apart.shape[1], 1) < 1 << 63:
        return (apart.astype(np.int64) ** 2).sum(axis=1).tolist()
    found = [sum(int(v) ** 2 for v in row) for row in apart]
    return [v if v < 1 << 63 else None for v in found]


def whiten(vectors: DataFrame, components: int = 16, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per usable row and leading component.

    Vectors c become x = floor(64 c) + 1000000. Components are the unit eigenvectors of the covariance of the distinct x,
    by falling eigenvalue e; ``whitened`` is x less the mean along one, over sqrt(e). n is the number of distinct x,
    ``deviation`` the sum over dimensions of (n x - their sum)^2, NULL beyond a long. ``explained`` is e over the trace,
    ``identity_error`` the largest absolute entry of the covariance of ``whitened`` less the identity.

    Rows whose vector is NULL, empty, or holds NULL or non-finite entries or such beyond 2^46 give nothing. Vectors of
    different sizes are different data, each size with a covariance of its own. Directions without variance (e below
    1e-12 of the trace) are no components, so equal vectors alone give no rows. Repeated rows, NULL ids and rows of one
    id come back as often as given; each distinct x counts once. Other columns play no part. An empty table gives none.
    """
    rows = whole_numbers(pick(vectors, id=vec_id, vector=vector))
    # One row per size of vector.
    sizes = sorted(r.size for r in rows.select(F.size("x").alias("size")).distinct().collect())
    shown = None
    for size in sizes:
        part = _whitened(rows.filter(F.size("x") == size), size, components)
        shown = part if shown is None else shown.unionByName(part)
    if shown is None:
        shown = rows.sparkSession.createDataFrame([], "id bigint, " + _OUT)
    return shown.withColumnRenamed("id", vec_id)


_OUT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _whitened(rows: DataFrame, size: int, components: int) -> DataFrame:
    distinct = stored(rows.select("x").distinct(), "distinct")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch, "x", size)
            sums = x.sum(axis=0).tolist()  # entries are below 2^53 and a batch has few rows
            yield pa.RecordBatch.from_arrays([pa.array([[len(x), *sums]], pa.list_(pa.int64()))], names=["sums"])

    n, *sums = (int(v) for v in added(map_batches(distinct, count, "sums array<bigint>"), "sums", "decimal(38,0)"))
    sums = np.array(sums, dtype=object)
    mean = np.array([s / n for s in sums], float)
    found = incremental_spectrum(distinct, size, np.floor(mean))
    values, basis = _refined(distinct, size, n, sums, found.vectors)
    trace = float(values.sum())
    most = int((values[:components] > _NOTHING * max(trace, 0.0)).sum()) if trace > 0 else 0
    values, basis = values[:most], basis[:, :most]
    scaled = basis / np.sqrt(values)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((most + 1, most))
        for batch in batches:
            white = centred(matrix(batch, "x", size), n, sums)[1] @ scaled
            held[:most] += white.T @ white
            held[most] += white.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([held.ravel().tolist()], pa.list_(pa.float64()))], names=["held"])

    error = 0.0
    if most:
        held = np.array(added(map_batches(distinct, spread, "held array<double>"), "held", "double")).reshape(most + 1, most) / n
        error = float(np.abs(held[:most] - np.outer(held[most], held[most]) - np.eye(most)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart, centre = centred(matrix(batch, "x", size), n, sums)
            white = centre @ scaled
            ids = column(batch, "id")
            back = np.repeat(np.arange(len(ids)), most)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(back)), pa.array(np.tile(np.arange(1, most + 1), len(ids)), pa.int32()),
                 pa.array(np.full(len(back), n), pa.int64()), pa.array(deviation(apart), pa.int64()).take(pa.array(back)),
                 pa.array(white.ravel(), pa.float64()), pa.array(np.tile(values / trace, len(ids)), pa.float64()),
                 pa.array(np.full(len(back), error), pa.float64())],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    if not most:
        return rows.select("id").filter(F.lit(False)).select("id", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in _OUT.split(", ")])
    return map_batches(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, {_OUT}")
