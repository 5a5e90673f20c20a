"""Whitened embeddings by incremental eigendecomposition.

Vectors are rounded to whole numbers, and equal ones taken once (the fit list).  Every partition
of the fit list keeps the eigendecomposition of its own scatter and brings it up to date vector by
vector: a vector, centred on the mean so far, is a rank-one update, whose eigenvalues are the roots
of a secular equation; entries without weight and equal eigenvalues are deflated first.  Spectra of
partitions are combined by as many rank-one updates as one of them has eigenpairs, and one for the
distance of the means, a few spectra in a task, round after round.  The result is the start of a
distributed Rayleigh-Ritz refinement: centred vectors are projected on the basis, the tasks add up
the products, and the small projected matrix gives the next basis, until it is diagonal.

Sums of coordinates are exact.  What comes to the driver is a matrix of the vectors' length.

Rows whose vector is null, empty, or holds a null, NaN or infinite entry are dropped.  Vectors of
different length are whitened apart.  Repeated rows and ids are rows of their own.  A component
without variance (fewer distinct vectors than dimensions) has whitened 0 and explained 0 and doesn't
count in identity_error; a deviation beyond 64 bits is null.  Entries so large that the rounded
ones leave 52 bits are refused with an error.  Without rows there is no result row.  Components
whose eigenvalues are equal are any orthonormal basis of their space.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from veristream.llm.common import materialize, shuffle_partitions

STEPS, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Spectra, or sums of products, that a task combines at a time.
FAN = 32
#: Rounds of refinement at most, and the largest entry beside the diagonal that is left, relative to the diagonal.
ROUNDS, REST = 4, 1e-11
#: Relative size below which an eigenvalue counts as none.
NONE = 1e-13
#: Rows of products formed together.
ROWS = 4096


@dataclass
class Spectrum:
    """Scatter of ``n`` vectors about ``mean``: basis @ diag(values) @ basis.T, values rising."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @classmethod
    def empty(cls, d: int) -> "Spectrum":
        return cls(0, np.zeros(d), np.zeros(d), np.eye(d))

    def add(self, x: np.ndarray) -> None:
        gap = x - self.mean
        self.n += 1
        self.mean = self.mean + gap / self.n
        if self.n > 1:
            self.update(gap, (self.n - 1) / self.n)

    def update(self, v: np.ndarray, weight: float) -> None:
        """Scatter plus weight * v v'."""
        self.values, self.basis = rank_one(self.values, self.basis, v, weight)

    def merge(self, other: "Spectrum") -> None:
        if not other.n:
            return
        n, gap = self.n + other.n, other.mean - self.mean
        for value, vector in zip(other.values, other.basis.T):
            if value > 0:
                self.update(vector, float(value))
        if self.n:
            self.update(gap, self.n * other.n / n)
        self.mean = self.mean + gap * (other.n / n)
        self.n = n


def rank_one(values: np.ndarray, basis: np.ndarray, v: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of basis diag(values) basis' + weight v v', for rising values and weight > 0."""
    z = basis.T @ v
    size = float(z @ z)
    if not size or not weight:
        return values, basis
    rho, z = weight * size, z / np.sqrt(size)
    tiny = 8 * np.finfo(float).eps * max(abs(values[-1]), abs(values[0]), rho)
    # Equal values: a reflection moves the whole weight of a run to its last entry.
    close = np.diff(values) <= tiny
    if close.any():
        basis = basis.copy()
        edge = np.flatnonzero(~close) + 1
        for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(values)]):
            if b - a > 1 and np.abs(z[a : b - 1]).max() * rho > tiny:
                length = np.linalg.norm(z[a:b])
                h = z[a:b].copy()
                h[-1] += np.copysign(length, h[-1])
                h /= np.linalg.norm(h)
                basis[:, a:b] -= np.outer(2 * (basis[:, a:b] @ h), h)
                last = -np.copysign(length, z[b - 1])
                z[a:b] = 0
                z[b - 1] = last
    live = np.abs(z) * rho > tiny
    if not live.any():
        return values, basis
    d, w = values[live], z[live]
    rho, w = rho * float(w @ w), w / np.linalg.norm(w)
    origin, shift = secular(d, w * w, rho)
    gap = (d[:, None] - d[origin]) - shift  # d[i] - root[j], without cancelling
    # Weights for which the roots found are exact; with them the vectors are orthogonal.
    away = d[:, None] - d
    np.fill_diagonal(away, 1.0)
    ratio = gap / away
    weights = np.sqrt(np.abs(np.prod(ratio, axis=1) / rho))
    turn = np.copysign(weights, w)[:, None] / gap
    turn /= np.sqrt((turn * turn).sum(0))
    out_values, out_basis = values.copy(), basis.copy()
    out_values[live] = d[origin] + shift
    out_basis[:, live] = basis[:, live] @ turn
    order = np.argsort(out_values, kind="stable")
    return out_values[order], out_basis[:, order]


def secular(d: np.ndarray, weight: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(weight / (d - x)): each as the nearest pole's number and the distance from it.

    There is one root between neighbouring poles and one beyond the last.  A root is approached by
    the rational function that agrees with both halves of the sum, kept inside its bracket by halving.
    """
    k = len(d)
    at = np.arange(k)
    width = np.append(np.diff(d), rho)
    w = rho * weight
    middle = 1 + (w / (d - (d + width / 2)[:, None])).sum(1)
    right = (middle < 0) & (at < k - 1)  # the root is nearer to the upper pole
    origin = at + right
    pole = d - d[origin][:, None]
    low = np.where(right, -width / 2, 0.0)
    high = np.where(right, 0.0, np.where(middle < 0, width, width / 2))
    low = np.where((middle < 0) & ~right, width / 2, low)
    x = (low + high) / 2
    under = at[:, None] >= at  # poles not above the root
    upper = np.append(pole[at[:-1], at[1:]], 2 * rho + width[-1])
    lower = pole[at, at]
    todo = np.ones(k, bool)
    for _ in range(100):
        gap = pole - x[:, None]
        part = w / gap
        f = 1 + part.sum(1)
        todo &= np.abs(f) > 4 * np.finfo(float).eps * (1 + np.abs(part).sum(1))
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        todo &= high - low > 2 * np.finfo(float).eps * np.maximum(np.abs(low), np.abs(high))
        if not todo.any():
            break
        slope = part / gap
        below = np.where(under, slope, 0.0).sum(1)
        above = slope.sum(1) - below
        p, q = lower - x, upper - x
        a = (p + q) * f - p * q * (below + above)
        b = p * q * f
        c = f - p * below - q * above
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = x + step
        inside = (new > low) & (new < high)
        x = np.where(todo, np.where(inside, new, (low + high) / 2), x)
    return origin, x


def rounded(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``key``, the length ``d`` and the rounded vector as bytes of 64-bit numbers, without SHIFT."""

    def run(batches):
        for batch in batches:
            ids, sizes, out = [], [], []
            for i, v in zip(batch.column(0), batch.column(1).to_pylist()):
                if not v or None in v:
                    continue
                c = np.asarray(v, np.float64)
                if not np.isfinite(c).all():
                    continue
                x = np.floor(STEPS * c)
                if np.abs(x).max() >= 2.0**52:
                    raise ValueError("an entry is too large to be rounded exactly")
                ids.append(i.as_py())
                sizes.append(len(v))
                out.append(x.astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array(sizes, pa.int32()), pa.array(out, pa.binary())], names=[key, "d", "x"])

    kind = vectors.schema[key].dataType.simpleString()
    return vectors.select(F.col(key), F.col(column).cast("array<double>")).mapInArrow(run, f"`{key}` {kind}, d int, x binary")


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, d)


def _pack(parts: list[np.ndarray]) -> bytes:
    return np.concatenate([np.asarray(p, np.float64).ravel() for p in parts]).tobytes()


def _spectra(fit: DataFrame, d: int) -> DataFrame:
    """(part, n, state): the spectrum of each partition."""

    def run(batches):
        mine = Spectrum.empty(d)
        for batch in batches:
            for x in _matrix(batch.column("x"), d).astype(np.float64):
                mine.add(x)
        if mine.n:
            from pyspark import TaskContext

            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([mine.n], pa.int64()),
                 pa.array([_pack([mine.mean, mine.values, mine.basis])], pa.binary())], names=["part", "n", "state"],
            )

    # An update costs far more than reading its vector, so file splits would be too few tasks.
    return fit.repartition(shuffle_partitions(fit.sparkSession), "x").mapInArrow(run, "part long, n long, state binary")


def _unpack(n: int, state: bytes, d: int) -> Spectrum:
    flat = np.frombuffer(state, np.float64)
    return Spectrum(n, flat[:d], flat[d : 2 * d], flat[2 * d :].reshape(d, d))


def _combined(spectra: DataFrame, d: int) -> Spectrum:
    """Rounds of at most FAN spectra a task, in the order of the partitions."""

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        some = [_unpack(n, s, d) for n, s in zip(table.column("n").to_pylist(), table.column("state").to_pylist())]
        first = some[0]
        for other in some[1:]:
            first.merge(other)
        return pa.table({"part": pa.array([table.column("to")[0].as_py()], pa.int64()), "n": pa.array([first.n], pa.int64()),
                         "state": pa.array([_pack([first.mean, first.values, first.basis])], pa.binary())})

    spectra = materialize(spectra, "spectra")
    while spectra.count() > 1:
        grouped = spectra.withColumn("to", F.floor(F.col("part") / FAN)).groupBy("to")
        spectra = materialize(grouped.applyInArrow(merge, "part long, n long, state binary"), "spectra")
    row = spectra.first()
    return _unpack(row["n"], row["state"], d)


def _added(rows: DataFrame, size: int) -> np.ndarray:
    """The sum of the arrays of the partitions, in their order; rows are (part, state)."""

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        total = np.zeros(size)
        for s in table.column("state").to_pylist():
            total = total + np.frombuffer(s, np.float64)
        return pa.table({"part": pa.array([table.column("to")[0].as_py()], pa.int64()), "state": pa.array([total.tobytes()], pa.binary())})

    rows = materialize(rows, "products")
    while rows.count() > 1:
        rows = materialize(rows.withColumn("to", F.floor(F.col("part") / FAN)).groupBy("to").applyInArrow(add, "part long, state binary"), "products")
    return np.frombuffer(rows.first()["state"], np.float64)


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """x - total / n in double precision, from the whole numbers."""
    mean, rest = total // n, total % n
    return (x - mean).astype(np.float64) - rest / n


def _products(fit: DataFrame, d: int, n: int, total: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean, and mean of the products, of the centred fit list projected on the basis' columns."""
    k = basis.shape[1]

    def run(batches):
        from pyspark import TaskContext

        one, two, some = np.zeros(k), np.zeros((k, k)), False
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            for a in range(0, len(x), ROWS):
                y = centred(x[a : a + ROWS], n, total) @ basis
                one += y.sum(0)
                two += y.T @ y
                some = True
        if some:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([_pack([one, two])], pa.binary())], names=["part", "state"]
            )

    flat = _added(fit.mapInArrow(run, "part long, state binary"), k + k * k) / n
    return flat[:k], flat[k:].reshape(k, k)


@dataclass
class Whitening:
    """Fitted to the distinct vectors of one length."""

    n: int
    total: np.ndarray  # sums of the rounded entries, without SHIFT
    components: np.ndarray  # columns, by falling eigenvalue
    values: np.ndarray
    trace: float
    identity_error: float

    def scaled(self) -> np.ndarray:
        """Components over the root of their eigenvalue; those without variance are zero."""
        some = self.values > NONE * self.trace
        return np.where(some, self.components / np.sqrt(np.where(some, self.values, 1.0)), 0.0)


def _fit(fit: DataFrame, d: int, components: int) -> Whitening:
    def sums(batches):
        n, total = 0, [0] * d
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            n += len(x)
            for a in range(0, len(x), 2048):  # 2048 times 52 bits stay within 63
                total = [t + int(s) for t, s in zip(total, x[a : a + 2048].sum(0))]
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([[str(t) for t in total]])], names=["n", "total"])

    each = fit.mapInArrow(sums, "n long, total array<string>")
    added = each.select("n", F.posexplode("total").alias("k", "t")).groupBy("k").agg(F.sum("n").alias("n"), F.sum(F.col("t").cast("decimal(38,0)")).alias("t")).collect()
    n = added[0]["n"]
    whole = [int(r["t"]) for r in sorted(added, key=lambda r: r["k"])]
    total = np.array(whole, np.int64 if max(map(abs, whole)) < 2**62 else object)
    start = _combined(_spectra(fit, d), d)
    basis = np.linalg.qr(start.basis[:, ::-1])[0]
    for _ in range(ROUNDS):
        _, small = _products(fit, d, n, total, basis)
        scale = np.sqrt(np.maximum(np.diag(small), NONE * max(np.trace(small), 1e-300)))
        rest = np.abs(small / scale[:, None] / scale)
        np.fill_diagonal(rest, 0)
        values, turn = np.linalg.eigh(small)
        order = np.argsort(values, kind="stable")[::-1]
        values, basis = np.maximum(values[order], 0.0), basis @ turn[:, order]
        if rest.max(initial=0) <= REST:
            break
        basis = np.linalg.qr(basis)[0]
    k = min(components, d)
    out = Whitening(n, total, basis[:, :k], values[:k], float(np.trace(small)), 0.0)
    mean, two = _products(fit, d, n, total, out.scaled())
    some = out.values > NONE * out.trace
    error = np.abs(two - np.outer(mean, mean) - np.eye(k))[np.ix_(some, some)]
    out.identity_error = float(error.max(initial=0))
    return out


def whiten(vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``key``, component, n, deviation, whitened, explained, identity_error: a row per vector and component."""
    spark = vectors.sparkSession
    given = materialize(rounded(vectors, key, column), "rounded")
    fit = materialize(given.select("d", "x").distinct(), "fit")
    fitted = {r["d"]: None for r in fit.select("d").distinct().collect()}
    for d in sorted(fitted):
        fitted[d] = _fit(fit.where(F.col("d") == d), d, components)
    shared = spark.sparkContext.broadcast(fitted)
    kind = vectors.schema[key].dataType.simpleString()

    def run(batches):
        scaled = {d: w.scaled() for d, w in shared.value.items()}
        for batch in batches:
            sizes = batch.column("d").to_numpy()
            for d in np.unique(sizes):
                rows, w = np.flatnonzero(sizes == d), shared.value[int(d)]
                k = scaled[int(d)].shape[1]
                for a in range(0, len(rows), ROWS):
                    at = pa.array(rows[a : a + ROWS])
                    x = _matrix(batch.column("x").take(at), int(d))
                    y = centred(x, w.n, w.total) @ scaled[int(d)]
                    m = len(x)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(key).take(pa.array(np.repeat(rows[a : a + ROWS], k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                         pa.array(np.full(m * k, w.n)), pa.array([v for v in deviations(x, w.n, w.total) for _ in range(k)], pa.int64()), pa.array(y.ravel()),
                         pa.array(np.tile(w.values / w.trace if w.trace > 0 else np.zeros(k), m)), pa.array(np.full(m * k, w.identity_error))],
                        names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                    )

    return given.mapInArrow(run, f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> list[int | None]:
    """Sum of (n x - total)^2 over the entries, exact; None beyond 64 bits."""
    about = ((centred(x, n, total) * float(n)) ** 2).sum(1)
    out: list[int | None] = [None] * len(x)
    near = about < 2.0**62
    # In range every square is, and so is every n * x - total; products may wrap around and come back.
    gap = (x[near] * np.int64(n) - np.array([int(t) & (2**64 - 1) for t in total], np.uint64).astype(np.int64)) if near.any() else x[near]
    for i, v in zip(np.flatnonzero(near), (gap * gap).sum(1).tolist()):
        out[i] = v
    for i in np.flatnonzero(~near & (about < 2.0**64)):
        exact = sum((n * int(a) - int(t)) ** 2 for a, t in zip(x[i], total))
        out[i] = exact if exact < 2**63 else None
    return out
