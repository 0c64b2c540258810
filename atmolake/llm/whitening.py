"""Principal components of vectors by incremental eigendecomposition, and vectors whitened by them.

Each partition of the distinct vectors keeps a spectrum: count, mean, eigenvalues and eigenvectors of the scatter around
the mean. Centred rank-one updates change it, one for each row of a block's triangular factor and one for the way of the
mean: the secular equation gives the new eigenvalues, after deflation of those that an update leaves alone. Spectra meet sixteen at a time, in tasks, and combine by one rank-one
update for each direction of the other and one for the distance of the means. What comes out is a basis; Rayleigh-Ritz
steps over all vectors then refine it until the residuals of the components are at rounding error.

A spectrum keeps at most `rank` directions, so tasks hold d x rank numbers whatever the number of vectors. With d <= rank
nothing is left out and one step refines; beyond, steps with the residuals as further directions go on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from atmolake.llm.common import save

COMPONENTS, RANK = 4, 128
#: Vectors that are brought to one triangular factor before their rank-one updates.
BLOCK = 4096
#: Rayleigh-Ritz steps at most, and the residual, relative to the largest eigenvalue, at which they end.
MAX_STEPS, RESIDUAL = 40, 1e-13
#: Directions whose share of the largest eigenvalue is below this have no variance but rounding.
NO_VARIANCE = 1e-12
EPS = np.finfo(float).eps


def secular_roots(poles: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Differences poles[j] - root[i], as row i and column j, for the eigenvalues of diag(poles) + z z'.

    poles ascend strictly and no z is 0. Each root lies between its pole and the next; it is written as the distance from
    the nearer of the two, so the differences keep full relative precision. All roots are iterated at once: the sums on
    either side of a root are each replaced by one pole that has their value and slope, and bisection steps in where
    that leaves the bracket.
    """
    k, zz = len(poles), z * z
    gaps = np.append(np.diff(poles), zz.sum())
    rows = np.arange(k)
    left = rows[None, :] <= rows[:, None]

    def at(t: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, ...]:
        inverse = 1.0 / (d - t[:, None])
        terms = zz * inverse
        slopes = terms * inverse
        low, slope = np.where(left, terms, 0.0).sum(1), np.where(left, slopes, 0.0).sum(1)
        total = terms.sum(1)
        return 1.0 + total, low, total - low, slope, slopes.sum(1) - slope

    # The sign halfway tells which pole is nearer.
    d = poles[None, :] - poles[:, None]
    f, *_ = at(gaps / 2, d)
    right = (f < 0) & (rows < k - 1)
    origin = np.where(right, rows + 1, rows)
    d = poles[None, :] - poles[origin][:, None]
    at_left, at_right = d[rows, rows], np.where(rows < k - 1, d[rows, np.minimum(rows + 1, k - 1)], 0.0)
    half = gaps / 2
    lower = np.where(right, -half, np.where(f < 0, half, 0.0))
    upper = np.where(right, 0.0, np.where(f < 0, gaps, half))
    t = (lower + upper) / 2
    for _ in range(60):
        f, low, high, low_slope, high_slope = at(t, d)
        done = np.abs(f) <= 4 * EPS * k * (1.0 + np.abs(low) + np.abs(high))
        done |= upper - lower <= 2 * EPS * np.maximum(np.abs(lower), np.abs(upper))
        if done.all():
            break
        lower, upper = np.where(f < 0, t, lower), np.where(f < 0, upper, t)
        a, b = at_left - t, at_right - t
        q = low_slope * a * a
        s = np.where(rows < k - 1, high_slope * b * b, 0.0)
        c = 1.0 + (low - low_slope * a) + np.where(rows < k - 1, high - high_slope * b, 0.0)
        # c (l - x)(r - x) + q (r - x) + s (l - x) = 0, where one of l and r is 0.
        p = c * (at_left + at_right) + q + s
        r = q * at_right + s * at_left
        root = np.sqrt(np.maximum(p * p - 4 * c * r, 0.0))
        with np.errstate(all="ignore"):
            x = np.where(p > 0, 2 * r / (p + root), (p - root) / (2 * c))
            x[k - 1] = q[k - 1] / c[k - 1]
        inside = (x > lower) & (x < upper)
        t = np.where(done, t, np.where(inside, x, (lower + upper) / 2))
    return d - t[:, None]


def rank_one(values: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, ascending, and eigenvectors, as columns, of diag(values) + z z'."""
    k = len(values)
    order = np.argsort(values, kind="stable")
    values, z = values[order].copy(), z[order].copy()
    turn = np.eye(k)[:, order]
    size = max(values[-1] if k else 0.0, float(z @ z))
    small = 8 * EPS * size
    norm = np.sqrt(z @ z)
    live = np.abs(z) * norm > small
    # Of two equal eigenvalues a rotation leaves one to the update.
    places = np.flatnonzero(live)
    if len(places) > 1 and (np.diff(values[places]) <= small * 4).any():
        last = places[0]
        for i in places[1:]:
            r = np.hypot(z[last], z[i])
            c, s = z[i] / r, z[last] / r
            if abs((values[i] - values[last]) * c * s) <= small:
                turn[:, [last, i]] = turn[:, [last, i]] @ np.array([[c, s], [-s, c]])
                a, b = values[last], values[i]
                values[last], values[i] = a * c * c + b * s * s, a * s * s + b * c * c
                z[last], z[i], live[last] = 0.0, r, False
            last = i
        places = np.flatnonzero(live)
    if len(places):
        # Rotations may have moved poles within rounding error: keep them in order.
        places = places[np.argsort(values[places], kind="stable")]
        poles, w = values[places], z[places]
        if len(places) > 1 and (np.diff(poles) <= 0).any():
            poles = np.maximum.accumulate(poles + np.arange(len(poles)) * EPS * size)
        d = secular_roots(poles, w)
        n = len(places)
        # The z that has exactly these roots, so that the eigenvectors are orthogonal.
        gaps = np.where(np.arange(n)[:, None] < np.arange(n)[None, :], poles[:, None], np.append(poles[1:], 0.0)[:, None]) - poles[None, :]
        gaps[-1, :] = -1.0
        exact = np.sqrt(np.abs(np.prod(d / gaps, axis=0)))
        vectors = np.copysign(exact, w)[None, :] / d
        vectors /= np.sqrt((vectors * vectors).sum(1))[:, None]
        nearest = np.argmin(np.abs(d), axis=1)
        values[places] = poles[nearest] - d[np.arange(n), nearest]
        turn[:, places] = turn[:, places] @ vectors.T
    order = np.argsort(values, kind="stable")
    return values[order], turn[:, order]


class Spectrum:
    """Count, mean, and eigenvalues and eigenvectors (as columns) of the scatter around the mean."""

    def __init__(self, d: int, rank: int = RANK):
        self.n, self.mean, self.rank = 0, np.zeros(d), rank
        self.values, self.vectors = np.zeros(0), np.zeros((d, 0))

    def update(self, u: np.ndarray) -> None:
        """Add u u' to the scatter."""
        size = np.sqrt(u @ u)
        if not size:
            return
        z = self.vectors.T @ u
        if self.vectors.shape[1] < len(u):
            rest = u - self.vectors @ z
            again = self.vectors.T @ rest
            rest -= self.vectors @ again
            z += again
            left = np.sqrt(rest @ rest)
            if left > 64 * EPS * size:
                self.vectors = np.column_stack([self.vectors, rest / left])
                self.values, z = np.append(self.values, 0.0), np.append(z, left)
        self.values, turn = rank_one(self.values, z)
        self.vectors = self.vectors @ turn
        if len(self.values) > self.rank:
            self.values, self.vectors = self.values[-self.rank :], self.vectors[:, -self.rank :]

    def add(self, x: np.ndarray) -> None:
        """One more vector: the mean moves, and the scatter grows by one centred rank-one term."""
        away = x - self.mean
        self.update(away * np.sqrt(self.n / (self.n + 1)))
        self.n += 1
        self.mean = self.mean + away / self.n

    def _add(self, n: int, mean: np.ndarray, rows: np.ndarray) -> None:
        """n more vectors of that mean whose scatter around it is the sum of row' row."""
        for row in rows:
            self.update(row)
        both, away = self.n + n, mean - self.mean
        self.update(away * np.sqrt(self.n / both * n))
        self.mean, self.n = self.mean + away * (n / both), both

    def add_block(self, x: np.ndarray) -> None:
        """Many vectors: a triangular factor has their scatter in at most as many rows as there are dimensions, so a block
        costs so many rank-one updates and not one for each vector."""
        mean = x.mean(0)
        rows = x - mean
        self._add(len(x), mean, np.linalg.qr(rows, mode="r") if len(rows) > rows.shape[1] else rows)

    def combine(self, other: Spectrum) -> None:
        if other.n:
            self._add(other.n, other.mean, (other.vectors * np.sqrt(np.maximum(other.values, 0.0))).T)

    def pack(self) -> list[float]:
        return [float(self.n), *self.mean, *self.values, *self.vectors.T.ravel()]

    @classmethod
    def unpack(cls, numbers: np.ndarray, d: int, rank: int) -> Spectrum:
        out = cls(d, rank)
        k = (len(numbers) - 1 - d) // (d + 1)
        out.n, out.mean, out.values = int(numbers[0]), np.array(numbers[1 : d + 1]), np.array(numbers[d + 1 : d + 1 + k])
        out.vectors = np.array(numbers[d + 1 + k :]).reshape(k, d).T
        return out


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id and x = floor(256 * c) of every vector that takes part.

    Left out are null vectors, those with null, NaN or infinite entries or entries beyond the range of x, empty ones,
    and those whose length is not the most frequent one (the smallest of equally frequent ones).
    """
    fits = F.forall("embedding", lambda c: F.coalesce(~F.isnan(c) & (F.abs(256 * c.cast("double")) < 2.0**62), F.lit(False)))
    used = vectors.select("vec_id", "embedding").filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).filter(fits)
    used = used.select("vec_id", F.transform("embedding", lambda c: F.floor(256 * c.cast("double"))).alias("x"))
    used = save(used, "integer-vectors")
    lengths = used.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return used.filter(F.size("x") == (lengths[0]["d"] if lengths else 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch["x"]
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _folded(parts: DataFrame, merge: Callable[[list[np.ndarray]], list[float]], fan_in: int = 16) -> np.ndarray | None:
    """Merge the rows (part, numbers), `fan_in` at a time and in the order of part, into one; None if there are none."""

    def together(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        return pd.DataFrame({"part": [rows["part"].iloc[0] // fan_in], "numbers": [merge([np.asarray(x) for x in rows["numbers"]])]})

    parts = save(parts, "parts")
    last = parts.agg(F.max("part").alias("last")).first()["last"]
    if last is None:
        return None
    while True:
        parts = save(parts.groupBy(F.floor(F.col("part") / fan_in)).applyInPandas(together, "part long, numbers array<double>"), "parts")
        if last < fan_in:
            return np.array(parts.first()["numbers"])
        last //= fan_in


def _summed(fit: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all vectors of `of`, which takes the vectors of a batch and gives the sum of their numbers."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = sum(of(_matrix(batch)) for batch in batches if batch.num_rows)
        if np.ndim(total):
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "numbers": [total]})

    return _folded(fit.mapInArrow(part, "part bigint, numbers array<double>"), lambda rows: sum(rows[1:], rows[0]))


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums/n, rounded once: the difference is taken in whole numbers."""
    if n * max(int(np.abs(x).max()), 1) < 1 << 61:
        return (n * x - np.array(sums, np.int64)) / n
    return ((n * x.astype(object) - np.array(sums, object)) / n).astype(float)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n x - sums)^2, exactly; None where it is no long."""
    if x.shape[1] * (2 * n * max(int(np.abs(x).max()), 1)) ** 2 < 1 << 63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(1)
    return [value if value < 1 << 63 else None for value in exact]


class Components:
    """n and sums of the fit list, its components as columns by falling eigenvalue, and the trace of its covariance."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float):
        self.n, self.sums, self.values, self.vectors, self.trace = n, sums, values, vectors, trace


def fitted(fit: DataFrame, components: int = COMPONENTS, rank: int = RANK) -> Components | None:
    """The components of the rows of fit (x, all of one length); None without rows."""
    sums = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast(DecimalType(38, 0))).alias("s"), F.count(F.lit(1)).alias("n")).collect()
    if not sums:
        return None
    n, sums = sums[0]["n"], [int(row["s"]) for row in sorted(sums, key=lambda row: row["i"])]
    d = len(sums)

    def spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        spectrum = Spectrum(d, rank)
        for batch in batches:
            x = _matrix(batch).astype(float)
            for i in range(0, len(x), BLOCK):
                spectrum.add_block(x[i : i + BLOCK])
        if spectrum.n:
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "numbers": [spectrum.pack()]})

    def combined(rows: list[np.ndarray]) -> list[float]:
        spectrum = Spectrum.unpack(rows[0], d, rank)
        for row in rows[1:]:
            spectrum.combine(Spectrum.unpack(row, d, rank))
        return spectrum.pack()

    basis = Spectrum.unpack(_folded(fit.mapInArrow(spectra, "part bigint, numbers array<double>"), combined), d, rank).vectors[:, ::-1]
    components = min(components, d)
    if basis.shape[1] < components:  # fewer directions than components: any others complete them
        basis = np.column_stack([basis, np.eye(d)])
    for _ in range(MAX_STEPS):
        basis = np.linalg.qr(basis)[0][:, :d]

        def step(x: np.ndarray) -> np.ndarray:
            y = _centred(x, n, sums)
            return np.append((y.T @ (y @ basis)).ravel(), (y * y).sum())

        total = _summed(fit, step) / n
        image, trace = total[:-1].reshape(d, -1), total[-1]
        inner = basis.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, image = basis @ turn, image @ turn
        residual = image - ritz * values
        error = np.sqrt((residual[:, :components] ** 2).sum(0)).max()
        if basis.shape[1] == d or error <= RESIDUAL * values[0]:
            break
        basis = np.column_stack([ritz[:, :rank], residual[:, :rank]])
    vectors = ritz[:, :components]
    vectors = vectors * np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(components)])
    keep = values[:components] > NO_VARIANCE * max(values[0], 0.0)
    return Components(n, sums, values[:components][keep], vectors[:, keep], trace)


def whitened(vectors: DataFrame, components: int = COMPONENTS, rank: int = RANK) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error for every vector of vectors (vec_id, embedding).

    Components are numbered from 1 by falling eigenvalue of the covariance of the distinct x; the largest entry of each is
    positive, the first one of equal size. Components without variance have no rows: a table of one distinct vector has
    none at all, and so has an empty table. integers() says which vectors take part. Repeated rows and ids each have
    their rows, from one fit; a null vec_id stays. A deviation that is no long is null. Other columns take no part.
    """
    used = integers(vectors)
    fit = save(used.select("x").distinct(), "distinct-vectors")
    found = fitted(fit, components, rank)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if found is None or not len(found.values):
        return vectors.sparkSession.createDataFrame([], schema)
    scale = np.sqrt(found.values)
    k = len(scale)

    def project(x: np.ndarray) -> np.ndarray:
        return _centred(x, found.n, found.sums) @ found.vectors / scale

    def moments(x: np.ndarray) -> np.ndarray:
        w = project(x)
        return np.append((w.T @ w).ravel(), w.sum(0))

    total = _summed(fit, moments) / found.n
    error = float(np.abs(total[: k * k].reshape(k, k) - np.outer(total[k * k :], total[k * k :]) - np.eye(k)).max())
    explained = found.values / found.trace

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, m = _matrix(batch), batch.num_rows
            of = np.repeat(np.arange(m), k)
            columns = {
                "vec_id": batch["vec_id"].take(pa.array(of)),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                "n": pa.array(np.full(m * k, found.n)),
                "deviation": pa.array(_deviations(x, found.n, found.sums), pa.int64()).take(pa.array(of)),
                "whitened": pa.array(project(x).ravel()),
                "explained": pa.array(np.tile(explained, m)),
                "identity_error": pa.array(np.full(m * k, error)),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return used.withColumn("vec_id", F.col("vec_id").cast("long")).mapInArrow(rows, schema)
