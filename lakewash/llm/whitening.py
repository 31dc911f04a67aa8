"""Embedding whitening by QDWH spectral divide and conquer.

Vectors are put on an integer grid, so counts, sums and cross products are
exact and do not depend on how rows are dealt to tasks:

1. the fit list is each distinct grid vector once (copies are reduced inside
   each task before the shuffle);
2. one pass gives the number of vectors and their sums, a second one the
   cross products about the rounded mean, both as integers; a task hands on
   one row for each dimension (pair), and these are added on the executors;
3. the covariance (dimension by dimension, a few hundred rows) is split on the
   driver: the polar factor of the covariance less a shift, found by QDWH,
   gives projectors on the subspaces above and below the shift, and each part
   is split again until it is a single component;
4. mean and components, 16 rows of the dimension, travel with the last pass,
   which whitens every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewash.llm.common import only, staged, table

#: Grid steps in one unit of an entry, and what is added to make it positive.
SCALE, OFFSET = 64, 1_000_000
#: Components that are kept.
COMPONENTS = 16
#: A dimension above this would make cross products too many for a task.
MOST_DIMENSIONS = 4096
#: Entries of this size or more leave the grid's exact range and are held to it.
GRID_LIMIT = float(1 << 40)

EPS = np.finfo(float).eps


# ------------------------------------------------------------------ QDWH

def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH: dynamically
    weighted Halley steps, each from the QR of the stacked pair, so that no
    inverse of an ill-conditioned matrix is taken. For a symmetric matrix it is
    the matrix sign."""
    n = len(a)
    bound = np.linalg.norm(a)  # at least the greatest singular value
    x, low = a / bound, 1e-16  # every singular value is in [low, 1] or negligible
    for _ in range(60):
        low2 = low * low
        d = np.cbrt(4 * (1 - low2) / (low2 * low2))
        w = np.sqrt(1 + d)
        fa = w + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - low2) / (low2 * w), 0))
        fb = (fa - 1) ** 2 / 4
        fc = fa + fb - 1
        q = np.linalg.qr(np.vstack([np.sqrt(fc) * x, np.eye(n)]))[0]
        new = fb / fc * x + (fa - fb / fc) / np.sqrt(fc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        low = min(1.0, low * (fa + fb * low2) / (1 + fc * low2))
        moved = np.linalg.norm(new - x)
        x = new
        if 1 - low < 10 * EPS and moved < np.cbrt(10 * EPS):
            break
    return x


def _split(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces of ``a`` above and below
    the shift, or None where the shift is too near an eigenvalue."""
    n = len(a)
    above = (polar_factor(a - shift * np.eye(n)) + np.eye(n)) / 2
    rank = int(round(np.trace(above)))
    if not 0 < rank < n or abs(np.trace(above) - rank) > 1e-6:
        return None
    # a basis of the projector's range: subspace iteration from a fixed start,
    # completed by the orthogonal complement
    q = np.linalg.qr(above @ np.random.default_rng(n).standard_normal((n, rank)))[0]
    q = np.linalg.qr(above @ q, mode="complete")[0]
    return q[:, :rank], q[:, rank:]


def spectral_components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric
    matrix. A part whose eigenvalues agree to working precision is one
    eigenspace, and any orthonormal basis of it is returned."""
    scale = np.linalg.norm(v)
    values, vectors = [], []
    work = [(np.eye(len(v)), v)]
    while work:
        basis, a = work.pop()
        mean = np.trace(a) / len(a)
        if len(a) == 1 or np.linalg.norm(a - mean * np.eye(len(a))) <= 8 * EPS * scale:
            values += np.diag(a).tolist()
            vectors.append(basis)
            continue
        # shifts between the extremes of the diagonal, which the spectrum holds:
        # first its median, for even halves, then others off any eigenvalue
        diagonal = np.sort(np.diag(a))
        spread = max(np.linalg.norm(a - mean * np.eye(len(a))), EPS * scale)
        tries = [float(np.median(diagonal)), float(mean),
                 *(float(mean + spread * f) for f in (0.01, -0.013, 0.07, -0.09, 0.2, -0.23, 0.4, -0.43, 0.003, -0.0037))]
        halves = next((h for h in (_split(a, t) for t in tries) if h is not None), None)
        if halves is None:
            raise ArithmeticError(f"no shift splits a part of {len(a)} dimensions")
        for q in halves:
            part = q.T @ a @ q
            work.append((basis @ q, (part + part.T) / 2))
    order = np.argsort(-np.array(values), kind="stable")
    q = np.linalg.qr(np.hstack(vectors)[:, order])[0]  # orthonormal again, to working precision
    return np.einsum("ij,ij->j", q, v @ q), q


# ------------------------------------------------------------------ exact sums

GRID = "vec_id long, x array<long>"


def grid(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``(vec_id, x)``: entries as whole grid steps. Rows whose vector is null
    or holds a null, infinite or undefined entry are dropped."""
    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(1)
            flat = at.flatten()  # null vectors have no entries here
            c = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
            size = np.where(at.is_valid().to_numpy(zero_copy_only=False),
                            at.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64)
            ends = np.cumsum(size)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(c))])  # a null entry is read as NaN
            good = at.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - size])
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(np.clip(np.nan_to_num(c), -GRID_LIMIT, GRID_LIMIT) * SCALE).astype(np.int64) + OFFSET
            x = x[np.repeat(good, size)]
            offsets = np.concatenate([[0], np.cumsum(size[good])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(good)).cast(pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(x))], ["vec_id", "x"])

    return only(vectors, "vec_id", column).mapInArrow(steps, GRID)


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number and sums of the fit list, exact."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, np.int64)
        for batch in batches:
            x = _matrix(batch, d)
            n, total = n + len(x), total + x.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, d)), pa.array(np.concatenate([[n], total]))], ["i", "s"])

    rows = fit.mapInArrow(add, "i long, s long").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    got = {r.i: int(r.s) for r in rows.collect()}
    return got[-1], [got[i] for i in range(d)]


def _products(fit: DataFrame, d: int, centre: list[int]) -> np.ndarray:
    """Sums of products of every two dimensions about an integer centre, exact
    Python integers. Matrix products of integers below 2^53 are exact."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, total = np.array(centre, np.int64), np.zeros((d, d), object)
        for batch in batches:
            y = _matrix(batch, d) - c
            most = max(1, int(np.abs(y).max(initial=0)))
            rows = (1 << 53) // (most * most)  # so many products add up without rounding
            if rows:
                for at in range(0, len(y), rows):
                    part = y[at:at + rows].astype(float)
                    total += (part.T @ part).astype(np.int64)
            else:
                big = y.astype(object)
                total += big.T @ big
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array([str(v) for v in total[i, j]])], ["i", "j", "p"])

    rows = (fit.mapInArrow(add, "i long, j long, p string").groupBy("i", "j")
            .agg(F.sum(F.col("p").cast("decimal(38,0)")).alias("p")))
    out = np.zeros((d, d), object)
    for i, j, p in rows.collect():
        out[i, j] = out[j, i] = int(p)
    return out


@dataclass
class Whitener:
    """A fit: number and sums of its vectors, components by falling variance."""

    n: int
    sums: list[int]
    values: np.ndarray  # variances of the kept components
    vectors: np.ndarray  # their directions, columns
    trace: float
    identity_error: float = float("nan")

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n*x - S of every row, whole numbers: exact in 64 bits or, where they
        would not hold it, as Python integers."""
        most = max(1, int(np.abs(x).max(initial=0)), -(-max(map(abs, self.sums), default=0) // self.n))
        kind = np.int64 if 2 * most * self.n < 1 << 62 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(float) @ self.vectors / np.sqrt(self.values)


def fit_whitener(fit: DataFrame, d: int, components: int = COMPONENTS) -> Whitener | None:
    """Fit on the distinct grid vectors ``x``, all of dimension ``d``. None
    where no direction varies. Components whose variance is zero to working
    precision have no whitened value and are left out."""
    n, sums = _sums(fit, d)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    products, rest = _products(fit, d, centre), [s - n * c for s, c in zip(sums, centre)]
    exact = [[n * int(products[i, j]) - rest[i] * rest[j] for j in range(d)] for i in range(d)]
    v = np.array([[e / (n * n) for e in row] for row in exact])
    trace = sum(exact[i][i] for i in range(d)) / (n * n)
    if trace == 0:
        return None
    values, vectors = spectral_components(v)
    kept = np.flatnonzero(values[:components] > d * EPS * values[0])
    return Whitener(n, sums, values[kept], vectors[:, kept], trace)


def identity_error(fit: DataFrame, d: int, w: Whitener) -> float:
    """Greatest absolute entry of the covariance of the whitened fit list less
    the identity, measured on the whitened vectors."""
    k = len(w.values)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            y = w.whitened(w.centred(_matrix(batch, d)))
            y = np.hstack([y, np.ones((len(y), 1))])
            total += y.T @ y
        i, j = np.triu_indices(k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "p"])

    total = np.zeros((k + 1, k + 1))
    for i, j, p in fit.mapInArrow(add, "i long, j long, p double").groupBy("i", "j").agg(F.sum("p").alias("p")).collect():
        total[i, j] = total[j, i] = p
    mean = total[:k, k] / w.n  # nought but for rounding: the vectors are centred
    return float(np.abs(total[:k, :k] / w.n - np.outer(mean, mean) - np.eye(k)).max())


RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Every row of finite entries, once for each kept component: ``(vec_id,
    component, n, deviation, whitened, explained, identity_error)``.

    Rows whose vector is null or holds a null or non-finite entry are dropped.
    The table's dimension is the one most remaining rows have (the greater of
    two as frequent); rows of another dimension, empty vectors among them, are
    dropped as well. Entries beyond 2^40 in size count as 2^40. Copies are one
    vector of the fit and as many rows of the result; null vec_ids keep their
    rows; other columns are left out. An empty table, or one whose vectors are
    all alike, gives no row; with fewer varying directions than ``components``
    there are fewer components. A deviation that a long cannot hold is null.
    """
    spark = vectors.sparkSession
    rows = grid(vectors, column)
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = sizes.d if sizes else 0
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {d} dimensions; up to {MOST_DIMENSIONS} are whitened")
    if d == 0:
        return spark.createDataFrame([], RESULT)
    rows = rows.where(F.size("x") == d)
    fit = staged(rows.select("x").distinct(), "whitening-fit")
    w = fit_whitener(fit, d, components)
    if w is None:
        return spark.createDataFrame([], RESULT)
    w.identity_error = identity_error(fit, d, w)
    k = len(w.values)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RESULT.split(", ")]
        for batch in batches:
            m = batch.num_rows
            centred = w.centred(_matrix(batch, d))
            if centred.dtype == object or int(np.abs(centred).max(initial=0)) ** 2 * d >= 1 << 63:
                squares = [sum(int(e) ** 2 for e in row) for row in centred.tolist()]
                deviation = pa.array([s if s < 1 << 63 else None for s in squares], pa.int64())
            else:
                deviation = pa.array((centred * centred).sum(1))
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, w.n)), deviation.take(each), pa.array(w.whitened(centred).reshape(-1)),
                pa.array(np.tile(w.explained, m)), pa.array(np.full(m * k, w.identity_error))], names)

    return rows.mapInArrow(apply, RESULT)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of all embeddings."""
    return whiten(table(spark, sf_dir, "embeddings"))
