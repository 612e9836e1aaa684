"""Whitening of embeddings by an incremental eigendecomposition.

Every entry becomes a whole number (``floor(scale * c)``); the fit list holds each
distinct vector once.  Then:

1. *Rank-one updates.*  Each task keeps the leading eigenpairs of the centred
   scatter of the vectors it has seen.  A vector moves the mean and adds a
   rank-one term: components that it doesn't touch, and equal eigenvalues, are
   deflated, the others are the roots of the secular equation between their
   poles, and the eigenvectors come from the weights for which those roots are
   exact.  Vectors are dealt to ``LANES`` decompositions that numpy updates at
   once; the lanes are combined at the end of the task.
2. *Combining.*  Two spectra become one by rank-one updates with each scaled
   eigenvector of the other and with the difference of means.  Spectra of tasks
   meet in groups of ``FAN``, level by level, till one is left.
3. *Rayleigh-Ritz.*  The spectra keep ``RANK`` components, so they only start the
   refinement: distributed passes multiply the covariance (rows centred before
   multiplying) with new basis vectors, the small projected problem gives Ritz
   pairs, and their residuals extend the basis until the wanted pairs have none
   to speak of.  A basis of all dimensions is exact, so passes end.

What reaches the driver is of the size of the dimension times the rank, never of
the rows.  Exact sums and deviations are whole-number arithmetic (Python integers
where 64 bits could overflow); a deviation beyond 64 bits is null, and an entry
beyond them counts as the largest or smallest there is.

Defined results: vectors null, empty or with null or non-finite entries take no
part and have no row; nor have vectors of another length than most vectors (ties:
the shorter length).  Repeated rows of an id repeat.  Only components with an
eigenvalue above rounding are returned: none for one distinct vector, fewer than
asked for flat data; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import stage

SCALE = 256
COMPONENTS = 4
RANK = 16
LANES = 64
FAN = 16
STEPS = 24              # halvings of an interval between poles; the refinement gives the last digits
SAFE = 1 << 62
ROWS = 4096             # of a batch of exact arithmetic


def whole_numbers(c: Column, scale: int = SCALE) -> Column:
    """array<long> of floor(scale * entry); null for vectors that take no part."""
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when((F.size(c) > 0) & ~bad, F.transform(c, lambda v: F.floor(v.cast("double") * scale)))


# --- rank-one updates --------------------------------------------------------

def secular(d: np.ndarray, z: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (G, m) and eigenvectors (G, m, m) of diag(d) + z z^T for G problems, d ascending."""
    G, m = d.shape
    d, z = d.copy(), z.copy()
    turn = None
    size = np.maximum(np.abs(d).max(1), (z * z).sum(1))
    tol = 8 * np.finfo(float).eps * size
    live = z * z > tol[:, None] * 1e-16
    # deflation of equal poles: rotations move their weight to the last of them
    if ((np.diff(d, axis=1) <= tol[:, None]) & live[:, :-1]).any():
        turn = np.broadcast_to(np.eye(m), (G, m, m)).copy()
        for i in range(m - 1):
            meet = (d[:, i + 1] - d[:, i] <= tol) & live[:, i]
            r = np.hypot(z[:, i], z[:, i + 1])
            c = np.where(meet, z[:, i + 1] / np.where(meet, r, 1), 1.0)[:, None]
            s = np.where(meet, z[:, i] / np.where(meet, r, 1), 0.0)[:, None]
            a, b = turn[:, :, i].copy(), turn[:, :, i + 1].copy()
            turn[:, :, i], turn[:, :, i + 1] = c * a - s * b, s * a + c * b
            z[:, i + 1] = np.where(meet, r, z[:, i + 1])
            z[:, i] = np.where(meet, 0, z[:, i])
            live[:, i + 1] |= meet
            live[:, i] &= ~meet
    z = np.where(live, z, 0)
    z2 = z * z
    # the root of a live pole lies between it and the next one
    above = np.where(live, d, np.inf)
    nxt = np.concatenate((np.minimum.accumulate(above[:, ::-1], axis=1)[:, ::-1][:, 1:], np.full((G, 1), np.inf)), axis=1)
    last = ~np.isfinite(nxt)
    end = np.where(last, d + z2.sum(1)[:, None] * (1 + 1e-12), nxt)
    half = (end - d) / 2

    apart = np.where(live, d, 4 * np.abs(end).max() + 1)[:, None, :]      # poles without weight stand aside
    room = np.empty((G, m, m))

    def value(off, t):
        np.subtract(off, t[:, :, None], out=room)
        np.divide(z2[:, None, :], room, out=room)
        return 1 + room.sum(2)

    # measured from the nearer pole, so that small distances keep their digits
    half = np.where(live, half, 1.0)
    from_low = np.where(live[:, :, None], apart - d[:, :, None], 3.0)
    low = (value(from_low, half) >= 0) | last | ~live
    base = np.where(low, d, end)
    off = np.where(low[:, :, None], from_low, apart - end[:, :, None])
    lo = np.where(low, 0.0, -half)
    hi = np.where(low, np.where(last, 2 * half, half), 0.0)
    for _ in range(steps):
        mid = (lo + hi) / 2
        up = value(off, mid) < 0
        lo, hi = np.where(up, mid, lo), np.where(up, hi, mid)
    t = (lo + hi) / 2
    root = np.where(live, base + t, d)
    # weights for which these roots are exact: orthogonal eigenvectors
    gap = np.where(live[:, None, :], (base[:, None, :] - d[:, :, None]) + t[:, None, :], 1.0)      # root_j - d_i
    poles = np.where(live[:, None, :] & live[:, :, None], d[:, None, :] - d[:, :, None], 1.0)
    i = np.arange(m)
    poles[:, i, i] = 1.0
    w = np.sqrt(np.abs(np.prod(gap / np.where(poles == 0, 1, poles), axis=2)))
    w = np.where(live, np.copysign(w, z), 0)
    v = w[:, :, None] / np.where(gap == 0, np.finfo(float).tiny, -gap)
    v = np.where(live[:, None, :], v, np.eye(m)[None])
    norm = np.sqrt((v * v).sum(1))
    v /= np.where(norm > 0, norm, 1)[:, None, :]
    return root, v if turn is None else turn @ v


class Spectra:
    """G decompositions of equal shape: counts, means, eigenvalues (descending) and eigenvectors of the scatter."""

    def __init__(self, lanes: int, dim: int, rank: int):
        rank = min(rank, dim)
        self.n = np.zeros(lanes)
        self.mean = np.zeros((lanes, dim))
        self.value = np.zeros((lanes, rank))
        self.vector = np.zeros((lanes, dim, rank))

    def part(self, k) -> Spectra:
        out = object.__new__(Spectra)
        out.n, out.mean, out.value, out.vector = self.n[k], self.mean[k], self.value[k], self.vector[k]
        return out

    def rank_one(self, a: np.ndarray) -> None:
        """Add a a^T (G, dim) to the scatters."""
        q = self.vector
        z = np.einsum("gdr,gd->gr", q, a)
        rest = a - np.einsum("gdr,gr->gd", q, z)
        more = np.einsum("gdr,gd->gr", q, rest)
        z, rest = z + more, rest - np.einsum("gdr,gr->gd", q, more)
        beta = np.sqrt((rest * rest).sum(1))
        beta = np.where(beta > 1e-12 * np.sqrt((a * a).sum(1)), beta, 0)
        unit = rest / np.where(beta > 0, beta, 1)[:, None] * (beta > 0)[:, None]
        d = np.concatenate((np.zeros((len(z), 1)), self.value[:, ::-1]), axis=1)
        z = np.concatenate((beta[:, None], z[:, ::-1]), axis=1)
        basis = np.concatenate((unit[:, :, None], q[:, :, ::-1]), axis=2)
        # a value of 0 without a vector has no weight; equal poles are sorted by construction
        value, v = secular(d, z)
        order = np.argsort(-value, axis=1, kind="stable")[:, :self.value.shape[1]]
        self.value = np.maximum(np.take_along_axis(value, order, 1), 0)
        self.vector = basis @ np.take_along_axis(v, order[:, None, :], 2)

    def add(self, x: np.ndarray, there: np.ndarray) -> None:
        """One vector a lane; lanes without one (``there`` False) stay."""
        gap = np.where(there[:, None], x - self.mean, 0)
        self.rank_one(gap * np.sqrt(self.n / (self.n + 1))[:, None])
        self.n = self.n + there
        self.mean = self.mean + gap / np.maximum(self.n, 1)[:, None]

    def join(self, other: Spectra) -> None:
        """Take in the scatters of the other lanes, pair by pair."""
        both = np.maximum(self.n + other.n, 1)
        gap = other.mean - self.mean
        for k in range(other.value.shape[1]):
            self.rank_one(other.vector[:, :, k] * np.sqrt(other.value[:, k])[:, None])
        self.rank_one(gap * np.sqrt(self.n * other.n / both)[:, None])
        self.mean = self.mean + gap * (other.n / both)[:, None]
        self.n = self.n + other.n

    def joined(self) -> Spectra:
        """All lanes as one."""
        now = self
        while len(now.n) > 1:
            h = len(now.n) // 2
            left, right, odd = now.part(slice(0, h)), now.part(slice(h, 2 * h)), now.part(slice(2 * h, None))
            left.join(right)
            now = object.__new__(Spectra)
            for f in ("n", "mean", "value", "vector"):
                setattr(now, f, np.concatenate((getattr(left, f), getattr(odd, f))))
        return now

    def pack(self) -> np.ndarray:
        return np.concatenate([np.ravel(x) for x in (self.n, self.mean, self.value, self.vector)])

    @staticmethod
    def unpack(rows: list[np.ndarray], dim: int, rank: int) -> Spectra:
        out, a = Spectra(len(rows), dim, rank), np.stack(rows)
        r = out.value.shape[1]
        out.n, out.mean, out.value, out.vector = a[:, 0], a[:, 1:1 + dim], a[:, 1 + dim:1 + dim + r], a[:, 1 + dim + r:].reshape(-1, dim, r)
        return out


# --- distributed passes ------------------------------------------------------

def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _fold(df: DataFrame, merge: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray | None:
    """One array<double> from those of all rows (g, a), merged in groups of FAN level by level."""
    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [np.asarray(a, float) for a in pdf.sort_values("g")["a"]]
        return pd.DataFrame({"g": [int(pdf["g"].min()) // FAN], "a": [merge(rows)]})

    now = stage(df)
    while True:
        found = now.limit(2).count()
        if found < 2:
            row = now.first()
            return None if row is None else np.array(row["a"], float)
        # task numbers are close together, so each level has a FAN-th of the rows
        now = stage(now.groupBy(F.expr(f"g div {FAN}")).applyInPandas(group, "g long, a array<double>"))


def _pass(fit: DataFrame, dim: int, each: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """Sum over the fit list of each(batch of x as doubles)."""
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = np.ravel(each(_matrix(batch.column(0)).astype(float)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["a"])

    rows = fit.select("x").mapInArrow(run, "a array<double>").select(F.spark_partition_id().cast("long").alias("g"), "a")
    return _fold(rows, lambda parts: np.sum(parts, axis=0))


def incremental(fit: DataFrame, dim: int, rank: int = RANK, lanes: int = LANES) -> Spectra | None:
    """The leading eigenpairs of the scatter of the fit list (x array<long>), by rank-one updates."""
    def run(batches):
        spectra, rest = None, np.zeros((0, dim))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.concatenate((rest, _matrix(batch.column(0)).astype(float)))
            spectra = spectra or Spectra(lanes, dim, rank)
            whole = len(x) // lanes * lanes
            for lo in range(0, whole, lanes):
                spectra.add(x[lo:lo + lanes], np.ones(lanes, bool))
            rest = x[whole:]
        if spectra is not None:
            if len(rest):
                fill = np.concatenate((rest, np.zeros((lanes - len(rest), dim))))
                spectra.add(fill, np.arange(lanes) < len(rest))
            yield pa.RecordBatch.from_arrays([pa.array([spectra.joined().pack()], pa.list_(pa.float64()))], ["a"])

    rows = fit.select("x").mapInArrow(run, "a array<double>").select(F.spark_partition_id().cast("long").alias("g"), "a")
    packed = _fold(rows, lambda parts: Spectra.unpack(parts, dim, rank).joined().pack())
    return None if packed is None else Spectra.unpack([packed], dim, rank)


def _grow(basis: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Orthonormal directions of ``new`` beyond ``basis``, as many as there are."""
    for _ in range(2):
        new = new - basis @ (basis.T @ new)
        new = new / np.maximum(np.linalg.norm(new, axis=0), 1e-300)
    u, s, _ = np.linalg.svd(new, full_matrices=False)
    u = u[:, s > 1e-8]
    u = u - basis @ (basis.T @ u)
    return np.linalg.qr(u)[0] if u.shape[1] else u


def rayleigh_ritz(fit: DataFrame, mean: np.ndarray, n: int, start: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(values, vectors, trace) of the covariance of the fit list, from a starting basis."""
    dim = len(mean)
    rng = np.random.default_rng(5)
    norm = np.linalg.norm(start, axis=0)
    basis, product, trace = np.zeros((dim, 0)), np.zeros((dim, 0)), 0.0
    block = _grow(basis, start[:, norm > 0.5])
    if not block.shape[1]:
        block = _grow(basis, rng.normal(size=(dim, min(dim, wanted))))
    while True:
        def each(x, block=block):
            c = x - mean
            return np.concatenate((np.ravel(c.T @ (c @ block)), [np.einsum("ij,ij->", c, c)]))

        got = _pass(fit, dim, each) / n
        trace = float(got[-1])
        basis, product = np.concatenate((basis, block), axis=1), np.concatenate((product, got[:-1].reshape(dim, -1)), axis=1)
        small = basis.T @ product
        value, u = np.linalg.eigh((small + small.T) / 2)
        value, u = value[::-1], u[:, ::-1]
        ritz = basis @ u
        left = product @ u - ritz * value
        size = np.linalg.norm(left, axis=0)
        if basis.shape[1] == dim or size[:wanted].max() <= 1e-14 * max(value[0], 1e-300):
            return value[:wanted], ritz[:, :wanted], trace
        more = left[:, :RANK][:, size[:RANK] > 1e-14 * max(value[0], 1e-300)]
        block = _grow(basis, np.concatenate((more, rng.normal(size=(dim, 1))), axis=1))[:, :dim - basis.shape[1]]


def _ints(x: np.ndarray) -> np.ndarray:
    """Whole numbers that can't overflow in a sum of their batch."""
    return x if x.size == 0 or max(int(x.max()), -int(x.min())) * len(x) < SAFE else x.astype(object)


def exact_sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """n and the per-dimension sums of the fit list, exactly."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                total = _ints(_matrix(batch.column(0))).sum(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.num_rows], pa.int64()), pa.array([[str(int(v)) for v in total]], pa.list_(pa.string()))], ["n", "s"])

    rows = fit.select("x").mapInArrow(run, "n long, s array<string>")
    sums = [F.sum(F.col("s")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(dim)]
    got = rows.agg(F.sum("n").alias("n"), *sums).first()
    return int(got["n"] or 0), [int(got[f"s{k}"] or 0) for k in range(dim)]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n x - S)^2 of each row; None beyond 64 bits."""
    top = max(int(np.abs(x).max(initial=0)), 1)
    most = top * n + max(map(abs, sums), default=0)
    if most < 1 << 31 and most * most * max(1, len(sums)) < SAFE:
        gap = n * x - np.array(sums, np.int64)
        return (gap * gap).sum(1).tolist()
    gap = x.astype(object) * n - np.array(sums, object)
    return [int(v) if v < 1 << 63 else None for v in (gap * gap).sum(1)]


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, rank: int = RANK) -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error: a row for each row and component."""
    src = rows.select(F.col(f"`{key}`").alias("k"), whole_numbers(F.col(f"`{vector}`"), scale).alias("x")).where("x IS NOT NULL")
    kind = src.select("k").schema[0].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = rows.sparkSession
    lengths = src.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    dim = int(lengths["d"])
    src = src.where(F.size("x") == dim)
    fit = stage(src.select("x").distinct())
    n, sums = exact_sums(fit, dim)
    mean = np.array([s / n for s in sums])
    started = incremental(fit, dim, rank)
    wanted = min(components, dim)
    value, vectors, trace = rayleigh_ritz(fit, mean, n, started.vector[0], wanted)
    real = value > max(trace, 0) * dim * np.finfo(float).eps
    value, vectors = value[real], vectors[:, real]
    k = len(value)
    if not k:
        return spark.createDataFrame([], schema)
    # one fixed sign, so that runs agree
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(k)])
    turn = vectors / np.sqrt(value)

    def moments(x):
        y = (x - mean) @ turn
        return np.concatenate((y.sum(0), np.ravel(y.T @ y)))

    got = _pass(fit, dim, moments) / n
    cov = got[k:].reshape(k, k) - np.outer(got[:k], got[:k])
    error = float(np.abs(cov - np.eye(k)).max())
    share = (value / trace).tolist()

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                x = _matrix(part.column("x"))
                m = len(x)
                dev = deviations(x, n, sums)
                y = (x.astype(float) - mean) @ turn
                yield pa.RecordBatch.from_arrays([
                    part.column("k").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)), pa.array(np.repeat(np.array(dev, object), k), pa.int64()),
                    pa.array(y.ravel()), pa.array(share * m), pa.array(np.full(m * k, error))],
                    [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return src.mapInArrow(run, schema)
