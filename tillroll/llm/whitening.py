"""Embedding whitening by incremental eigendecomposition.

Every task keeps the spectrum of the vectors it has seen and updates it, vector
by vector, by a centred rank-one update: the secular equation gives the new
eigenvalues, equal eigenvalues and negligible components are deflated first.
The tasks' spectra meet in a tree of groups; two are combined by one rank-one
update per direction and one for the difference of their means. The directions
so found are the basis of a last distributed pass: the covariance of all vectors
in that basis (exactly centred), whose eigenvectors turn the basis (Rayleigh-Ritz).
The basis is complete, so its result has the precision of doubles.

Entries c become x = floor(1024 c) + 100000. Left out are vectors that are null
or empty, hold null or non-finite entries or any of 2**52 or more in size (x
must fit in 64 bits), and vectors of another length than the most frequent one
(the longer one of equals). Repeated rows and ids count each time. A direction without
variance (copies of one vector, fewer vectors than dimensions) has null
``whitened`` and plays no part in ``identity_error``, which is null if there is
no other. An empty table gives no row. Other columns play no part.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tillroll.llm.staging import share, stage

SCALE, SHIFT = 1024, 100000  # fixed values of x
FAN = 8                      # spectra combined by one task
EPS = np.finfo(float).eps
CLOSE = 1e-11                # of a root; the final pass makes up for what is left
_SUMMARY = "node long, payload binary"


# --- rank-one update of a spectrum ---

def _roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(z2 / (d - t)), d ascending and distinct, as
    ``(origin, offset)``: root i is d[origin[i]] + offset[i]. Each step fits the
    sums left and right of the root by one pole each; bisection where that
    leaves the bracket."""
    k = len(d)
    every = np.arange(k)
    gap = np.append(d[1:] - d[:-1], rho * z2.sum())
    at_mid = 1 + rho * ((1 / (d[None, :] - (d + gap / 2)[:, None])) @ z2)
    right = (at_mid < 0) & (every < k - 1)
    origin = every + right
    delta = d[None, :] - d[origin][:, None]
    lo = np.where(right, -gap / 2, np.where(at_mid < 0, gap / 2, 0.0))
    hi = np.where(right, 0.0, np.where(at_mid < 0, gap, gap / 2))
    tau = (lo + hi) / 2
    below = np.tril(np.broadcast_to(rho * z2, (k, k)))
    above = rho * z2 - below
    p1, p2 = delta[every, every], np.append(delta[every[:-1], every[1:]], 1.0)
    for _ in range(64):
        inverse = 1 / (delta - tau[:, None])
        left, right = inverse * below, inverse * above
        sum_left, sum_right = left.sum(1), right.sum(1)
        f = 1 + sum_left + sum_right
        done = np.abs(f) <= CLOSE * (1 + sum_right - sum_left)
        if done.all():
            break
        low = f < 0
        lo, hi = np.where(low, tau, lo), np.where(low, hi, tau)
        a1, a2 = p1 - tau, p2 - tau
        a, b = np.einsum("ij,ij->i", left, inverse) * a1 * a1, np.einsum("ij,ij->i", right, inverse) * a2 * a2
        c = f - a / a1 - b / a2
        # c (a1 - s)(a2 - s) + a (a2 - s) + b (a1 - s) = 0; the last root has one pole (b = 0).
        qb, qc = c * (a1 + a2) + a + b, f * a1 * a2
        disc = np.sqrt(np.maximum(qb * qb - 4 * c * qc, 0))
        step = np.where(qb > 0, 2 * qc / (qb + disc), (qb - disc) / (2 * c))
        step[-1] = a1[-1] + a[-1] / c[-1]
        new = tau + step
        new = np.where(done, tau, np.where((new > lo) & (new < hi), new, (lo + hi) / 2))
        if (new == tau).all():
            break
        tau = new
    return origin, tau


def rank_one(d: np.ndarray, q: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of q (diag(d) + rho z z') q', rho > 0, d ascending."""
    size = np.linalg.norm(z)
    r = rho * size * size
    top = max(abs(d[-1]), abs(d[0]), r)
    if not r > 0 or r <= EPS * EPS * top:
        return d, q
    z, tol, q = z / size, 8 * EPS * top, q.copy()
    # Deflation: a reflection gathers z in one direction of each cluster of equal eigenvalues.
    cuts = np.flatnonzero(np.diff(d) > tol) + 1
    for a, b in zip(np.append(0, cuts), np.append(cuts, len(d))):
        if b - a > 1:
            v = z[a:b].copy()
            norm = np.linalg.norm(v)
            if norm > 0:
                v[-1] += norm if v[-1] >= 0 else -norm
                z = z.copy()
                last = -norm if z[b - 1] >= 0 else norm
                z[a:b] = 0
                z[b - 1] = last
                v /= np.linalg.norm(v)
                q[:, a:b] -= 2 * np.outer(q[:, a:b] @ v, v)
    on = r * np.abs(z) > tol
    if not on.any():
        return d, q
    d = d.copy()
    da, za = d[on], z[on]
    with np.errstate(all="ignore"):
        origin, tau = _roots(da, za * za, r)
    # The z that has exactly these roots keeps the vectors orthogonal.
    gaps = da[None, :] - da[origin][:, None] - tau[:, None]          # d_j - root_i
    between = da[:, None] - da[None, :]                              # d_i - d_j
    np.fill_diagonal(between, -1.0)
    ratio = np.abs(gaps / between)                                   # at i, j: |d_j - root_i| / |d_i - d_j|
    fixed = np.copysign(np.sqrt(np.prod(ratio, axis=0) / r), za)
    u = fixed[:, None] / gaps.T
    u /= np.linalg.norm(u, axis=0)
    d[on] = da[origin] + tau
    q[:, on] = q[:, on] @ u
    order = np.argsort(d, kind="stable")
    return d[order], q[:, order]


class Spectrum:
    """Count, mean and spectrum of the scatter of the vectors added so far."""

    def __init__(self, dim: int):
        self.n, self.mean, self.d, self.q = 0, np.zeros(dim), np.zeros(dim), np.eye(dim)

    def _update(self, v: np.ndarray, rho: float) -> None:
        self.d, self.q = rank_one(self.d, self.q, self.q.T @ v, rho)

    def add(self, x: np.ndarray) -> None:
        self.n += 1
        away = x - self.mean
        if self.n > 1:
            self._update(away, (self.n - 1) / self.n)
        self.mean = self.mean + away / self.n

    def combine(self, other: "Spectrum") -> None:
        for value, vector in zip(other.d, other.q.T):
            if value > 0:
                self._update(vector, value)
        n = self.n + other.n
        away = other.mean - self.mean
        self._update(away, self.n * other.n / n)
        self.mean, self.n = self.mean + away * (other.n / n), n


# --- distributed passes ---

def _valid(column) -> F.Column:
    scaled = F.transform(column, lambda c: F.floor(c.cast("double") * SCALE))
    good = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < 2.0 ** 52))
    return F.when((F.size(column) > 0) & good, F.transform(scaled, lambda c: c + SHIFT))


def vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of the vectors that remain, of the most frequent length."""
    x = df.select(F.col(id_col).alias("id"), _valid(F.col(vector_col)).alias("x")).where(F.col("x").isNotNull())
    most = x.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return x.where(F.size("x") == (most["dim"] if most else 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy()
    return flat.reshape(batch.num_rows, -1)


def _summary(value) -> pa.RecordBatch:
    """What a task found, under the number of its partition."""
    return pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([pickle.dumps(value)], pa.binary())],
                                      names=["node", "payload"])


def _sums(batches):
    n, total = 0, None
    for batch in batches:
        if batch.num_rows:
            # Halves of the integers: their sums over a batch stay within 64 bits.
            x = _matrix(batch)
            part = [(int(h) << 32) + int(lo) for h, lo in zip((x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0))]
            total = part if total is None else [a + b for a, b in zip(total, part)]
            n += batch.num_rows
    if n:
        yield _summary((n, total))


def _add_sums(a, b):
    return a[0] + b[0], [x + y for x, y in zip(a[1], b[1])]


def _spectra(dim: int):
    def run(batches):
        s = Spectrum(dim)
        for batch in batches:
            for x in _matrix(batch).astype(float) if batch.num_rows else ():
                s.add(x)
        if s.n:
            yield _summary((s.n, s.mean, s.d, s.q))
    return run


def _combine(a, b):
    s, o = Spectrum(len(a[1])), Spectrum(len(b[1]))
    (s.n, s.mean, s.d, s.q), (o.n, o.mean, o.d, o.q) = a, b
    s.combine(o)
    return s.n, s.mean, s.d, s.q


def _reduce(summaries: DataFrame, merge):
    """Summaries by task combined in a tree, ``FAN`` to a group; the last one."""
    def group(rows):
        import pandas as pd

        rows = rows.sort_values("node")
        out = None
        for payload in rows["payload"]:
            value = pickle.loads(payload)
            out = value if out is None else merge(out, value)
        return pd.DataFrame({"node": [int(rows["group"].iloc[0])], "payload": [pickle.dumps(out)]})

    summaries = stage(summaries, "summaries")
    while summaries.count() > 1:
        grouped = summaries.withColumn("group", F.floor(F.col("node") / FAN)).groupBy("group")
        summaries = stage(grouped.applyInPandas(group, _SUMMARY), "summaries")
    row = summaries.first()
    return pickle.loads(row["payload"]) if row else None


def _centred(x: np.ndarray, n: int, total: list) -> np.ndarray:
    """n x - S, exactly: in 64 bits, or as Python integers where that is too short."""
    if n * int(np.abs(x).max()) < 1 << 62 and max(map(abs, total)) < 1 << 62:
        return n * x - np.array(total, np.int64)
    return n * x.astype(object) - np.array(total, object)


def _gram(shared):
    """Sum of the outer products of centred vectors in a basis."""
    def run(batches):
        n, total, basis = shared()
        out = None
        for batch in batches:
            if batch.num_rows:
                y = _centred(_matrix(batch), n, total).astype(float) / n @ basis
                out = y.T @ y if out is None else out + y.T @ y
        if out is not None:
            yield _summary(out)
    return run


def _whiten(shared):
    def run(batches):
        n, total, axes, share_of, error = shared()
        k, dim = len(share_of), len(total)
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            away = _centred(_matrix(batch), n, total)
            if away.dtype != object and dim * int(np.abs(away).max()) ** 2 < 1 << 63:
                deviation = pa.array((away * away).sum(1), pa.int64()).cast(pa.decimal128(19, 0)).cast(pa.decimal128(38, 0))
            else:
                import decimal

                deviation = pa.array([decimal.Decimal(sum(int(v) ** 2 for v in row)) for row in away], pa.decimal128(38, 0))
            white = (away.astype(float) / n) @ axes
            every = pa.array(np.repeat(np.arange(rows), k))
            flat = white.ravel()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(every), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                 pa.array(np.full(rows * k, n)), deviation.take(every), pa.array(flat, mask=np.isnan(flat)),
                 pa.array(np.tile(share_of, rows)), pa.array([error] * (rows * k), pa.float64())],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def components(x: DataFrame, most: int | None = None) -> dict | None:
    """Fit over all rows of ``vectors``: n, sums S, and per component (at most
    ``most``) its vector, eigenvalue and share of the trace; None without rows."""
    spark: SparkSession = x.sparkSession
    found = _reduce(x.select("x").mapInArrow(_sums, _SUMMARY), _add_sums)
    if found is None:
        return None
    n, total = found
    spectrum = _reduce(x.select("x").mapInArrow(_spectra(len(total)), _SUMMARY), _combine)
    basis = np.linalg.qr(spectrum[3][:, ::-1])[0]
    gram = _reduce(x.select("x").mapInArrow(_gram(share(spark, (n, total, basis))), _SUMMARY), np.add) / n
    value, turn = np.linalg.eigh((gram + gram.T) / 2)
    value, vector = value[::-1], (basis @ turn)[:, ::-1]
    k = min(most or len(value), len(value))
    trace = float(value.sum())
    value = np.where(value > len(value) * 16 * EPS * max(value[0], 0), value, 0.0)
    return {"n": n, "sums": total, "vectors": vector[:, :k], "values": value[:k],
            "explained": value[:k] / trace if trace > 0 else np.zeros(k)}


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 8) -> DataFrame:
    """Every remaining vector along the first ``most`` components: id,
    component, n, deviation (decimal), whitened, explained, identity_error."""
    spark = df.sparkSession
    x = stage(vectors(df, id_col, vector_col), "vectors")
    id_type = df.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.DoubleType()),
                           T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    fit = components(x, most)
    if fit is None:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    with np.errstate(divide="ignore", invalid="ignore"):
        axes = np.where(fit["values"] > 0, fit["vectors"] / np.sqrt(fit["values"]), np.nan)
    some = axes[:, fit["values"] > 0]
    error = None
    if some.shape[1]:
        cov = _reduce(x.select("x").mapInArrow(_gram(share(spark, (fit["n"], fit["sums"], some))), _SUMMARY), np.add) / fit["n"]
        error = float(np.abs(cov - np.eye(some.shape[1])).max())
    sent = share(spark, (fit["n"], fit["sums"], axes, fit["explained"], error))
    return x.mapInArrow(_whiten(sent), schema).withColumnRenamed("id", id_col)
