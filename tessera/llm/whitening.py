"""Embedding whitening by shifted CholeskyQR.

Let A be the centred rows of the fit list. Each pass reads the fit list, takes
Q = A R1^-1 R2^-1 ... by triangular solves inside the tasks, and adds up the
Gram matrix Q'Q of all tasks in Spark; its Cholesky factor is the next R. The
first pass is shifted, so that an ill-conditioned A has a factor too; a later
pass is shifted again if its Gram matrix has none. When Q is orthonormal,
A = QR with R = Rk ... R2 R1, and the singular values and right singular
vectors of R are those of A: the variances and the whitening components, with
no loss from squaring A's condition number.

Rows never leave the tasks. The driver holds d x d matrices; d, the length of
the vectors, is bounded by ``MAX_DIMS``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import written

#: Longest vectors: a matrix of the driver then has 128 MB.
MAX_DIMS = 4096
#: Passes at most; three do unless A is numerically rank-deficient.
MAX_PASSES = 8
#: Q counts as orthonormal when no entry of Q'Q - I is larger; one more factor then squares the error.
ORTHONORMAL = 1e-9
#: Components with less than this share of the largest variance are rounding, not components.
LEAST_SHARE = 1e-13
#: Rows whose matrices a task holds at a time.
BLOCK = 4096


def entries(vector: str | Column, scale: int = 256) -> Column:
    """floor(scale * c) of every entry as long; null for a vector that is null or holds a null or non-finite entry."""
    v = F.transform(vector, lambda c: c.cast("double"))
    finite = F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    return F.when(finite, F.transform(v, lambda c: F.floor(c * scale).cast("long")))


def _blocks(batches, dims: int):
    """Each Arrow batch with its vectors as matrices of at most ``BLOCK`` rows."""
    for b in batches:
        for lo in range(0, b.num_rows, BLOCK):
            part = b.slice(lo, BLOCK)
            x = part.column("x")
            yield part, np.asarray(x.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(part.num_rows, dims)


def solve_upper(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """rows @ inv(r) for an upper triangular r, by forward substitution over the columns."""
    out = np.empty_like(rows)
    for j in range(r.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


@dataclass
class Centre:
    """n vectors with the sums S of their entries: what centres a row without rounding of large means."""

    n: int
    sums: list[int]

    def rows(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: first the whole part of the mean in integers, then its fraction."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """sum of (n*x - S)^2 of every row, exact; None where it is beyond 64 bits."""
        with np.errstate(over="ignore"):  # arithmetic modulo 2^64 is exact for results below 2^63
            s = np.array([v & (1 << 64) - 1 for v in self.sums], np.uint64)
            d = x.view(np.uint64) * np.uint64(self.n & (1 << 64) - 1) - s
            exact = (d * d).sum(axis=1, dtype=np.uint64)
        near = ((self.rows(x) * self.n) ** 2).sum(axis=1) / 2.0**63
        out = []
        for value, share, row in zip(exact.tolist(), near.tolist(), x):
            if abs(share - 1) < 1e-6:
                value = sum((self.n * v - s) ** 2 for v, s in zip(row.tolist(), self.sums))
                share = value / 2**63 if value < 2**63 else 2.0
            out.append(value if share < 1 else None)
        return out


def centre(fit: DataFrame, dims: int) -> Centre:
    """Count and exact sums of the fit list."""
    def run(batches):
        n, total = 0, [0] * dims
        for _, x in _blocks(batches, dims):
            wide = len(x) and int(max(abs(int(x.min())), abs(int(x.max())))) > 1 << 48
            part = x.astype(object).sum(axis=0) if wide else x.sum(axis=0)
            n, total = n + len(x), [t + int(p) for t, p in zip(total, part)]
        if n:
            yield pa.RecordBatch.from_pydict({"j": pa.array(range(-1, dims), pa.int32()), "v": [str(v) for v in (n, *total)]})

    parts = fit.mapInArrow(run, "j int, v string").groupBy("j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    found = {r.j: int(r.v) for r in parts.collect()}  # dims + 1 rows
    return Centre(found.get(-1, 0), [found.get(j, 0) for j in range(dims)])


def gram(fit: DataFrame, mid: Centre, dims: int, project) -> np.ndarray:
    """Q'Q over the fit list, Q = project(centred rows); the tasks' matrices are added up in Spark by entry."""
    def run(batches):
        total = None
        for _, x in _blocks(batches, dims):
            q = project(mid.rows(x))
            total = q.T @ q if total is None else total + q.T @ q
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "v": total[i, j]})

    sums = fit.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    i, j, v = (sums.column(c).to_numpy() for c in "ijv")
    size = int(i.max()) + 1 if len(i) else 0
    out = np.zeros((size, size))
    out[i, j] = out[j, i] = v
    return out


@dataclass
class Whitening:
    """Unit ``components`` (columns), their variances, the share of all variance, and the measured error."""

    mid: Centre
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def project(self, centred: np.ndarray) -> np.ndarray:
        return centred @ self.components / np.sqrt(self.variances)


def fit_whitening(fit: DataFrame, dims: int, k: int) -> Whitening:
    """The first ``k`` whitening components of the distinct vectors ``x`` (a written table)."""
    mid = centre(fit, dims) if dims else Centre(0, [])
    empty = Whitening(mid, np.zeros((dims, 0)), np.zeros(0), np.zeros(0))
    if not mid.n:
        return empty
    first = gram(fit, mid, dims, lambda a: a)
    trace = float(np.trace(first))
    live = np.flatnonzero(np.diag(first) > 0)  # a constant dimension has no variance and no factor
    if not len(live):
        return empty
    size = len(live)
    shift = 11 * (mid.n * size + size * (size + 1)) * np.finfo(float).eps / 2
    g, factors = first[np.ix_(live, live)], []
    scale, done = trace, False
    for step in range(MAX_PASSES):
        try:
            if step == 0:
                raise np.linalg.LinAlgError
            r = np.linalg.cholesky(g).T
        except np.linalg.LinAlgError:
            r = np.linalg.cholesky(g + shift * scale * np.eye(size)).T
        else:
            done = np.abs(g - np.eye(size)).max() <= ORTHONORMAL
        factors.append(r)
        if done:
            break

        def project(a, factors=tuple(factors)):
            q = a[:, live]
            for f in factors:
                q = solve_upper(q, f)
            return q
        g, scale = gram(fit, mid, dims, project), 1.0
    if not done:  # A is rank-deficient: the root of the last Gram matrix takes the place of its factor
        values, vectors = np.linalg.eigh(g)
        factors.append(np.sqrt(np.maximum(values, 0))[:, None] * vectors.T)
    r = factors[0]
    for f in factors[1:]:
        r = f @ r
    _, s, w = np.linalg.svd(r)
    e = s * s / mid.n
    keep = np.flatnonzero(e > e[0] * LEAST_SHARE)[:k]
    components = np.zeros((dims, len(keep)))
    components[live] = w[keep].T
    components *= np.where(components[np.abs(components).argmax(axis=0), np.arange(len(keep))] < 0, -1.0, 1.0)
    model = Whitening(mid, components, e[keep], e[keep] / (trace / mid.n))
    cov = gram(fit, mid, dims, model.project) / mid.n
    model.identity_error = float(np.abs(cov - np.eye(len(keep))).max())
    return model


def whiten(vectors: DataFrame, k: int = 4, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """One row per vector and component: key, component, n, deviation, whitened, explained, identity_error.

    Entries become x = floor(scale * c); the fit list is each distinct x once.
    Defined cases: vectors that are null or hold a null or non-finite entry are
    left out; entries beyond 64 bits are held at its ends; if lengths differ,
    vectors of another length than the commonest (the longest of those, on a
    tie) are left out, as they have no covariance with the others; an empty
    table, vectors without entries, or a fit list without variance have no
    components and give no rows; there are fewer than ``k`` components if the
    rank is less. ``deviation`` is null where it is beyond 64 bits. Rows that
    repeat, and null keys, give their rows each time; other columns are not read.
    """
    rows = vectors.select(F.col(key).alias("key"), entries(vector, scale).alias("x")).where("x IS NOT NULL")
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dims = common.d if common else 0
    if dims > MAX_DIMS:
        raise ValueError(f"vectors of {dims} entries; at most {MAX_DIMS} are supported")
    rows = rows.where(F.size("x") == dims)
    model = fit_whitening(written(rows.select("x").distinct(), "fit-list"), dims, k)
    kind = vectors.schema[key].dataType

    def run(batches):
        for part, x in _blocks(batches, dims):
            y = model.project(model.mid.rows(x))
            c = y.shape[1]
            if not c:
                continue
            at = np.repeat(np.arange(len(x)), c)
            yield pa.RecordBatch.from_arrays([
                part.column("key").take(pa.array(at)), pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(at), model.mid.n, np.int64)), pa.array(model.mid.deviations(x), pa.int64()).take(pa.array(at)),
                pa.array(y.ravel()), pa.array(np.tile(model.explained, len(x))),
                pa.array(np.full(len(at), model.identity_error))],
                names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    schema = T.StructType([T.StructField(key, kind), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                           T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    return rows.mapInArrow(run, schema)
