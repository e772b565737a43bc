"""Embedding whitening by weighted multiplicity covariance.

Every entry c becomes the integer x = floor(64 * c) + 1000000. Equal
x-vectors are grouped, so sums, covariance and projection touch each
distinct vector once, with its count (``weight="count"``) or one
(``weight="one"``, the fit list of distinct vectors) as its fit weight.
The covariance is a weighted GEMM of centred vectors: a task centres its
vectors at the rounded mean and multiplies them in exact integer blocks,
blocks are summed as decimals, and the rank-one term of the mean's
fraction (at most half a unit a dimension) is taken off in exact integers.
So the covariance does not depend on partitions or retries. Each distinct
vector is whitened once, and the result is joined back to the rows.

Scale: vectors travel as bytes, entries in the least of 1, 2, 4 or 8 bytes
that holds the vector (that form is canonical, so grouping by it is exact).
Grouping combines map-side; the join back is on two plain tables, so a
vector that a third of the rows share is split by AQE. The driver gets one
row of sums per dimension and one row of products per pair of dimensions.

Defined cases: vectors that are null or hold null or non-finite entries
are dropped; an empty vector has no component; vectors of another length
are a fit list of their own; x is held within 2^61 of zero; only
components of positive variance (above 1e-13 of the largest) are returned,
so a table of equal vectors gives no rows; repeated rows and rows with a
null or repeated id are returned as often as they occur; a deviation
beyond 64 bits is null; other columns are ignored.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, shared

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
LIMIT = 1 << 61
_BLOCK = 4096
_KINDS = [np.int8, np.int16, np.int32, np.int64]
_EXACT = 1 << 53


def pack(vector: np.ndarray) -> bytes:
    """Entries x - SHIFT in the least width that holds them all, after a byte that names the width."""
    y = np.clip(np.floor(vector * float(SCALE)), -LIMIT, LIMIT).astype(np.int64)
    low, high = int(y.min()), int(y.max())
    w = next(i for i, k in enumerate(_KINDS) if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return bytes([w]) + y.astype(_KINDS[w]).tobytes()


def unpack(packed: list[bytes], size: int) -> np.ndarray:
    """Rows of x - SHIFT as int64."""
    out = np.empty((len(packed), size), np.int64)
    for i, p in enumerate(packed):
        out[i] = np.frombuffer(p, _KINDS[p[0]], size, 1)
    return out


def quantised(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, size, p): the packed x-vector of every row that takes part."""
    d = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    d = d.where(F.col("v").isNotNull() & F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))))

    def run(batches):
        for b in batches:
            col = b.column(1)
            flat, ends = col.flatten().to_numpy(zero_copy_only=False), np.cumsum(col.value_lengths().to_numpy(zero_copy_only=False))
            sizes = np.diff(np.concatenate(([0], ends)))
            p = [pack(flat[e - n:e]) if n else None for n, e in zip(sizes.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int32()), pa.array(p, pa.binary())], names=["id", "size", "p"])

    kind = d.schema["id"].dataType.simpleString()
    return in_arrow(d, run, f"id {kind}, size int, p binary").where("size > 0")


def distinct_vectors(rows: DataFrame, weight: str = "one") -> DataFrame:
    """(size, p, w): each distinct vector once, with its fit weight."""
    if weight not in ("one", "count"):
        raise ValueError("weight is 'one' or 'count'")
    w = F.count(F.lit(1)) if weight == "count" else F.lit(1).cast("long")
    return rows.groupBy("size", "p").agg(w.alias("w"))


def _blocks(batches, size: int):
    for b in batches:
        packed, w = b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False)
        for at in range(0, len(packed), _BLOCK):
            yield packed[at:at + _BLOCK], unpack(packed[at:at + _BLOCK], size), w[at:at + _BLOCK]


def _emit_cells(total: np.ndarray, rows: int):
    """Non-zero cells of an object array of Python ints, as strings of decimals."""
    flat = total.reshape(-1)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows), pa.int64()), pa.array([str(v) for v in flat.tolist()], pa.string())], names=["cell", "v"])


def _summed(vectors: DataFrame, run) -> np.ndarray:
    """Cells that tasks emit, summed exactly; the driver gets one row per cell."""
    got = in_arrow(vectors, run, "cell long, v string").groupBy("cell").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    out = got.collect()  # bounded: one row per (pair of) dimension
    cells = np.zeros(1 + max((r["cell"] for r in out), default=-1), object)
    for r in out:
        cells[r["cell"]] = int(r["v"])
    return cells


def column_sums(vectors: DataFrame, size: int) -> np.ndarray:
    """Python ints: the weight of all vectors, then the weighted sum of x - SHIFT per dimension."""
    def run(batches):
        total = np.zeros(size + 1, object)
        for _, y, w in _blocks(batches, size):
            exact = float(np.abs(y).max(initial=0)) * float(w.sum()) < _EXACT
            total[1:] += (w @ y if exact else w.astype(object) @ y.astype(object)).astype(object)
            total[0] += int(w.sum())
        yield from _emit_cells(total, size + 1)

    return _summed(vectors, run)


def products(vectors: DataFrame, centre: np.ndarray) -> np.ndarray:
    """Exact weighted sum of c * c^T, c = x - SHIFT - centre (Python ints)."""
    size = len(centre)
    at = np.array(centre, np.int64)

    def run(batches):
        total = np.zeros((size, size), object)
        held, room = np.zeros((size, size), np.int64), 0.0
        for _, y, w in _blocks(batches, size):
            far = max((abs(int(v)) for v in (y.max(axis=0) - at).tolist() + (y.min(axis=0) - at).tolist()), default=0)
            bound = float(far) ** 2 * float(w.sum())
            if bound < _EXACT:  # float GEMM of integers is exact below 2^53
                c = (y - at).astype(np.float64)
                held += ((c * w[:, None]).T @ c).astype(np.int64)
                room += bound
                if room > 2.0 ** 62:
                    total, held, room = total + held, np.zeros_like(held), 0.0
            else:
                c = y.astype(object) - at.astype(object)
                total += (c * w.astype(object)[:, None]).T @ c
        yield from _emit_cells(total + held, size * size)

    return _summed(vectors, run).reshape(size, size)


class Whitening:
    """Mean and components of one fit list."""

    def __init__(self, n: int, sums: np.ndarray, centre: np.ndarray, cells: np.ndarray, components: int):
        self.n, self.size = n, len(sums)
        self.sums = [int(s) for s in sums]  # of x - SHIFT
        rest = [s - n * int(c) for s, c in zip(sums, centre)]
        # n^2 times the covariance, in integers
        v = [[float(Fraction(n * int(cells[i, j]) - rest[i] * rest[j], n * n)) for j in range(self.size)] for i in range(self.size)]
        e, u = np.linalg.eigh(np.array(v))
        e, u = e[::-1], u[:, ::-1]
        k = min(components, int((e > 1e-13 * max(float(e[0]), 1e-300)).sum()))
        u = u[:, :k]
        u = u * np.where(u[np.abs(u).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
        trace = float(sum(Fraction(n * int(cells[i, i]) - rest[i] * rest[i], n * n) for i in range(self.size)))
        self.variance, self.k = e[:k], k
        self.basis = u / np.sqrt(e[:k]) if k else u
        self.explained = (e[:k] / trace).tolist() if k else []
        self.centre = np.array([int(c) for c in centre], np.int64)
        self.shift = np.array([float(Fraction(r, n)) for r in rest])  # mean minus centre

    def whiten(self, y: np.ndarray) -> np.ndarray:
        c = (y - self.centre).astype(np.float64) - self.shift
        return c @ self.basis

    def deviation(self, y: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S)^2, exact, None beyond 64 bits."""
        reach = self.n * int(np.abs(y).max(initial=0)) + max((abs(s) for s in self.sums), default=0)
        if reach * reach * self.size < 1 << 62:
            g = self.n * y - np.array(self.sums, np.int64)
            return (g * g).sum(axis=1).tolist()
        g = (self.n * y.astype(object) - np.array(self.sums, object)) ** 2
        return [v if v < 1 << 63 else None for v in g.sum(axis=1).tolist()]


def fit(vectors: DataFrame, size: int, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the distinct vectors ``(p, w)`` of one length; None without vectors."""
    sums = column_sums(vectors, size)
    n = int(sums[0]) if len(sums) else 0
    if not n:
        return None
    centre = np.array([(2 * int(s) + n) // (2 * n) for s in sums[1:]], object)
    return Whitening(n, sums[1:], centre, products(vectors, centre), components)


def transform(vectors: DataFrame, model: Whitening) -> DataFrame:
    """(p, w, deviation, z): each distinct vector whitened once."""
    def run(batches):
        for b in batches:
            for packed, y, w in _blocks([b], model.size):
                z = model.whiten(y)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(packed) + 1) * model.k, pa.int32()), pa.array(z.reshape(-1)))
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), pa.array(w, pa.int64()),
                                                  pa.array(model.deviation(y), pa.int64()), flat], names=["p", "w", "deviation", "z"])

    return in_arrow(vectors, run, "p binary, w long, deviation long, z array<double>")


def identity_error(white: DataFrame, k: int) -> float:
    """Largest absolute entry of the weighted covariance of ``z`` minus the identity."""
    def run(batches):
        total = np.zeros((k + 1, k + 1))
        for b in batches:
            w = b.column(0).to_numpy(zero_copy_only=False).astype(np.float64)
            z = np.ones((len(w), k + 1))
            z[:, :k] = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            total += (z * w[:, None]).T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.arange((k + 1) ** 2), pa.int64()), pa.array(total.reshape(-1))], names=["cell", "v"])

    got = in_arrow(white.select("w", "z"), run, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    m = np.zeros((k + 1) ** 2)
    for r in got:
        m[r["cell"]] = r["v"]
    m = m.reshape(k + 1, k + 1) / m[-1]
    return float(np.abs(m[:k, :k] - np.outer(m[k, :k], m[k, :k]) - np.eye(k)).max())


def whitened(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
             weight: str = "one") -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) per row and component."""
    distinct = shared(distinct_vectors(quantised(df, key, vector), weight), "whiten-distinct")
    rows = quantised(df, key, vector)
    sizes = sorted(r["size"] for r in distinct.select("size").distinct().collect())
    kind = rows.schema["id"].dataType.simpleString()
    out = None
    for size in sizes:
        own = distinct.where(F.col("size") == size).select("p", "w")
        model = fit(own, size, components)
        if not model or not model.k:
            continue
        white = shared(transform(own, model), "whiten-vectors")
        error = identity_error(white, model.k)
        part = (rows.where(F.col("size") == size).select("id", "p").join(white.select("p", "deviation", "z"), "p")
                    .select("id", "deviation", F.posexplode("z").alias("i", "whitened"))
                    .select(F.col("id").alias(key), (F.col("i") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                            F.element_at(F.array(*[F.lit(x) for x in model.explained]), F.col("i") + 1).alias("explained"),
                            F.lit(error).alias("identity_error")))
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = df.sparkSession.createDataFrame([], f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return out
