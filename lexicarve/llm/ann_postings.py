"""Approximate nearest neighbours by cosine with balanced posting lists.

The index: centroids of balanced hierarchical clustering, fitted on a bounded
sample of about ``SAMPLE`` vectors at most; a k-nearest-neighbour graph over the centroids,
held in memory and searched by beam; posting lists that hold every vector.
A vector near a boundary is replicated to all of its ``REPLICAS`` nearest
lists whose distance is within ``1 + BUILD_RATIO`` of the nearest. A query
finds its lists by the same graph search and keeps those within
``1 + QUERY_RATIO`` of the nearest one, ``PROBES`` at most.

Equal vectors are one entry that carries its k + 1 smallest ids, which is
all that any result can use, so a vector that a third of all rows share
costs one entry. Lists are cut into blocks of bounded rows on the side of
the vectors and of the queries, so a long list is many small groups. In a
block the cosines of all its queries are one matrix product; only the best
few leave it. The final scores are worked out again in double precision
from the original vectors, in one fixed order of summation.

Vectors that are null, zero or hold null or non-finite components take no
part, nor do rows with a null id. Vectors of another length than most are
searched exactly among themselves. A repeated row (same id and vector)
counts once. Fewer candidates than k give fewer rows; none give none.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_arrow, shared

LIST_SIZE = 128  # vectors per list aimed at
SAMPLE = 20_000
MAX_LISTS = 2500
REPLICAS = 8
BUILD_RATIO = 0.3
QUERY_RATIO = 0.3
PROBES = 96
NEIGHBOURS = 24
BLOCK = 4096
ROUNDS = 10


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first, so that very large and small components do no harm."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, always summed in the same order."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _halves(x: np.ndarray, rng) -> np.ndarray:
    """Mask of one half of the rows, cut at the median between two means."""
    two = x[rng.choice(len(x), 2, replace=False)]
    for _ in range(4):
        side = x @ (two[0] - two[1])
        one = side >= np.median(side)
        if one.all() or not one.any():
            break
        two = np.stack([x[one].mean(axis=0), x[~one].mean(axis=0)])
    order = np.argsort(x @ (two[0] - two[1]), kind="stable")
    mask = np.zeros(len(x), bool)
    mask[order[len(x) // 2:]] = True
    return mask


def balanced_centroids(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 3) -> np.ndarray:
    """Centroids of k lists of about equal length.

    Hierarchical: the longest list is halved until there are k. Rounds of
    k-means then let the lists settle; whenever one has grown to more than
    twice the mean, the shortest list is given up for its other half.
    """
    rng = np.random.default_rng(seed)
    parts, mean = [np.arange(len(x))], len(x) / k
    heap = [(-len(x), 0)]
    while len(parts) < k:
        _, i = heapq.heappop(heap)
        own = parts[i]
        one = _halves(x[own], rng)
        parts[i] = own[one]
        parts.append(own[~one])
        for j in (i, len(parts) - 1):
            heapq.heappush(heap, (-len(parts[j]), j))
    c = np.stack([x[p].mean(axis=0) for p in parts])
    for turn in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        pick = np.empty(len(x), np.int64)
        for at in range(0, len(x), 2048):
            pick[at:at + 2048] = (x[at:at + 2048] @ c.T).argmax(axis=1)
        n = np.bincount(pick, minlength=k)
        order = np.argsort(pick, kind="stable")
        start = np.cumsum(n) - n
        full = np.flatnonzero(n)
        c[full] = np.add.reduceat(x[order], start[full], axis=0) / n[full, None]
        long = [i for i in np.argsort(-n, kind="stable").tolist() if n[i] > 2 * mean]
        short = [i for i in np.argsort(n, kind="stable").tolist() if n[i] < mean / 2]
        for i, j in zip(long, short):
            own = order[start[i]:start[i] + n[i]]
            one = _halves(x[own], rng)
            c[i], c[j] = x[own[one]].mean(axis=0), x[own[~one]].mean(axis=0)
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


class Graph:
    """Centroids with their nearest neighbours and a few far links; beam search for many queries at once."""

    def __init__(self, centroids: np.ndarray, neighbours: int = NEIGHBOURS, seed: int = 5):
        self.c = np.ascontiguousarray(centroids, np.float32)
        k = len(self.c)
        rng = np.random.default_rng(seed)
        m = min(neighbours, k - 1)
        near = np.empty((k, m), np.int64)
        for at in range(0, k, 1024):
            s = self.c[at:at + 1024] @ self.c.T
            s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
            near[at:at + 1024] = np.argsort(-s, axis=1, kind="stable")[:, :m]
        far = rng.integers(0, k, (k, 4))
        self.links = np.concatenate((near, far), axis=1)
        self.entry = rng.choice(k, min(k, 32), replace=False)

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(lists, distances) of the ``width`` nearest centroids found for each unit vector, nearest first."""
        q = q.astype(np.float32)
        n, k = len(q), len(self.c)
        width = min(width, k)
        sim = np.full((n, width), -np.inf, np.float32)
        ids = np.full((n, width), -1, np.int64)
        done = np.ones((n, width), bool)
        seen = np.zeros((n, k), bool)

        def merge(rows, new, s):
            nonlocal sim, ids, done
            all_s = np.concatenate((sim[rows], s), axis=1)
            all_i = np.concatenate((ids[rows], new), axis=1)
            all_d = np.concatenate((done[rows], s == -np.inf), axis=1)
            top = np.argsort(-all_s, axis=1, kind="stable")[:, :width]
            sim[rows], ids[rows], done[rows] = (np.take_along_axis(a, top, 1) for a in (all_s, all_i, all_d))

        every = np.arange(n)
        seen[:, self.entry] = True
        merge(every, np.broadcast_to(self.entry, (n, len(self.entry))), q @ self.c[self.entry].T)
        while True:
            live = np.flatnonzero(~done.all(axis=1))
            if not len(live):
                break
            at = (~done[live]).argmax(axis=1)  # the nearest not yet expanded
            done[live, at] = True
            new = self.links[ids[live, at]]
            s = np.einsum("nd,nmd->nm", q[live], self.c[new])
            s[seen[live[:, None], new]] = -np.inf
            # a link drawn twice counts once
            order = np.argsort(new, axis=1, kind="stable")
            ranked = np.take_along_axis(new, order, 1)
            twice = np.zeros(new.shape, bool)
            np.put_along_axis(twice, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], 1)
            s[twice] = -np.inf
            seen[live[:, None], new] = True
            merge(live, new, s)
        return ids, np.sqrt(np.maximum(2 - 2 * sim, 0))

    def lists(self, q: np.ndarray, width: int, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs after distance-ratio pruning."""
        rows, out = [], []
        for at in range(0, len(q), 4096):
            ids, d = self.search(q[at:at + 4096], max(width, 2 * REPLICAS))
            ids, d = ids[:, :width], d[:, :width]
            ok = (ids >= 0) & (d <= (1 + ratio) * d[:, :1] + 1e-9)
            r, j = np.nonzero(ok)
            rows.append(r + at)
            out.append(ids[r, j])
        return np.concatenate(rows), np.concatenate(out)


def valid(vectors: DataFrame, key: str, vec: str) -> DataFrame:
    """(id, v): the vectors that take part, in double precision."""
    d = vectors.select(F.col(key).alias("id"), F.col(vec).cast("array<double>").alias("v")).where("id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return d.where(finite & F.exists("v", lambda x: x != 0))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """(cls, ids, v): distinct vectors with their k + 1 smallest ids; ``cls`` is the smallest."""
    few = rows.dropDuplicates(["id", "v"]).withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("r") <= k + 1)
    return few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("cls"), "ids", "v")


def fit(items: DataFrame, list_size: int = LIST_SIZE, sample: int = SAMPLE) -> tuple[Graph | None, int]:
    """Graph over centroids fitted on at most about ``sample`` distinct vectors, and the usual length."""
    sizes = items.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not sizes:
        return None, 0
    dim, n = sizes[0]["d"], sizes[0]["n"]
    part = F.pmod(F.xxhash64("cls", F.lit("ann")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    got = items.where((F.size("v") == dim) & (part < min(1.0, sample / n))).select("v", "cls").toArrow()
    if not got.num_rows:
        return None, dim
    x = got.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    x = unit(x[np.argsort(got.column("cls").to_numpy(), kind="stable")])
    k = max(1, min(MAX_LISTS, -(-n // list_size), max(1, len(x) // 8)))
    return (Graph(balanced_centroids(x, k)) if k > 1 else None), dim


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _postings(rows: DataFrame, graph, dim: int, width: int, ratio: float) -> DataFrame:
    """The rows once for each of their lists; vectors of another length go to a list of that length."""
    shipped = rows.sparkSession.sparkContext.broadcast(graph)  # at most MAX_LISTS centroids
    names = rows.columns
    at = names.index("v")

    def run(batches):
        g = shipped.value
        for b in batches:
            v = b.column(at)
            length = v.value_lengths().to_numpy(zero_copy_only=False)
            usual = np.flatnonzero(length == dim)
            other = np.flatnonzero(length != dim)
            pick, own = [other], [-length[other].astype(np.int64)]
            if len(usual):
                if g is None:
                    r, lst = np.arange(len(usual)), np.zeros(len(usual), np.int64)
                else:
                    r, lst = g.lists(unit(_matrix(v.take(pa.array(usual)), dim)), width, ratio)
                pick.append(usual[r])
                own.append(lst)
            pick, own = np.concatenate(pick), np.concatenate(own)
            for s in range(0, len(pick), 8192):
                yield pa.RecordBatch.from_arrays([*b.take(pa.array(pick[s:s + 8192])).columns, pa.array(own[s:s + 8192])], names=[*names, "list"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return in_arrow(rows, run, f"{kinds}, list long")


def _search_block(k: int):
    """Best k + 1 entries of a block for each of its queries."""
    schema = "q long, cls long, ids array<long>, score double"
    out = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.float64()]

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in out], names=["q", "cls", "ids", "score"])
        v, q = left.column("v").combine_chunks(), right.column("v").combine_chunks()
        dim = len(v[0])
        v, q = _matrix(v, dim), _matrix(q, dim)
        v1, q1, m = unit(v), unit(q), min(len(v), k + 1)
        hits = []
        for at in range(0, len(q), 256):
            s = q1[at:at + 256] @ v1.T
            # the product's last digits depend on its blocking: whatever ties to within rounding stays
            r, c = np.nonzero(s >= np.partition(s, s.shape[1] - m, axis=1)[:, -m][:, None] - 1e-12)
            hits.append((r + at, c))
        row, col = (np.concatenate(x) for x in zip(*hits))
        score = cosine(q[row], v[col])
        cls = left.column("cls").to_numpy()[col]
        order = np.lexsort((cls, -score, row))
        row, col, score, cls = row[order], col[order], score[order], cls[order]
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        rank = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
        ok = rank <= k
        return pa.Table.from_arrays([pa.array(right.column("cls").to_numpy()[row[ok]]), pa.array(cls[ok]),
                                     left.column("ids").combine_chunks().take(pa.array(col[ok])).cast(out[2]), pa.array(score[ok])],
                                    names=["q", "cls", "ids", "score"])
    return run, schema


def search(vectors: DataFrame, is_query, k: int = 5, key: str = "vec_id", vec: str = "embedding",
           probes: int = PROBES, query_ratio: float = QUERY_RATIO) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row for which ``is_query`` holds.

    ``is_query`` is a condition on the column ``id``; every other valid
    row is a candidate.
    """
    rows = shared(valid(vectors, key, vec), "ann-rows")
    items = shared(entries(rows, k), "ann-entries")
    graph, dim = fit(items)
    asked = rows.where(is_query).dropDuplicates(["id", "v"]).join(items.select("cls", "v"), "v").select("id", "cls")
    asked = shared(asked, "ann-asked")
    points = items.join(asked.select("cls").distinct(), "cls", "left_semi").select("cls", "v")
    lists = shared(_postings(items, graph, dim, REPLICAS, BUILD_RATIO), "ann-lists")
    probed = shared(_postings(points, graph, dim, probes, query_ratio), "ann-probes")

    def blocks(df, name):
        return df.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))

    # one row per list: MAX_LISTS and a few lengths
    shape = shared(blocks(lists, "nv").join(blocks(probed, "nq"), "list"), "ann-shape")
    cut = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = lists.join(F.broadcast(shape), "list").select("list", cut("nv").alias("bv"), spread("nq").alias("bq"), "cls", "ids", "v")
    right = probed.join(F.broadcast(shape), "list").select("list", spread("nv").alias("bv"), cut("nq").alias("bq"), "cls", "v")
    run, schema = _search_block(k)
    found = left.groupBy("list", "bv", "bq").cogroup(right.groupBy("list", "bv", "bq")).applyInArrow(run, schema)
    best = found.groupBy("q", "cls").agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
    each = best.select("q", "score", F.explode("ids").alias("id"))
    top = each.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))).where(F.col("r") <= k + 1)
    top = top.groupBy("q").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))).alias("near"))
    own = asked.join(top, asked["cls"] == top["q"]).select(F.col("id").alias("query_id"), "near")
    near = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    out = own.select("query_id", F.posexplode(near).alias("p", "x"))
    return out.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.s")).alias("score"))
