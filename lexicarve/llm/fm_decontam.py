"""Benchmark decontamination with an FM-index per shard of the training texts.

The test phrases are the benchmark's windows of ``window`` consecutive
words (an item with fewer words is one phrase). Each task cuts its
documents into shards of bounded size and indexes every shard: words
become symbols, a suffix array (prefix doubling) gives the Burrows-Wheeler
sequence, a wavelet matrix over it answers rank queries, and every eighth
suffix position is kept. All phrases are searched backwards at once, the
occurrences are located by walking to a kept position, and overlapping
ones merge into removal spans. Nothing is shuffled.

The alphabet is the words of the phrases. Any other word ends a fragment
of the text, since no phrase can run across it; fragments shorter than the
shortest phrase hold none and are left out of the index.

The benchmark is read in blocks of bounded size (``BLOCK_BYTES`` of text).
Each is broadcast on its own and searched in a pass of its own over the
documents, so a worker holds one block, whatever the number of blocks. The
phrases of a block are numbers that overlap in one sequence.

Defined cases: null or empty texts and texts without words have no words,
no hits and are clean; an empty benchmark has no phrase; null item ids
count as the empty string; repeated documents are returned as often as
they occur, repeated items count once by id.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_size, in_arrow, shared

WINDOW = 13
SHARD_BYTES = 12 << 20  # text per index
BLOCK_BYTES = 8 << 20  # benchmark text per broadcast
SAMPLE = 8  # every so many suffix positions are kept
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # after lower-casing A-Z
_TABLE = bytes(c if c >= 0x80 or 48 <= c < 58 or 97 <= c < 123 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


class Windows:
    """Rows of equal length that overlap in one sequence, read like a matrix but held as their starts."""

    def __init__(self, seq: np.ndarray, starts: np.ndarray, length: int):
        self.seq, self.starts, self.shape = seq, starts, (len(starts), length)

    def __len__(self) -> int:
        return len(self.starts)

    def __getitem__(self, at) -> np.ndarray:
        rows, j = at
        return self.seq[self.starts[rows] + j % self.shape[1]]


class Phrases:
    """Distinct phrases of a benchmark block, about 20 bytes for each word of it beside the distinct words.

    ``groups`` has per length the phrases, and the numbers of the items of
    each: ``owners[first[p]:first[p + 1]]``.
    """

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        self.symbol: dict[bytes, int] = {}
        self.items = sorted({i for i, _ in items})
        number = {item: n for n, item in enumerate(self.items)}
        parts = [np.array([self.symbol.setdefault(w, len(self.symbol) + 1) for w in words_of(t)], np.int32) for _, t in items]
        seq = np.concatenate([*parts, np.zeros(0, np.int32)])
        size = np.array([len(p) for p in parts], np.int64)
        begin = np.cumsum(size) - size
        self.groups = []
        for n in sorted({min(int(x), window) for x in size if x}):
            own = np.flatnonzero(np.minimum(size, window) == n)
            count = size[own] - n + 1
            starts = np.repeat(begin[own] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
            owner = np.repeat(np.array([number[items[i][0]] for i in own], np.int32), count)
            _, kept, which = np.unique(np.lib.stride_tricks.sliding_window_view(seq, n)[starts], axis=0, return_index=True, return_inverse=True)
            pairs = np.unique(which.reshape(-1) * np.int64(len(self.items)) + owner)
            first = np.searchsorted(pairs, np.arange(len(kept) + 1) * np.int64(len(self.items)))
            self.groups.append((Windows(seq, starts[kept], n), first, (pairs % len(self.items)).astype(np.int32)))
        self.shortest = self.groups[0][0].shape[1] if self.groups else 0


def suffix_array(rank: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; ``rank`` orders the symbols, larger than 0."""
    n = len(rank)
    order = np.argsort(rank, kind="stable")
    k = 1
    while True:
        same = np.zeros(n, bool)
        s = rank[order]
        same[1:] = s[1:] == s[:-1]
        if not same.any():
            return order
        dense = np.cumsum(~same)
        rank = np.empty(n, np.int64)
        rank[order] = dense
        key = rank * np.int64(n + 1)
        key[:n - k] += rank[k:]
        order = np.argsort(key, kind="stable")
        rank, k = key, 2 * k


class FMIndex:
    """Backward search, rank and location over a sequence of symbols; 0 ends a fragment."""

    def __init__(self, seq: np.ndarray, sigma: int, sample: int = SAMPLE):
        n = len(seq)
        stop = seq == 0
        rank = seq + int(stop.sum())
        rank[stop] = np.arange(1, int(stop.sum()) + 1)  # ends differ, so no comparison runs past one
        sa = suffix_array(rank)
        bwt = seq[sa - 1]
        self.below = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=sigma + 1))))
        self.bits = max(1, int(sigma).bit_length())
        self.zeros, self.total = [], []
        level = bwt
        for lev in range(self.bits - 1, -1, -1):
            bit = (level >> lev) & 1
            z = np.zeros(n + 1, np.int32)
            np.cumsum(bit == 0, out=z[1:])
            self.zeros.append(z)
            self.total.append(int(z[-1]))
            level = np.concatenate((level[bit == 0], level[bit == 1]))
        # kept positions: multiples of ``sample`` and fragment starts, by row
        first = np.ones(n, bool)
        first[1:] = stop[:-1]
        keep = (sa % sample == 0) | first[sa]
        self.kept = np.concatenate(([0], np.cumsum(keep)))
        self.position = sa[keep]

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for lev, (z, t) in enumerate(zip(self.zeros, self.total)):
            one = (c >> (self.bits - 1 - lev)) & 1
            i = np.where(one == 1, t + i - z[i], z[i])
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol ``c`` occurs before row ``i`` of the transformed sequence."""
        return self._down(c, i) - self._down(c, np.zeros_like(i))

    def search(self, phrases: np.ndarray | Windows):
        """(phrase number, first row, end row) of the phrases that occur."""
        who = np.arange(len(phrases))
        lo, hi = self.below[phrases[:, -1]], self.below[phrases[:, -1] + 1]
        for j in range(phrases.shape[1] - 2, -1, -1):
            live = lo < hi
            who, lo, hi = who[live], lo[live], hi[live]
            if not len(who):
                break
            c = phrases[who, j]
            lo, hi = self.below[c] + self.rank(c, lo), self.below[c] + self.rank(c, hi)
        live = lo < hi
        return who[live], lo[live], hi[live]

    def _back(self, row: np.ndarray) -> np.ndarray:
        """Row of the suffix that starts one symbol earlier."""
        i, c = row, np.zeros_like(row)
        for z, t in zip(self.zeros, self.total):
            one = z[i + 1] == z[i]
            c = 2 * c + one
            i = np.where(one, t + i - z[i], z[i])
        return self.below[c] + i - self._down(c, np.zeros_like(row))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows), np.int64)
        todo, row, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(todo):
            hit = self.kept[row + 1] > self.kept[row]
            out[todo[hit]] = self.position[self.kept[row[hit]]] + steps
            todo, row = todo[~hit], row[~hit]
            row = self._back(row)
            steps += 1
        return out


def _occurrences(seq: np.ndarray, phrases: Phrases):
    """(word position, length, phrase numbers, first, owners) of every phrase in a shard; ``seq`` has 0 for words outside the alphabet."""
    cut = np.flatnonzero(np.diff(np.concatenate(([0], seq != 0, [0]))))
    start, end = cut[::2], cut[1::2]
    long = end - start >= phrases.shortest
    start, end = start[long], end[long]
    if not len(start):
        return
    size = end - start + 1
    head = np.concatenate(([0], np.cumsum(size)[:-1]))
    at = np.arange(int(size.sum())) - np.repeat(head - start, size)  # word position of each indexed symbol
    body = np.where(np.arange(len(at)) == np.repeat(head + size - 1, size), 0, seq[np.minimum(at, len(seq) - 1)])
    index = FMIndex(body, len(phrases.symbol))
    for windows, first, owners in phrases.groups:
        who, lo, hi = index.search(windows)
        if len(who):
            n = hi - lo
            rows = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - lo, n)
            yield at[index.locate(rows)], windows.shape[1], np.repeat(who, n), first, owners


def scan(texts: list[bytes | None], phrases: Phrases) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """One shard: per text (words, merged word ranges of the occurrences, sorted items)."""
    get, parts, found = phrases.symbol.get, [], [set() for _ in texts]
    for t in texts:
        w = words_of(t)
        parts.append(np.fromiter((get(x, 0) for x in w), np.int64, len(w)))
    size = np.array([len(p) for p in parts], np.int64)
    first = np.cumsum(size + 1) - size - 1
    seq = np.zeros(int((size + 1).sum()) + 1, np.int64)
    for a, p in zip(first.tolist(), parts):
        seq[a:a + len(p)] = p
    hits = np.zeros(len(seq) + 1, np.int64)
    if phrases.groups:
        for at, length, who, start, owners in _occurrences(seq, phrases):
            hits += np.bincount(at, minlength=len(hits)) - np.bincount(at + length, minlength=len(hits))
            doc = np.searchsorted(first, at, side="right") - 1
            for d, w in set(zip(doc.tolist(), who.tolist())):
                found[d].update(owners[start[w]:start[w + 1]].tolist())
    hit = np.cumsum(hits) > 0
    total = np.concatenate(([0], np.cumsum(hit)))
    out = []
    for i, (a, n) in enumerate(zip(first.tolist(), size.tolist())):
        ranges = []
        if total[a + n] > total[a]:
            edge = np.flatnonzero(np.diff(np.concatenate(([0], hit[a:a + n], [0]))))
            ranges = list(zip(edge[::2].tolist(), edge[1::2].tolist()))
        out.append((n, ranges, [phrases.items[x] for x in sorted(found[i])]))
    return out


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, those that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def char_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as code-point ranges of the text."""
    at = [m.span() for m in WORD.finditer(text.translate({c: c + 32 for c in range(65, 91)}))]
    return [(at[a][0], at[b - 1][1]) for a, b in ranges]


def benchmark_blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> list[DataFrame]:
    """Parts (i, t) of the benchmark, each of at most about BLOCK_BYTES of text (larger only for a larger item)."""
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"), F.col(text).cast("binary").alias("t"))
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = -(-2 * total // BLOCK_BYTES) if total > BLOCK_BYTES else 1
    return [items if n == 1 else items.where(F.pmod(F.xxhash64("i"), F.lit(n)) == k) for k in range(n)]


def _scanned(rows: DataFrame, at: int, blocks: list[DataFrame], window: int, with_spans: bool = False) -> DataFrame:
    """(row, n_words, items, hits[, spans]) of a table of one struct ``row`` whose field ``at`` is the text.

    One block is in memory at a time: each has its own pass over the rows,
    and what the passes found so far is kept beside them in the shared folder.
    """
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    pair = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    fields = [rows.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("hits", span)]
    spark, state = rows.sparkSession, rows

    def listed(ranges):
        return [{"start": a, "end": b} for a, b in ranges]

    for k, block in enumerate(blocks):
        own = [(r["i"], bytes(r["t"]) if r["t"] is not None else None) for r in block.collect()]
        sent, last = spark.sparkContext.broadcast(Phrases(own, window)), k == len(blocks) - 1

        def run(batches, sent=sent, begun=k > 0, spelled=with_spans and last):
            phrases = sent.value
            for b in batches:
                texts = b.column(0).flatten()[at].cast(pa.binary()).to_pylist()
                before = [b.column(i).to_pylist() for i in (2, 3)] if begun else None
                for r in by_size([len(t or b"") for t in texts], SHARD_BYTES):
                    found = scan([texts[i] for i in r], phrases)
                    if begun:
                        found = [(n, merged(ranges + [(x["start"], x["end"]) for x in before[1][i]]), sorted({*items, *before[0][i]}))
                                 for i, (n, ranges, items) in zip(r, found)]
                    cols = [b.column(0).slice(r.start, len(r)), pa.array([x[0] for x in found], pa.int64()),
                            pa.array([x[2] for x in found], pa.list_(pa.string())), pa.array([listed(x[1]) for x in found], pair)]
                    if spelled:
                        cols.append(pa.array([listed(char_spans(texts[i].decode(), x[1])) if x[1] else [] for i, x in zip(r, found)], pair))
                    yield pa.RecordBatch.from_arrays(cols, names=["row", "n_words", "items", "hits", "spans"][:len(cols)])

        state = in_arrow(state, run, T.StructType(fields + [T.StructField("spans", span)] * (with_spans and last)))
        if not last:
            state = shared(state, "decontam-round")
            sent.destroy()
    return state


_N_HIT = "aggregate(hits, 0L, (n, x) -> n + x.end - x.start)"


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  benchmark_text: str = "text", window: int = WINDOW, with_spans: bool = False) -> DataFrame:
    """(key, n_words, n_hit, items[, spans]) per document row.

    ``items`` are the ids of the items with occurring phrases, sorted as
    strings; ``spans`` the merged removal spans in code points.
    """
    rows = docs.select(F.struct(F.col(key).alias("k"), F.col(text).cast("binary").alias("t")).alias("row"))
    out = _scanned(rows, 1, benchmark_blocks(benchmark, item, benchmark_text), window, with_spans)
    return out.select(F.col("row.k").alias(key), "n_words", F.expr(_N_HIT).alias("n_hit"), "items", *["spans"] * with_spans)


def is_contaminated():
    """The rule: at least one word in twenty is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
          benchmark_text: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, unchanged, with all their columns. No shuffle."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    out = _scanned(rows, docs.columns.index(text), benchmark_blocks(benchmark, item, benchmark_text), window)
    return out.withColumn("n_hit", F.expr(_N_HIT)).where(~is_contaminated()).select("row.*")


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
