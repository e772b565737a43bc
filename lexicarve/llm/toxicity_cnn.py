"""Toxicity by a convolutional text classifier.

A word's embedding is the sum of three hashed rows: the word, its first
four and its first five bytes. Filters of one, two and three words run
over the embeddings, each filter keeps its largest value over the whole
text, and a logistic unit weighs the kept values. Forward and backward
passes are written in numpy.

Training takes every labelled row. Rows are dealt by a hash of the key
into shards of about ``SHARD_ROWS`` rows and ``SHARD_BYTES`` of text. In
each of EPOCHS rounds every shard is trained once over by mini-batches from
the shared parameters, and the changes are averaged by grouped sums, a row
of the embeddings over the shards that touched it; Adagrad's sums are
averaged likewise. Changes are summed as whole numbers, so the result does
not depend on partitions. A fifth of the rows is held for calibration: a
naive Bayes head over the hashed words of all rows guesses the language
from the text alone, each language gets the threshold with the best F1 over
all held rows, whose log-odds are counted in steps of 1 / STEPS, and the
score is shifted on the log-odds scale so that 0.5 is that threshold.
Labels, language, source and id are not inputs of a score.

The driver holds the parameters and counts by hashed word and language,
never rows. The hashed words of labelled texts, compressed, are shuffled
once and written to the shared folder. Scoring is a map over the rows:
whole texts, in chunks of bounded size, no shuffle.

Defined cases: a null or empty text is scored like any other, as no words;
rows with a null label are not learned from, a repeated label counts once
(the largest); without labelled rows of both classes every score is 0;
repeated rows are returned as often as they occur.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import by_size, forget, id_mod, in_arrow, mix32

BUCKETS = 1 << 17
DIM = 16
FILTERS = 8
WIDTHS = (1, 2, 3)
PREFIXES = (4, 5)
SHARD_ROWS = 8192
SHARD_BYTES = 24 << 20
EPOCHS = 10
BATCH = 32
BATCH_WORDS = 1 << 17  # a longer text is a batch of its own and is read in pieces of this length
RATE = 0.1
CHUNK_CHARS = 1 << 20
STEPS = 1024
FIXED = float(1 << 24)  # changes of parameters are summed in this unit
MARK_BITS = 27
MIN_POSITIVES = 8  # for a threshold of a language's own
PAD = BUCKETS  # the row of zeros
GAP = max(WIDTHS)  # pads after a text; a window may begin at its words and at the first pad, so it never reaches the next text

_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = True
_LETTER[0x80:] = True
_POWER = np.cumprod(np.concatenate(([1], np.full(255, 0x01000193))).astype(np.uint32), dtype=np.uint32)


def hashed_words(texts: list[str]):
    """(rows [n, 3], first row of each text): hashed rows of every word, each text followed by pads."""
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    x = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    letter = _LETTER[x]
    pos = np.flatnonzero(letter)
    ends = np.cumsum([len(r) + 1 for r in raw])
    if len(pos):
        first = np.flatnonzero(np.concatenate(([True], np.diff(pos) > 1)))
        within = np.arange(len(pos)) - np.repeat(first, np.diff(np.append(first, len(pos))))
        part = (x[pos].astype(np.uint32) + np.uint32(1)) * _POWER[np.minimum(within, 255)]
        cols = [np.add.reduceat(part, first)]
        cols += [np.add.reduceat(np.where(within < p, part, np.uint32(0)), first) for p in PREFIXES]
        rows = np.stack([mix32(c + np.uint32(0x9E3779B1 * (i + 1) & 0xFFFFFFFF)) & np.uint32(BUCKETS - 1) for i, c in enumerate(cols)], axis=1)
        doc = np.searchsorted(ends, pos[first], side="right")
    else:
        rows, doc = np.zeros((0, 1 + len(PREFIXES)), np.uint32), np.zeros(0, np.int64)
    words = np.bincount(doc, minlength=len(texts))
    start = np.concatenate(([0], np.cumsum(words + GAP)[:-1]))
    out = np.full((int(words.sum()) + GAP * len(texts) + GAP, rows.shape[1]), PAD, np.int32)
    if len(rows):
        out[np.arange(len(rows)) - (np.cumsum(words) - words)[doc] + start[doc]] = rows
    return out, start, words


class Net:
    """Embeddings, filters and the logistic unit, with Adagrad's sums."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.e = rng.normal(0, 0.02, (BUCKETS + 1, DIM)).astype(np.float32)
        self.e[PAD] = 0
        self.k = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.b = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.v = rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
        self.c = np.zeros(1, np.float32)
        self.seen = np.full(BUCKETS + 1, 1e-2, np.float32)  # Adagrad's sums of the embeddings, one a row
        self.seen_dense = [np.full_like(p, 1e-2) for p in self.dense()]

    def dense(self) -> list[np.ndarray]:
        return [*self.k, *self.b, self.v, self.c]

    def packed(self) -> np.ndarray:
        """All parameters and sums as rows of DIM + 1: the embeddings first, then the others."""
        flat = np.concatenate([a.reshape(-1) for a in (*self.dense(), *self.seen_dense)])
        rest = np.zeros((-(-len(flat) // (DIM + 1)), DIM + 1), np.float32)
        rest.reshape(-1)[:len(flat)] = flat
        return np.concatenate((np.concatenate((self.e, self.seen[:, None]), axis=1), rest))

    def unpack(self, packed: np.ndarray) -> None:
        self.e, self.seen = packed[:BUCKETS + 1, :DIM].astype(np.float32), packed[:BUCKETS + 1, DIM].astype(np.float32)
        flat, at = packed[BUCKETS + 1:].reshape(-1), 0
        for a in (*self.dense(), *self.seen_dense):
            a[...] = flat[at:at + a.size].reshape(a.shape)
            at += a.size

    def embed(self, rows: np.ndarray) -> np.ndarray:
        x = self.e[rows[:, 0]]
        for j in range(1, rows.shape[1]):
            x += self.e[rows[:, j]]
        return x

    def convolve(self, x: np.ndarray, i: int) -> np.ndarray:
        n = len(x) - max(WIDTHS) + 1
        z = x[:n] @ self.k[i][0]
        for j in range(1, WIDTHS[i]):
            z += x[j:n + j] @ self.k[i][j]
        return z + self.b[i]

    def logits(self, rows: np.ndarray, start: np.ndarray, words: np.ndarray) -> np.ndarray:
        x, edges = self.embed(rows), np.stack((start, start + words + 1), axis=1).ravel()
        kept = [np.maximum(np.maximum.reduceat(self.convolve(x, i), edges, axis=0)[::2], 0) for i in range(len(WIDTHS))]
        return np.concatenate(kept, axis=1) @ self.v + self.c[0]

    def start_from(self, seen: np.ndarray, n: np.ndarray) -> None:
        """First dimension: smoothed log-odds of the hashed rows by class; a word-sized filter reads it.

        ``seen`` counts by class the texts that hold a hashed row, ``n`` all texts.
        """
        odds = np.log((seen[1] + 1) / (n[1] + 2)) - np.log((seen[0] + 1) / (n[0] + 2))
        odds[(seen.sum(axis=0) < 3)] = 0
        self.e[:, 0] = np.clip(odds, -4, 4) * 0.25
        self.e[PAD] = 0
        for i in range(len(WIDTHS)):
            self.k[i][0, 0, 0] = 1.0

    def peaks(self, rows: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """(per width the window [text, filter] with the largest value, those values [text, all filters])."""
        if len(size) > 1 or size[0] <= BATCH_WORDS:
            z = [self.convolve(self.embed(rows), i) for i in range(len(WIDTHS))]
            best = [np.stack([a + x[a:a + n + 1].argmax(axis=0) for a, n in zip(start, size)]) for x in z]
            return best, np.concatenate([x[w, np.arange(FILTERS)] for x, w in zip(z, best)], axis=1)
        best, top = [np.zeros((1, FILTERS), np.int64) for _ in WIDTHS], np.full((1, FILTERS * len(WIDTHS)), -np.inf, np.float32)
        for at in range(0, int(size[0]) + 1, BATCH_WORDS):
            own = min(BATCH_WORDS, int(size[0]) + 1 - at)
            where, value = self.peaks(rows[at:at + own + max(WIDTHS) - 1], np.zeros(1, np.int64), np.array([own - 1]))
            new = value > top
            for i in range(len(WIDTHS)):
                best[i] = np.where(new[:, i * FILTERS:(i + 1) * FILTERS], at + where[i], best[i])
            top = np.where(new, value, top)
        return best, top

    def epoch(self, docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray, seed) -> np.ndarray:
        """One pass over the texts by mini-batches; the embeddings' rows that it changed."""
        changed = np.zeros(BUCKETS + 1, bool)
        gap = np.full((GAP, 1 + len(PREFIXES)), PAD, np.int32)
        order = np.random.default_rng(seed).permutation(len(docs))

        def step(p, acc, g):
            acc += g * g
            p -= RATE * g / np.sqrt(acc)

        for own in batches_of(order, [len(docs[i]) for i in order]):
            rows = np.concatenate([p for i in own for p in (docs[i], gap)] + [gap])
            size = np.array([len(docs[i]) for i in own])
            start = np.cumsum(size + GAP) - size - GAP
            best, pool = self.peaks(rows, start, size)
            p = np.maximum(pool, 0)
            s = 1 / (1 + np.exp(-np.clip(p @ self.v + self.c[0], -30, 30)))
            d = ((s - y[own]) * weight[own] / len(own)).astype(np.float32)
            dp = d[:, None] * self.v * (pool > 0)
            touched, grads = [], []
            dks, dbs = [], []
            for i, w in enumerate(WIDTHS):
                g = dp[:, i * FILTERS:(i + 1) * FILTERS]
                dk = np.zeros_like(self.k[i])
                for j in range(w):
                    r = rows[(best[i] + j).ravel()]
                    dk[j] = np.einsum("nfd,nf->df", self.embed(r).reshape(len(own), FILTERS, DIM), g)
                    gx = (g[:, :, None] * self.k[i][j].T[None]).reshape(-1, DIM)
                    for c in range(r.shape[1]):
                        touched.append(r[:, c])
                        grads.append(gx)
                dks.append(dk)
                dbs.append(g.sum(axis=0))
            ids, back = np.unique(np.concatenate(touched), return_inverse=True)
            ge = np.zeros((len(ids), DIM), np.float32)
            np.add.at(ge, back, np.concatenate(grads))
            ge[ids == PAD] = 0
            self.seen[ids] += (ge * ge).sum(axis=1)
            self.e[ids] -= RATE * ge / np.sqrt(self.seen[ids])[:, None]
            changed[ids] = True
            for q, acc, g in zip(self.dense(), self.seen_dense, (*dks, *dbs, (p * d[:, None]).sum(axis=0), np.array([d.sum()], np.float32))):
                step(q, acc, g)
        return changed


def batches_of(order: np.ndarray, words: list[int]):
    """Consecutive parts of at most BATCH texts and about BATCH_WORDS words (a longer text is alone)."""
    for r in by_size(words, BATCH_WORDS):
        for at in range(r.start, r.stop, BATCH):
            yield order[at:min(at + BATCH, r.stop)]


def best_threshold(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Log-odds with the best weighted F1, half way to the next lower value."""
    order = np.argsort(-logit, kind="stable")
    z, t, w = logit[order], y[order], weight[order]
    tp, fp = np.cumsum(t * w), np.cumsum((1 - t) * w)
    f1 = 2 * tp / (tp + fp + (t * w).sum())
    f1[:-1][z[:-1] == z[1:]] = -1  # equal values go together
    i = int(f1.argmax())
    return float((z[i] + z[i + 1]) / 2) if i + 1 < len(z) else float(z[i] - 1e-3)


class Model:
    """A trained net with the language head and the thresholds; ``net`` is None without labels of both classes."""

    def __init__(self):
        self.net: Net | None = None
        self.words = np.zeros((BUCKETS + 1, 0), np.float32)  # log-probability of a hashed word by language
        self.shift = np.zeros(1, np.float32)  # threshold by guessed language, the common one last

    def language(self, rows: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Guessed language of each text, the last number without a guess."""
        k = self.words.shape[1]
        if not k:
            return np.zeros(len(start), np.int64)
        s = np.add.reduceat(self.words[rows[:, 0]], start, axis=0)
        return np.where(s.any(axis=1), s.argmax(axis=1), k)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.net is None:
            return np.zeros(len(texts))
        rows, start, words = hashed_words([t or "" for t in texts])
        z = self.net.logits(rows, start, words) - self.shift[self.language(rows, start)]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))


def _shards(batches):
    """(shard, labels, held, languages, hashed words) of each shard, its rows in an order of their own."""
    now, kept = None, []

    def done():
        kept.sort(key=lambda r: (r[0], r[4], r[1]))
        docs = [np.frombuffer(pa.decompress(w, n * 4 * (1 + len(PREFIXES)), codec="zstd", asbytes=True), np.int32).reshape(-1, 1 + len(PREFIXES))
                if n else np.zeros((0, 1 + len(PREFIXES)), np.int32) for _, _, _, _, w, n in kept]
        return now, np.array([r[1] for r in kept]), np.array([r[2] for r in kept], bool), [r[3] for r in kept], docs

    for b in batches:
        cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("h", "y", "held", "g", "w", "n", "shard")]
        for *r, shard in zip(*cols):
            if kept and shard != now:
                yield done()
                kept = []
            now = shard
            kept.append(r)
    if kept:
        yield done()


def marked(keys: DataFrame) -> np.ndarray:
    """A bit for each of 2^MARK_BITS hashes, set where ``keys`` has one: a bounded sieve that loses no key."""
    bit = F.shiftrightunsigned("h", 64 - MARK_BITS)
    bits = keys.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - MARK_BITS}) & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << (MARK_BITS - 6), np.int64)
    out[bits.column("at").to_numpy()] = bits.column("bits").to_numpy()
    return out.view(np.uint64)


def hashed_rows(docs: DataFrame, y: DataFrame, key: str, text: str, lang: str, longest: int | None = None) -> DataFrame:
    """(h, y, held, g, w, n, shard): the n hashed words w (compressed) of every labelled text, written by shard.

    Texts are sieved by the marks of the labelled keys and become hashed
    words where they are read, so only those are shuffled, once.
    """
    spark = docs.sparkSession
    size = docs.select(F.col(key).alias("k"), F.octet_length(text).alias("size")).join(y, "k").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).first()
    shards = max(1, -(-size["n"] // SHARD_ROWS), -(-(size["size"] or 0) // SHARD_BYTES))
    h = F.xxhash64(F.col("k").cast("string"), F.lit("shard"))
    shard = F.pmod("h", F.lit(shards)).cast("int").alias("shard")
    own = y.select("k", "y", h.alias("h"))
    marks = spark.sparkContext.broadcast(marked(own.select("h")))
    texts = docs.select(F.col(key).alias("k"), F.col(lang).cast("string").alias("g"), F.col(text).alias("t")).where(F.col("k").isNotNull()).select("k", "g", "t", h.alias("h"))

    def run(batches):
        for b in batches:
            bit = b.column(3).to_numpy().view(np.uint64) >> np.uint64(64 - MARK_BITS)
            on = (marks.value[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
            b = b.filter(pa.array(on))
            raw = []
            for t in b.column(2).to_pylist():
                r, _, words = hashed_words([t or ""])
                raw.append(r[:int(words[0])])
            ok = pa.array([longest is None or len(r) <= longest for r in raw], pa.bool_())
            more = [pa.array([pa.compress(r.tobytes(), codec="zstd", asbytes=True) if len(r) else b"" for r in raw], pa.binary()), pa.array([len(r) for r in raw], pa.int64())]
            yield pa.RecordBatch.from_arrays([c.filter(ok) for c in (b.column(0), b.column(1), b.column(3), *more)], names=["k", "g", "h", "w", "n"])

    words = in_arrow(texts, run, f"k {texts.schema['k'].dataType.simpleString()}, g string, h long, w binary, n long").select("*", shard)
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")  # the join keeps the partitions by shard
    held = (F.pmod(F.xxhash64("k", F.lit("calibrate")), F.lit(5)) == 0).alias("held")
    try:
        out = words.repartition("shard").join(own.select("k", "y", shard).repartition("shard"), ["shard", "k"]).select("h", "y", held, "g", "w", "n", "shard")
        path = scratch_path(spark, "toxicity-rows")
        out.write.partitionBy("shard").parquet(path)  # a file for each shard, read whole
    finally:
        spark.conf.set(name, before)
    return spark.read.schema(out.schema).parquet(path)


def word_counts(rows: DataFrame) -> DataFrame:
    """(y, g, id, n): texts to fit on that hold a hashed row, by class; words of all texts, by language."""
    def run(batches):
        classes, langs = np.zeros((2, BUCKETS + 1), np.int64), {}
        for _, y, held, names, docs in _shards(batches):
            for d, t, h, g in zip(docs, y, held, names):
                if not h:
                    classes[t][np.unique(d)] += 1
                if g is not None:
                    np.add.at(langs.setdefault(g, np.zeros(BUCKETS + 1, np.int64)), d[:, 0], 1)
        for t, g, n in [(0, None, classes[0]), (1, None, classes[1]), *((None, g, n) for g, n in langs.items())]:
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([t] * len(at), pa.int32()), pa.array([g] * len(at), pa.string()), pa.array(at), pa.array(n[at])],
                                             names=["y", "g", "id", "n"])

    return in_arrow(rows, run, "y int, g string, id long, n long").groupBy("y", "g", "id").agg(F.sum("n").alias("n"))


def train_round(rows: DataFrame, net: Net, weight: list[float], number: int) -> None:
    """Every shard trained once over from ``net``, which takes the averaged changes."""
    kept = rows.sparkSession.sparkContext.broadcast(net)
    names = [f"d{j}" for j in range(DIM + 1)]

    def run(batches):
        base = kept.value.packed()
        total, count = np.zeros(base.shape, np.int64), np.zeros(len(base), np.int64)
        own = Net()
        for shard, y, _, _, docs in _shards(batches):
            own.unpack(base)
            changed = own.epoch(docs, y.astype(np.float32), np.array(weight, np.float32)[y], (number, shard))
            at = np.concatenate((np.flatnonzero(changed), np.arange(BUCKETS + 1, len(base))))
            total[at] += np.rint((own.packed()[at].astype(np.float64) - base[at]) * FIXED).astype(np.int64)
            count[at] += 1
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at]), *(pa.array(total[at, j]) for j in range(DIM + 1))], names=["id", "n", *names])

    sums = in_arrow(rows.where("not held"), run, "id long, n long, " + ", ".join(f"{c} long" for c in names)).groupBy("id")
    got = sums.agg(*[(F.sum(c) / F.sum("n") / FIXED).cast("float").alias(c) for c in names]).toArrow()  # a row per changed row of the parameters
    rows.sparkSession._jvm.System.gc()  # drops the shuffle files of ended jobs
    packed = net.packed()
    packed[got.column("id").to_numpy()] += np.stack([got.column(c).to_numpy() for c in names], axis=1)
    net.unpack(packed)
    kept.unpersist()


def held_counts(rows: DataFrame, model: Model, only_held: bool) -> DataFrame:
    """(guess, cell, pos, neg): rows by guessed language and log-odds in steps of 1 / STEPS."""
    kept = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        gap = np.full((GAP, 1 + len(PREFIXES)), PAD, np.int32)
        for _, y, _, _, docs in _shards(batches):
            for own in batches_of(np.arange(len(docs)), [len(d) for d in docs]):
                part = np.concatenate([p for i in own for p in (docs[i], gap)] + [gap])
                size = np.array([len(docs[i]) for i in own])
                start = np.cumsum(size + GAP) - size - GAP
                _, pool = kept.value.net.peaks(part, start, size)
                z = np.clip(np.maximum(pool, 0) @ kept.value.net.v + kept.value.net.c[0], -30, 30)
                cell = np.rint(z.astype(np.float64) * STEPS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(kept.value.language(part, start)), pa.array(cell), pa.array(y[own].astype(np.int64))], names=["guess", "cell", "y"])

    each = in_arrow(rows.where("held") if only_held else rows, run, "guess long, cell long, y long")
    return each.groupBy("guess", "cell").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          label: str = "toxic", sample: int | None = None, sample_bytes: int | None = None, longest: int | None = None) -> Model:
    """Fit on every row with a label of 0 or 1.

    Only a caller who asks for less gets less: about ``sample`` rows of each
    class by hash of the key, about ``sample_bytes`` of text of each class,
    no texts of over ``longest`` words.
    """
    y = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.max(label).cast("int").alias("y"))
    share = {0: 1.0, 1: 1.0}
    if sample is not None:
        share |= {r["y"]: min(1.0, sample / r["n"]) for r in y.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    h = F.pmod(F.xxhash64("k", F.lit("toxicity")), F.lit(1 << 20)) / F.lit(float(1 << 20))

    def chosen():
        return y.where(h < F.when(F.col("y") == 1, share[1]).otherwise(share[0])) if min(share.values()) < 1 else y

    if sample_bytes is not None:
        texts = docs.select(F.col(key).alias("k"), F.octet_length(text).alias("size")).join(chosen(), "k")
        for r in texts.groupBy("y").agg(F.sum("size").alias("size")).collect():
            share[r["y"]] *= min(1.0, sample_bytes / (r["size"] or 1))
    rows = hashed_rows(docs, chosen(), key, text, lang, longest)
    model = fitted(rows, share)
    forget(rows)
    return model


def fitted(rows: DataFrame, share: dict[int, float]) -> Model:
    """The model of the hashed rows; ``share`` is what part of each class they are."""
    model = Model()
    sizes = {(r["y"], r["held"]): r["n"] for r in rows.groupBy("y", "held").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = np.array([sizes.get((t, False), 0) for t in (0, 1)])
    if not n.all():
        return model
    counts = word_counts(rows).toArrow()  # a row per hashed word and class or language
    of, names, ids, total = (counts.column(c).to_numpy(zero_copy_only=False) if c != "g" else np.array(counts.column(c).to_pylist(), object) for c in ("y", "g", "id", "n"))
    seen = np.zeros((2, BUCKETS + 1))
    for t in (0, 1):
        seen[t][ids[of == t]] = total[of == t]
    model.net = Net()
    model.net.start_from(seen, n)
    langs = sorted({g for g in names if g is not None})
    if langs:
        words = np.zeros((BUCKETS + 1, len(langs)))
        for i, g in enumerate(langs):
            words[ids[names == g], i] = total[names == g]
        logp = np.log((words + 0.1) / (words.sum(axis=0) + 0.1 * BUCKETS))
        model.words = (logp - logp.mean(axis=1, keepdims=True)).astype(np.float32)
        model.words[PAD] = 0
    # both classes count the same in training; the sampling weights only matter for the thresholds
    weight = [0.5 * float(n.sum()) / float(x) for x in n]
    for i in range(EPOCHS):
        train_round(rows, model.net, weight, i)
    cells = held_counts(rows, model, bool(sizes.get((0, True)) and sizes.get((1, True)))).toArrow()
    guess, cell, pos, neg = (cells.column(c).to_numpy() for c in ("guess", "cell", "pos", "neg"))
    pos, neg = pos / share[1], neg / share[0]

    def threshold(m):
        at, back = np.unique(cell[m], return_inverse=True)
        p, q = np.bincount(back, weights=pos[m]), np.bincount(back, weights=neg[m])
        return best_threshold(at / STEPS, p / (p + q), p + q)

    model.shift = np.full(len(langs) + 1, threshold(guess >= 0), np.float32)
    for g in range(len(langs)):
        m = guess == g
        if pos[m].sum() * share[1] >= MIN_POSITIVES and neg[m].sum() * share[0] >= MIN_POSITIVES:
            model.shift[g] = threshold(m)
    return model


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) for every row."""
    d = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of parameters

    def run(batches):
        net = shipped.value
        for b in batches:
            texts = b.column(1).to_pylist()
            for r in by_size([len(t or "") for t in texts], CHUNK_CHARS):
                s = net.scores([texts[i] for i in r])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(r.start, len(r)), pa.array(s, pa.float64())], names=["k", "score"])

    return in_arrow(d, run, f"k {d.schema['k'].dataType.simpleString()}, score double").withColumnRenamed("k", key)


def learnable(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The labels that the query may learn from; the others are held out."""
    return labels.where(id_mod(key, 5) != 0)
