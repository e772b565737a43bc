"""Language identification with spans of mixed-language text.

A naive Bayes model over hashed character trigrams is counted with Spark
on a bounded sample of labelled rows: about ``sample_rows`` rows of each
language, taken by hash threshold (the parameter is the bound). The
counts also tell which scripts each language is written in. To label a
text, the script of each word (by code-point ranges) narrows the languages
that may claim it, the trigram log-probabilities score the word for those
languages, and a Viterbi pass with a switching penalty picks the best
language per word. The document's language owns most letters.

The Viterbi pass is exact and vectorised over blocks of words: max-plus
transfer matrices per block, a pass over the blocks of each document, and
a trace back inside all blocks at once.

Defined cases: a null text or one without letters (Unicode category L*, of
any plane; words of combining marks alone are none) is ``und`` with score 0
and no span; a text whose scripts no learned language uses gets the most
frequent learned language with score 0; without learned languages all is
``und``. Rows with a null language are never learned from. Repeated rows
are returned as often as they occur.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_size, id_mod, in_arrow, mix32

BUCKETS = 1 << 15
SAMPLE_ROWS = 1500
SWITCH = 7.0
BLOCK = 64
CHUNK_CHARS = 1 << 19
UND = "und"

# First and last code point of the main blocks of each script.
SCRIPTS = [
    ("latin", [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)]),
    ("greek", [(0x370, 0x3FF), (0x1F00, 0x1FFF)]),
    ("cyrillic", [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)]),
    ("armenian", [(0x530, 0x58F)]),
    ("hebrew", [(0x590, 0x5FF)]),
    ("arabic", [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)]),
    ("devanagari", [(0x900, 0x97F)]),
    ("bengali", [(0x980, 0x9FF)]),
    ("tamil", [(0xB80, 0xBFF)]),
    ("telugu", [(0xC00, 0xC7F)]),
    ("thai", [(0xE00, 0xE7F)]),
    ("georgian", [(0x10A0, 0x10FF)]),
    ("hangul", [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)]),
    ("kana", [(0x3040, 0x30FF), (0x31F0, 0x31FF)]),
    ("han", [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FFFF)]),
]
OTHER = len(SCRIPTS)


@functools.cache
def _char_tables():
    """For every code point: its lower-case form if it is a letter or joining mark (else 0), its script, and whether it is a letter."""
    import unicodedata

    n = 0x40000  # no plane beyond has letters
    low = np.zeros(n, np.uint32)
    letter = np.zeros(n, bool)
    for cp in range(n):
        c = chr(cp)
        letter[cp] = c.isalpha()
        if letter[cp] or unicodedata.category(c) in ("Mn", "Mc"):
            s = c.lower()
            low[cp] = ord(s) if len(s) == 1 else cp
    script = np.full(n, OTHER, np.int8)
    for k, (_, ranges) in enumerate(SCRIPTS):
        for a, b in ranges:
            script[a:b + 1] = k
    return low, script, letter


def _words(texts: list[str]):
    """Letters of all texts in one run: (folded, bucket, script, position, text index, word starts)."""
    low, script, letter = _char_tables()
    cps = np.frombuffer("\0".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    cps = np.where(cps < len(low), cps, 0)
    x = low[cps]
    pos = np.flatnonzero(x)
    if len(pos):  # marks without a letter beside them are no word
        run = np.flatnonzero(np.concatenate(([True], np.diff(pos) > 1)))
        real = np.logical_or.reduceat(letter[cps[pos]], run)
        if not real.all():
            pos = pos[np.repeat(real, np.diff(np.append(run, len(pos))))]
    if not len(pos):
        return None
    pad = np.zeros(len(x) + 2, np.uint32)
    pad[1:-1] = x
    h = pad[pos] * np.uint32(0x9E3779B1) + pad[pos + 1] * np.uint32(0x85EBCA6B) + pad[pos + 2] * np.uint32(0xC2B2AE35)
    bucket = mix32(h) & np.uint32(BUCKETS - 1)
    first = np.flatnonzero(np.concatenate(([True], np.diff(pos) > 1)))
    ends = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(ends, pos[first], side="right")
    return bucket, script[cps[pos]], pos, first, doc, ends


class Model:
    """Log-probabilities per trigram bucket and language, and the scripts each language uses."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray, rows: np.ndarray):
        self.langs = langs
        total = counts.sum(axis=0, keepdims=True)
        logp = np.log((counts + 0.3) / (total + 0.3 * counts.shape[0]))
        self.table = np.ascontiguousarray(logp - logp.max(axis=1, keepdims=True), dtype=np.float32) \
            if langs else np.zeros((BUCKETS, 0), np.float32)
        share = scripts / np.maximum(scripts.sum(axis=0, keepdims=True), 1)
        self.allowed = share > 0.01  # [script, language]
        self.usual = int(np.argmax(rows)) if langs else 0


def _segments(texts: list[str]):
    """Very long texts in pieces, cut at the last space within the limit where there is one."""
    parts, owner = [], []
    for i, t in enumerate(texts):
        at = 0
        while len(t) - at > CHUNK_CHARS:
            cut = t.rfind(" ", at + 1, at + CHUNK_CHARS)
            cut = cut if cut > at else at + CHUNK_CHARS
            parts.append((at, t[at:cut]))
            owner.append(i)
            at = cut
        parts.append((at, t[at:] if at else t))
        owner.append(i)
    return parts, owner


def word_scores(model: Model, texts: list[str]):
    """(scores [words, languages], letters, text index, start, end) over all texts, in order."""
    parts, owner = _segments(texts)
    out = []
    for r in by_size([len(p) for _, p in parts], CHUNK_CHARS):
        w = _words([parts[i][1] for i in r])
        if w is None:
            continue
        bucket, script, pos, first, doc, ends = w
        s = np.add.reduceat(model.table[bucket], first, axis=0)
        may = model.allowed[np.minimum(script[first], OTHER)]
        some = may.any(axis=1, keepdims=True)
        s = np.where(some, np.where(may, s, s.min(axis=1, keepdims=True) - 30.0), 0.0).astype(np.float32)
        last = np.concatenate((first[1:], [len(pos)]))
        base = np.concatenate(([0], ends[:-1]))
        shift = np.array([parts[i][0] for i in r])[doc] - base[doc]
        own = np.array([owner[i] for i in r])[doc]
        out.append((s, last - first, own, pos[first] + shift, pos[last - 1] + 1 + shift, some[:, 0]))
    if not out:
        return None
    return tuple(np.concatenate(x) for x in zip(*out))


def viterbi(scores: np.ndarray, doc: np.ndarray, penalty: float = SWITCH, block: int = BLOCK) -> np.ndarray:
    """Best language per word; words of one document are consecutive. Exact."""
    n, k = scores.shape
    if k == 1:
        return np.zeros(n, np.int64)
    head = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    size = np.diff(np.concatenate((head, [n])))
    nb = -(-size // block)
    b0 = np.concatenate(([0], np.cumsum(nb)))[:-1]
    total = int(nb.sum())
    within = np.arange(n) - np.repeat(head, size)
    at = np.repeat(b0, size) + within // block
    e = np.zeros((block, total, k), np.float32)  # words after a document's end score 0 for all
    e[within % block, at] = scores
    # best score of each block from each entry language to each exit language
    m = np.full((total, k, k), -np.inf, np.float32)
    d = np.arange(k)
    m[:, d, d] = e[0]
    for t in range(1, block):
        m = np.maximum(m, m.max(axis=2, keepdims=True) - penalty) + e[t][:, None, :]
    # block by block over all documents: value of each language before the block
    enter = np.zeros((total, k), np.float32)
    v = np.zeros((len(head), k), np.float32)
    order = np.argsort(-nb, kind="stable")
    deep = nb[order]
    for j in range(int(nb.max())):
        live = order[:np.searchsorted(-deep, -j, side="left")]
        b = b0[live] + j
        enter[b] = v[live]
        start = np.maximum(v[live], v[live].max(axis=1, keepdims=True) - penalty) if j else v[live]
        v[live] = (start[:, :, None] + m[b]).max(axis=1)
        v[live] -= v[live].max(axis=1, keepdims=True)
    # forward inside all blocks, with the best predecessor of a switch
    opening = np.zeros(total, bool)
    opening[b0] = True
    stay = np.empty((block, total, k), bool)
    top = np.empty((block, total), np.int16)
    f = enter
    for t in range(block):
        best = f.max(axis=1, keepdims=True)
        top[t] = f.argmax(axis=1)
        stay[t] = f >= best - penalty
        f = np.maximum(f, best - penalty) + e[t]
        if t == 0:
            f[opening] = e[0][opening]
            stay[0][opening] = True
    # where each block would start for each way to end, then the chosen ends from last block to first
    back = np.broadcast_to(d, (total, k)).copy()
    rows = np.arange(total)[:, None]
    for t in range(block - 1, -1, -1):
        back = np.where(stay[t][rows, back], back, top[t][:, None])
    end = np.zeros(total, np.int64)
    now = v.argmax(axis=1)
    for j in range(int(nb.max()) - 1, -1, -1):
        live = order[:np.searchsorted(-deep, -j, side="left")]
        b = b0[live] + j
        end[b] = now[live]
        now[live] = back[b, now[live]]
    path = np.empty((block, total), np.int64)
    one = np.arange(total)
    for t in range(block - 1, -1, -1):
        path[t] = end
        end = np.where(stay[t][one, end], end, top[t])
    return path[within % block, at]


def identify(model: Model, texts: list[str | None], penalty: float = SWITCH, with_spans: bool = False):
    """Per text: (language, score, number of spans, spans as (start, end, language) in code points)."""
    n, k = len(texts), len(model.langs)
    pred, score, spans, runs = [UND] * n, np.zeros(n), np.zeros(n, np.int64), [[] for _ in range(n)]
    w = word_scores(model, [t or "" for t in texts]) if k else None
    if w is None:
        return pred, score, spans, runs
    s, letters, doc, start, end, known = w
    path = viterbi(s, doc, penalty)
    own = np.bincount(doc * k + path, weights=letters * known, minlength=n * k).reshape(n, k)
    total = np.bincount(doc, weights=letters, minlength=n)
    mass = np.stack([np.bincount(doc, weights=s[:, j], minlength=n) for j in range(k)], axis=1)
    gap = mass - mass.max(axis=1, keepdims=True)
    post = np.exp(gap / np.sqrt(np.maximum(total, 1))[:, None])
    post /= post.sum(axis=1, keepdims=True)
    best = np.where(own == own.max(axis=1, keepdims=True), mass, -np.inf).argmax(axis=1)
    share = own[np.arange(n), best] / np.maximum(total, 1)
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (path[1:] != path[:-1])))
    spans = np.bincount(doc[new], minlength=n)
    for i in np.flatnonzero(total > 0).tolist():
        seen = own[i].any()
        pred[i] = model.langs[best[i] if seen else model.usual]
        score[i] = float(share[i] * max(post[i, best[i]], share[i] ** 2 / 2)) if seen else 0.0
    if with_spans:
        at = np.flatnonzero(new)
        stop = np.concatenate((at[1:], [len(doc)])) - 1
        for a, b in zip(at.tolist(), stop.tolist()):
            runs[doc[a]].append((int(start[a]), int(end[b]), model.langs[path[a]]))
    return pred, score, spans, runs


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on about ``sample_rows`` rows per language of ``docs`` (rows chosen by hash of the key)."""
    base = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = base.groupBy(F.col(lang).cast("string").alias("g")).agg(F.count(F.lit(1)).alias("n")) \
                .collect()  # one row per language
    langs = sorted(r["g"] for r in sizes)
    rows = {r["g"]: r["n"] for r in sizes}
    if not langs:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((OTHER + 1, 0)), np.zeros(0))
    share = F.create_map(*[F.lit(x) for g in langs for x in (g, min(1.0, sample_rows / rows[g]))])
    rank = F.create_map(*[F.lit(x) for i, g in enumerate(langs) for x in (g, i)])
    g = F.col(lang).cast("string")
    part = F.pmod(F.xxhash64(F.col(key), F.lit("langid")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = base.where(part < F.try_element_at(share, g)) \
                 .select(F.try_element_at(rank, g).cast("int").alias("l"), F.col(text).alias("t"))
    k = len(langs)

    def count(batches):
        grams = np.zeros((k, BUCKETS), np.int64)
        scripts = np.zeros((k, OTHER + 1), np.int64)
        for b in batches:
            label, texts = b.column(0).to_numpy(), b.column(1).to_pylist()
            parts, owner = _segments(texts)
            for r in by_size([len(p) for _, p in parts], CHUNK_CHARS):
                w = _words([parts[i][1] for i in r])
                if w is None:
                    continue
                bucket, script, pos, first, doc, _ = w
                cls = label[np.array([owner[i] for i in r])][np.repeat(doc, np.diff(np.append(first, len(pos))))]
                for c in np.unique(cls):
                    grams[c] += np.bincount(bucket[cls == c], minlength=BUCKETS)
                    scripts[c] += np.bincount(script[cls == c], minlength=OTHER + 1)
        both = np.concatenate((grams, scripts), axis=1)
        c, at = np.nonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(both[c, at])],
                                         names=["l", "i", "n"])

    # at most languages x (buckets + scripts) rows
    got = in_arrow(sample, count, "l int, i int, n long").groupBy("l", "i").agg(F.sum("n").alias("n")).toArrow()
    both = np.zeros((BUCKETS + OTHER + 1, k))
    both[got.column("i").to_numpy(), got.column("l").to_numpy()] = got.column("n").to_numpy()
    return Model(langs, both[:BUCKETS], both[BUCKETS:], np.array([rows[g] for g in langs]))


def label_languages(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id",
                    penalty: float = SWITCH, with_spans: bool = False) -> DataFrame:
    """(key, lang_pred, score, n_spans[, spans]) for every row; only the text decides."""
    d = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    schema = f"k {d.schema['k'].dataType.simpleString()}, lang_pred string, score double, n_spans long"
    if with_spans:
        schema += ", spans array<struct<start:int,end:int,lang:string>>"

    def run(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            for r in by_size([len(t or "") for t in texts], 2 * CHUNK_CHARS):
                pred, score, spans, runs = identify(model, [texts[i] for i in r], penalty, with_spans)
                cols = [b.column(0).slice(r.start, len(r)), pa.array(pred, pa.string()), pa.array(score), pa.array(spans.astype(np.int64))]
                names = ["k", "lang_pred", "score", "n_spans"]
                if with_spans:
                    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
                    cols.append(pa.array([[{"start": a, "end": e, "lang": g} for a, e, g in x] for x in runs], kind))
                    names.append("spans")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return in_arrow(d, run, schema).withColumnRenamed("k", key)


def keep_identified(docs: DataFrame, model: Model, min_score: float, text: str = "text") -> DataFrame:
    """Rows, with all their columns, whose language is not ``und`` and scores at least ``min_score``. No shuffle.

    Without learned languages every text has score 0 and counts as identified if it has a letter.
    """
    at, names = docs.columns.index(text), docs.columns

    def run(batches):
        for b in batches:
            texts, keep = b.column(at).to_pylist(), []
            for r in by_size([len(t or "") for t in texts], 2 * CHUNK_CHARS):
                pred, score, _, _ = identify(model, [texts[i] for i in r])
                if not model.langs:
                    pred = ["" if _words([texts[i] or ""]) else UND for i in r]
                keep += [p != UND and s >= min_score for p, s in zip(pred, score)]
            yield b.filter(pa.array(keep, pa.bool_()))

    return in_arrow(docs, run, docs.schema).select(*names)


def learnable(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows that the query may learn from; the others are held out."""
    return docs.where(id_mod(key, 3) != 1)
