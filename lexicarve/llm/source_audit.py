"""Source divergence audit over a vocabulary held as minimal acyclic transducers.

Which sources of a language use its words unlike each other, and which
words set a source apart? A language keeps the terms of at least
``min_docs`` documents. The kept terms, sorted by UTF-8 bytes, are built
into minimal acyclic transducers: a path spells a term, and the outputs on
its arcs add up to the term's lexicographic ordinal. The texts are then
streamed through them to be counted again, as (language, source, ordinal);
all later work is on ordinals, which also break ties, and the few terms of
the report are read back out of the transducers.

With add-two smoothing, a group's p of a term is 1 + floor(10^9 * (count +
2) / (N + 2 * V)). Two groups differ in a term by floor((p - q)^2 / (p +
q)). All arithmetic is on integers.

Scale: terms are pre-aggregated in the task that reads them, in tables of
at most ``HELD`` entries. The vocabulary is range-partitioned and cut into
transducers of at most ``BLOCK_TERMS`` terms and ``BLOCK_BYTES`` bytes of
terms. Texts are read once for every ``PASS_BYTES`` of transducers, so what
is broadcast is bounded whatever the vocabulary's size. Source pairs are
summed by (language, 4096 ordinals, pair of blocks of 256 sources) and then
over the ordinals, so neither a hot language nor a hot source is one task.

Defined cases: null text, language or source count as the empty string; a
group without kept terms has N = 0 and takes part; a language without kept
terms has pairs of value 0 and no terms; repeated rows count as often as
they occur; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import struct
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_arrow, shared

MIN_DOCS = 10
TOP = 10
HELD = 1 << 19
BLOCK_TERMS = 1 << 16
BLOCK_BYTES = 8 << 20
PASS_BYTES = 48 << 20
CHUNK = 4096
TILE = 256
UNIT = 1_000_000_000
PIECE = 4 << 20
# A-Z to a-z; letters and bytes of other scripts stay, all else becomes a blank
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def term_lists(text: bytes):
    """The terms of a text in lists; long texts in pieces cut between terms."""
    text = text.translate(_FOLD)
    at = 0
    while len(text) - at > PIECE:
        cut = text.find(b" ", at + PIECE)
        if cut < 0:
            break
        yield text[at:cut].split()
        at = cut
    yield (text[at:] if at else text).split()


class Transducer:
    """Minimal acyclic transducer from terms to their ranks in byte order.

    Arcs of a state are consecutive and sorted by label. An arc's output is
    how many terms through its state come before those through the arc.
    """

    def __init__(self, first, label, target, output, final):
        self.first, self.label, self.target, self.output, self.final = first, label, target, output, final
        state = np.repeat(np.arange(len(final), dtype=np.int64), np.diff(first))
        self.keys = state * 256 + label

    @classmethod
    def build(cls, terms: list[bytes]) -> Transducer:
        """From strictly increasing terms; equal suffixes become one state as soon as a term leaves them."""
        known: dict[tuple, int] = {}
        states: list[tuple] = []  # (final, ((label, target), ...)) of the states that are settled
        path: list[list] = [[False, []]]  # states along the last term: [final, arcs], the last arc still open
        last = b""

        def settle(depth: int):
            while len(path) > depth + 1:
                end, arcs = path.pop()
                shape = (end, tuple(arcs))
                at = known.setdefault(shape, len(states))
                if at == len(states):
                    states.append(shape)
                path[-1][1].append((last[len(path) - 1], at))

        for t in terms:
            n = 0
            m = min(len(t), len(last))
            while n < m and t[n] == last[n]:
                n += 1
            settle(n)
            path.extend([False, []] for _ in range(len(t) - n))
            path[-1][0] = True
            last = t
        settle(0)
        states.append((path[0][0], tuple(path[0][1])))
        # targets are settled before their sources, so counts follow in one sweep; the start is state 0
        states.reverse()
        top = len(states) - 1
        count = np.zeros(len(states), np.int64)
        first = np.zeros(len(states) + 1, np.int32)
        for i in range(top, -1, -1):
            end, arcs = states[i]
            count[i] = end + sum(int(count[top - t]) for _, t in arcs)
        label, target, output = [], [], []
        for i, (end, arcs) in enumerate(states):
            before = int(end)
            for c, t in arcs:
                label.append(c)
                target.append(top - t)
                output.append(before)
                before += int(count[top - t])
            first[i + 1] = len(label)
        return cls(first, np.array(label, np.uint8), np.array(target, np.int32), np.array(output, np.int32),
                   np.array([s[0] for s in states], bool))

    def dump(self) -> bytes:
        return struct.pack("<II", len(self.final), len(self.label)) + b"".join(
            a.tobytes() for a in (self.first, self.label, self.target, self.output, self.final))

    @classmethod
    def load(cls, raw: bytes) -> Transducer:
        states, arcs = struct.unpack_from("<II", raw)
        at, out = 8, []
        for kind, n in ((np.int32, states + 1), (np.uint8, arcs), (np.int32, arcs), (np.int32, arcs), (bool, states)):
            out.append(np.frombuffer(raw, kind, n, at))
            at += out[-1].nbytes
        return cls(*out)

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """Rank of each word, -1 where it is no term: all words step through the arcs together."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(size) - size
        out = np.full(len(words), -1, np.int64)
        live = np.arange(len(words))
        state, total, step = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), 0
        while len(live):
            done = size[live] == step
            if done.any():
                end = live[done]
                out[end] = np.where(self.final[state[done]], total[done], -1)
                live, state, total = live[~done], state[~done], total[~done]
            if not len(live) or not len(self.keys):
                break
            want = state * 256 + flat[start[live] + step]
            arc = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            on = self.keys[arc] == want
            live, arc = live[on], arc[on]
            state, total = self.target[arc].astype(np.int64), total[on] + self.output[arc]
            step += 1
        return out

    def term(self, rank: int) -> bytes:
        """The term of a rank."""
        state, out = 0, bytearray()
        while True:
            a, b = int(self.first[state]), int(self.first[state + 1])
            if self.final[state] and rank == 0:
                return bytes(out)
            arc = a + int(np.searchsorted(self.output[a:b], rank, side="right")) - 1
            out.append(int(self.label[arc]))
            rank -= int(self.output[arc])
            state = int(self.target[arc])


def _rows(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(one(lang).alias("lang"), one(source).alias("source"), one(text).cast("binary").alias("t"))


def document_frequency(rows: DataFrame) -> DataFrame:
    """(lang, term, docs): in how many rows of a language each term occurs."""
    def run(batches):
        held: dict[str, Counter] = {}

        def emit():
            for lang, c in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.binary()).cast(pa.string()),
                                                  pa.array(list(c.values()), pa.int64())], names=["lang", "term", "docs"])
            held.clear()

        for b in batches:
            for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen: set = set()
                for words in term_lists(t):
                    seen.update(words)
                held.setdefault(lang, Counter()).update(seen)
                if sum(map(len, held.values())) > HELD:
                    yield from emit()
        yield from emit()

    each = in_arrow(rows.select("lang", "t"), run, "lang string, term string, docs long")
    return each.groupBy("lang", "term").agg(F.sum("docs").alias("docs"))


def transducers(kept: DataFrame) -> DataFrame:
    """(lang, first, n, fst): transducers over consecutive kept terms; ``first`` is a block's least term."""
    parts = max(1, -(-kept.count() // BLOCK_TERMS))
    ordered = kept.select("lang", F.col("term").cast("binary").alias("term")) \
                  .repartitionByRange(parts, "lang", "term").sortWithinPartitions("lang", "term")

    def run(batches):
        lang, terms, size = None, [], 0

        def close():
            return pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([terms[0]], pa.binary()), pa.array([len(terms)], pa.int64()),
                                               pa.array([Transducer.build(terms).dump()], pa.binary())], names=["lang", "first", "n", "fst"])

        for b in batches:
            for own, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if terms and (own != lang or len(terms) == BLOCK_TERMS or size > BLOCK_BYTES):
                    yield close()
                    terms, size = [], 0
                lang = own
                terms.append(t)
                size += len(t)
        if terms:
            yield close()

    return in_arrow(ordered, run, "lang string, first binary, n long, fst binary")


class Vocabulary:
    """Transducers of all languages, written to the shared folder, and what names them."""

    def __init__(self, kept: DataFrame):
        self.blocks = shared(transducers(kept), "audit-transducers")
        # one short row per BLOCK_TERMS terms
        meta = self.blocks.select("lang", "first", "n", F.octet_length("fst").alias("size")).collect()
        self.meta, at = [], Counter()
        for r in sorted(meta, key=lambda r: (r["lang"], bytes(r["first"]))):
            self.meta.append((r["lang"], bytes(r["first"]), at[r["lang"]], r["n"], r["size"]))
            at[r["lang"]] += r["n"]
        self.sizes = dict(at)

    def passes(self, limit: int = PASS_BYTES):
        """Runs of consecutive blocks of at most ``limit`` bytes (one block at least)."""
        run, size = [], 0
        for m in self.meta:
            if run and size + m[4] > limit:
                yield run
                run, size = [], 0
            run.append(m)
            size += m[4]
        if run:
            yield run

    def named(self, run):
        spark = self.blocks.sparkSession
        return spark.createDataFrame([(m[0], bytearray(m[1]), m[2], m[3]) for m in run], "lang string, first binary, base long, n long")


def _walk(found: dict[str, tuple], lang: str, words: list[bytes]) -> np.ndarray:
    """Ordinals of words of a language, -1 for others."""
    firsts, machines, bases = found[lang]
    out = np.full(len(words), -1, np.int64)
    if len(firsts) == 1:
        r = machines[0].ranks(words)
        return np.where(r >= 0, r + bases[0], -1)
    at = np.fromiter((bisect.bisect_right(firsts, w) - 1 for w in words), np.int64, len(words))
    for b in np.unique(at[at >= 0]).tolist():
        pick = np.flatnonzero(at == b)
        r = machines[b].ranks([words[i] for i in pick.tolist()])
        out[pick] = np.where(r >= 0, r + bases[b], -1)
    return out


def recount(rows: DataFrame, vocabulary: Vocabulary, limit: int = PASS_BYTES) -> DataFrame:
    """(lang, source, ord, n): texts streamed through the transducers, in passes of bounded size."""
    sc, out = rows.sparkSession.sparkContext, None
    for run_of in vocabulary.passes(limit):
        raw = vocabulary.blocks.join(F.broadcast(vocabulary.named(run_of).select("lang", "first", "base")), ["lang", "first"]).collect()
        machines = sc.broadcast(sorted((r["lang"], bytes(r["first"]), r["base"], bytes(r["fst"])) for r in raw))

        def run(batches, machines=machines):
            found: dict[str, tuple] = {}
            for lang, first, base, fst in machines.value:
                one = found.setdefault(lang, ([], [], []))
                for a, v in zip(one, (first, Transducer.load(fst), base)):
                    a.append(v)
            held: dict[tuple, Counter] = {}

            def emit():
                for (lang, source), c in held.items():
                    words = list(c)
                    ord_ = _walk(found, lang, words)
                    on = ord_ >= 0
                    n = np.fromiter(c.values(), np.int64, len(words))[on]
                    k = len(n)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * k, pa.string()), pa.array([source] * k, pa.string()),
                                                      pa.array(ord_[on]), pa.array(n)], names=["lang", "source", "ord", "n"])
                held.clear()

            for b in batches:
                for lang, source, t in zip(*(b.column(i).to_pylist() for i in range(3))):
                    if lang not in found:
                        continue
                    c = held.setdefault((lang, source), Counter())
                    for words in term_lists(t):
                        c.update(words)
                    if sum(map(len, held.values())) > HELD:
                        yield from emit()
            yield from emit()

        each = in_arrow(rows, run, "lang string, source string, ord long, n long")
        part = shared(each.groupBy("lang", "source", "ord").agg(F.sum("n").alias("n")), "audit-counts")
        machines.unpersist()
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = rows.sparkSession.createDataFrame([], "lang string, source string, ord long, n long")
    return out


def _div(a: Column, b: Column) -> Column:
    """Integer quotient; null where b is 0."""
    return F.when(b != 0, F.call_function("div", a, b))


def probability(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 * (n + 2) / (total + 2 * terms)), in integers."""
    wide = "decimal(19,0)"
    return _div(F.lit(UNIT).cast("decimal(10,0)") * (n + 2).cast(wide), (total + 2 * terms).cast(wide)) + 1


def divergence(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def _tiles(p: np.ndarray, q: np.ndarray, same: bool):
    """Sums over rows of floor((p - q)^2 / (p + q)) for all columns of p with all of q, or each pair once if ``same``."""
    for a in range(p.shape[1]):
        b = q[:, a + 1:] if same else q
        if b.shape[1]:
            d = p[:, a:a + 1] - b
            yield a, ((d * d) // (p[:, a:a + 1] + b)).sum(axis=0)


def pair_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) for numbers a < b of sources of one language."""
    tiles = F.floor((F.col("sources") - 1) / TILE)
    spread = F.explode(F.sequence(F.lit(0).cast("long"), tiles)).alias("other")
    own = F.floor(F.col("idx") / TILE)
    keyed = lambda d: d.select("lang", "chunk", "ord", "idx", "p", "terms", own.alias("own"), spread) \
        .select("lang", "chunk", F.least("own", "other").alias("ta"), F.greatest("own", "other").alias("tb"), "ord", "idx", "p", "terms")
    # what a source gives all terms that it does not use: one row per source and chunk
    chunks = F.floor((F.greatest(F.col("terms"), F.lit(1)) - 1) / CHUNK)
    empty = groups.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks))) \
                  .withColumn("ord", F.lit(-1).cast("long")).withColumn("p", F.coalesce("p0", F.lit(0).cast("long")))
    data = counts.withColumn("chunk", F.floor(F.col("ord") / CHUNK))

    def run(key, table):
        lang, chunk, ta, tb = (k.as_py() for k in key)
        ords, idx, p, terms = (table.column(c).to_numpy() for c in ("ord", "idx", "p", "terms"))
        rows = min(CHUNK, int(terms[0]) - chunk * CHUNK)
        cols = np.unique(idx[ords < 0])
        at = np.searchsorted(cols, idx)
        m = np.zeros((max(rows, 0), len(cols)), np.int64)
        blank = ords < 0
        m[:, at[blank]] = p[blank]
        m[ords[~blank] - chunk * CHUNK, at[~blank]] = p[~blank]
        split = int(np.searchsorted(cols, (ta + 1) * TILE))
        left, right = (m, m) if ta == tb else (m[:, :split], m[:, split:])
        a, b, v = [], [], []
        for i, sums in _tiles(left, right, ta == tb):
            to = cols[i + 1:] if ta == tb else cols[split:]
            a.append(np.full(len(to), cols[i]))
            b.append(to)
            v.append(sums)
        cat = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64))
        a, b, v = cat(a), cat(b), cat(v)
        return pa.Table.from_arrays([pa.array([lang] * len(a), pa.string()), a, b, v], names=["lang", "a", "b", "value"])

    both = keyed(data).unionByName(keyed(empty))
    return (both.groupBy("lang", "chunk", "ta", "tb").applyInArrow(run, "lang string, a long, b long, value long")
                .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))


def read_terms(top: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Adds ``item``, the term of (lang, ord), to the rows of a report."""
    cols = top.columns
    named = vocabulary.named(vocabulary.meta)
    placed = top.join(F.broadcast(named), "lang").where((F.col("ord") >= F.col("base")) & (F.col("ord") < F.col("base") + F.col("n")))
    asked = placed.groupBy("lang", "first", "base").agg(F.collect_set("ord").alias("ords"))  # at most TOP per group
    with_fst = asked.join(vocabulary.blocks.select("lang", "first", "fst"), ["lang", "first"]).select("lang", "base", "ords", "fst")

    def run(batches):
        for b in batches:
            langs, at, terms = [], [], []
            for lang, base, ords, fst in zip(*(b.column(i).to_pylist() for i in range(4))):
                machine = Transducer.load(fst)
                for o in ords:
                    langs.append(lang)
                    at.append(o)
                    terms.append(machine.term(o - base))
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(at, pa.int64()), pa.array(terms, pa.binary()).cast(pa.string())],
                                             names=["lang", "ord", "item"])

    return top.join(in_arrow(with_fst, run, "lang string, ord long, item string"), ["lang", "ord"]).select(*cols, "item")


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          min_docs: int = MIN_DOCS, top: int = TOP, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(lang, source, part, item, value, rank): parts ``pair`` (other sources, all) and ``term`` (the ``top`` terms)."""
    rows = _rows(docs, text, lang, source)
    kept = shared(document_frequency(rows).where(F.col("docs") >= min_docs).select("lang", "term"), "audit-kept")
    vocabulary = Vocabulary(kept)
    counts = recount(rows, vocabulary, pass_bytes)
    size = rows.sparkSession.createDataFrame(list(vocabulary.sizes.items()) or [("", 0)], "lang string, terms long")
    by_lang = Window.partitionBy("lang")
    groups = (rows.select("lang", "source").distinct()
                  .join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
                  .join(F.broadcast(size), "lang", "left").fillna(0, ["total", "terms"])
                  .withColumn("lang_total", F.sum("total").over(by_lang)).withColumn("sources", F.count(F.lit(1)).over(by_lang))
                  .withColumn("idx", F.row_number().over(by_lang.orderBy("source")).cast("long") - 1)
                  .withColumn("p0", probability(F.lit(0), F.col("total"), F.col("terms"))))
    groups = shared(groups, "audit-groups")
    placed = counts.withColumn("lang_n", F.sum("n").over(Window.partitionBy("lang", "ord"))).join(groups, ["lang", "source"])
    placed = shared(placed.select("lang", "source", "ord", "idx", "sources", "terms",
                                  probability(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
                                  probability(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q")), "audit-placed")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ord")
    terms = (placed.where("p > q").select("lang", "source", "ord", divergence(F.col("p"), F.col("q")).alias("value"))
                   .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top))
    terms = read_terms(terms, vocabulary).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    one = pair_values(placed, groups)
    both = one.unionByName(one.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    name = lambda k, to: groups.select("lang", F.col("idx").alias(k), F.col("source").alias(to))
    pairs = both.join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return pairs.unionByName(terms)
