r"""Personal data: fixed patterns, and a skip-chain conditional random field over a document's tokens.

Fixed patterns (leftmost, non-overlapping per kind, failing matches
dropped): ``email``, ``ip``, ``card`` and ``phone``. They are found in
linear time, also in long runs without a match.

The field adds spans. Its nodes are the whitespace tokens that hold a
digit or an ``@`` (other words cannot be part of an entity and only serve
as context), its labels are the kinds and ``none``. Nodes are joined by
chain edges where tokens stand side by side, and by skip edges between
distant tokens that are repeated (equal letters and digits) or similar
(equal last seven digits, or equal part before the ``@``): each is joined
to the one before and to the first of its group, so a group of k costs
2k edges. Tokens inside base spans are observed. Loopy sum-product message
passing over all documents of a batch at once carries their labels to the
rest, and neighbouring tokens of one kind whose marginals reach
``MIN_PROBABILITY`` become a span, unless they touch a base span.

Weights are fitted in numpy by pseudo-likelihood on a bounded sample
(``SAMPLE_DOCS`` documents, drawn by hash from those that hold a digit or
``@``; documents of over ``SAMPLE_TOKENS`` nodes are not drawn), with the
base spans as labels. Every node is seen twice, once without its own form,
so that edges learn to carry a label. Everything else covers all rows.

Spans are code points, end exclusive. Defined cases: a null or empty text
has no spans; without an entity in the sample the field adds none;
repeated rows are returned as often as they occur; an empty table gives no
rows; spans of different kinds may overlap; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow

KINDS = ["email", "ip", "card", "phone"]
NONE = len(KINDS)
LABELS = NONE + 1
MIN_PROBABILITY = 0.9
SAMPLE_DOCS = 4000
SAMPLE_TOKENS = 500
BUCKETS = 1 << 14
SLOTS = 9  # features of a node; the first OWN are its own form, the rest its context
OWN = 6
ROUNDS = 30
LONGEST = 64

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")
_NODE = re.compile(r"[0-9@]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_SPACES = "\x20\t\n\v\f\r"
_EDGE = "\"'()[]{}<>.,;:!?"
_LETTER = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(2 * d - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return (odd + even) % 10 == 0


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", m.end() if m else at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, sorted."""
    out = [(0, a, b) for a, b in _emails(text)]
    if not _NODE.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NO_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def _bucket(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % BUCKETS


def _form(core: str, digits: str) -> list[int]:
    """Features of a token's own form."""
    shape = re.sub("[A-Z]+", "A", re.sub("[^\\W\\d_A-Z]+", "a", re.sub("[0-9]", "9", core[:24])))
    n = len(digits)
    card = f"card {13 <= n <= 19 and luhn(digits)}"
    quad = core.split(".")
    ip = f"ip {len(quad) == 4 and all(q.isascii() and q.isdigit() and len(q) <= 3 and int(q) <= 255 for q in quad)}"
    mail = f"mail {core.count('@')} {'.' in core.rpartition('@')[2]} {core[:1].isalnum()}"
    return [_bucket(x) for x in (f"shape {shape}", f"digits {min(n, 20)} {n == len(core)}", card, ip, mail, f"start {core[:1] if not core[:1].isalnum() else 'x'}")]


class Nodes:
    """Tokens of a batch of documents: spans, features, observed labels and edges."""

    def __init__(self):
        self.doc, self.start, self.end, self.label = array("q"), array("q"), array("q"), array("b")
        self.feature = array("i")
        self.chain, self.skip = array("q"), array("q")  # pairs of nodes

    def add(self, doc: int, text: str, base: list[tuple[int, int, int]]):
        m, before, last_word, first = _NODE.search(text), 0, "", len(self.doc)
        groups: dict[str, list[int]] = {}
        owner = iter(sorted((a, b, k) for k, a, b in base))
        cover, ahead = [], next(owner, None)
        while m:
            at = m.start()
            # words of more than LONGEST characters are cut
            start = max(max(text.rfind(c, before, at) for c in _SPACES) + 1, before, at - LONGEST // 2)
            stop = _SPACE.search(text, at, start + LONGEST)
            end = stop.start() if stop else min(len(text), start + LONGEST)
            token = text[start:end]
            core = token.strip(_EDGE)
            a = start + token.find(core) if core else start
            b = a + len(core) if core else end
            low = core.lower()
            digits = _NO_DIGIT.sub("", core)
            node = len(self.doc)
            # what the base spans say of it
            while ahead and ahead[0] < b:
                cover.append(ahead)
                ahead = next(owner, None)
            cover = [c for c in cover if c[1] > a]
            label = min((c[2] for c in cover if c[0] < b), default=NONE)
            words = _LETTER.findall(text, max(before, start - 40), start)
            last_word = words[-1].lower() if words else ("" if start > before + 3 else last_word)
            following = _LETTER.search(text, end, end + 24)
            side = node > first and start - before <= 2 and not text[before:start].strip(_SPACES + "-.,")
            self.feature.extend(_form(core, digits))
            self.feature.extend([_bucket(f"before {last_word}"), _bucket(f"after {following[0].lower() if following else ''}"), _bucket(f"side {side}")])
            if side:
                self.chain.extend((node - 1, node))
            keys = []
            plain = "".join(c for c in low if c.isalnum() or c == "@")
            if len(plain) >= 4 and (digits or "@" in plain):
                keys.append(plain)
            if len(digits) >= 7:
                keys.append("…" + digits[-7:])
            if "@" in low and len(low.partition("@")[0]) >= 4:
                keys.append(low.partition("@")[0] + "@…")
            linked = set()
            for k in keys:
                group = groups.setdefault(k, [node, node])
                linked.update(x for x in group if x != node)
                group[1] = node
            for x in linked:
                if not (side and x == node - 1):
                    self.skip.extend((x, node))
            self.doc.append(doc)
            self.start.append(a)
            self.end.append(b)
            self.label.append(label)
            before = end
            m = _NODE.search(text, end)

    def arrays(self):
        as_np = lambda a, kind: np.frombuffer(a, kind) if len(a) else np.zeros(0, kind)
        return (as_np(self.feature, np.int32).reshape(-1, SLOTS), as_np(self.label, np.int8).astype(np.int64),
                as_np(self.chain, np.int64).reshape(-1, 2), as_np(self.skip, np.int64).reshape(-1, 2))


class Field:
    """Weights: node features [BUCKETS, LABELS], and potentials of chain and skip edges [LABELS, LABELS] (skip: symmetric)."""

    def __init__(self, node=None, chain=None, skip=None, live=False):
        self.node = np.zeros((BUCKETS, LABELS)) if node is None else node
        self.chain = np.zeros((LABELS, LABELS)) if chain is None else chain
        self.skip = np.zeros((LABELS, LABELS)) if skip is None else skip
        self.live = live


def fit(feature: np.ndarray, label: np.ndarray, chain: np.ndarray, skip: np.ndarray, steps: int = 150, rate: float = 0.1, l2: float = 1e-4) -> Field:
    """Pseudo-likelihood: each node's label given its features and the labels of its neighbours (Adam, full batch)."""
    if not len(label) or (label == NONE).all():
        return Field()
    n = len(label)
    # what the neighbours of each node say: counts by label
    left, right, far = (np.zeros((n, LABELS)) for _ in range(3))
    if len(chain):
        np.add.at(left, (chain[:, 1], label[chain[:, 0]]), 1)
        np.add.at(right, (chain[:, 0], label[chain[:, 1]]), 1)
    if len(skip):
        np.add.at(far, (skip[:, 1], label[skip[:, 0]]), 1)
        np.add.at(far, (skip[:, 0], label[skip[:, 1]]), 1)
    gold = np.eye(LABELS)[label]
    whole = np.concatenate([feature, feature])
    seen = np.ones(whole.shape, bool)
    seen[n:, :OWN] = False  # the second view has no form of its own
    left, right, far, gold = (np.concatenate([x, x]) for x in (left, right, far, gold))
    w = [np.zeros((BUCKETS, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS))]
    m1, m2 = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    flat, by = whole[seen], np.nonzero(seen)[0]
    for t in range(1, steps + 1):
        score = np.zeros((2 * n, LABELS))
        for j in range(SLOTS):
            on = seen[:, j]
            score[on] += w[0][whole[on, j]]
        score += left @ w[1] + right @ w[1].T + far @ w[2]
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        d = (p - gold) / n
        g0 = np.stack([np.bincount(flat, weights=d[by, k], minlength=BUCKETS) for k in range(LABELS)], axis=1)
        g2 = far.T @ d
        for i, g in enumerate((g0, left.T @ d + d.T @ right, (g2 + g2.T) / 2)):
            g = g + l2 * w[i]
            m1[i] = 0.9 * m1[i] + 0.1 * g
            m2[i] = 0.999 * m2[i] + 0.001 * g * g
            w[i] = w[i] - rate * (m1[i] / (1 - 0.9 ** t)) / (np.sqrt(m2[i] / (1 - 0.999 ** t)) + 1e-8)
    return Field(w[0], w[1], w[2], True)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


def marginals(unary: np.ndarray, chain: np.ndarray, skip: np.ndarray, on_chain: np.ndarray, on_skip: np.ndarray,
              rounds: int = ROUNDS, damping: float = 0.3) -> np.ndarray:
    """Loopy sum-product message passing; exact where the graph has no cycle. Rows sum to 1."""
    n, k = unary.shape
    edges = np.concatenate([chain, skip])
    if len(edges):
        psi = np.concatenate([np.broadcast_to(on_chain, (len(chain), k, k)), np.broadcast_to(on_skip, (len(skip), k, k))])
        src = np.concatenate([edges[:, 0], edges[:, 1]])
        dst = np.concatenate([edges[:, 1], edges[:, 0]])
        psi = np.concatenate([psi, psi.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        message = np.zeros((len(src), k))
        for _ in range(rounds):  # always as many, so that a document's result does not depend on its batch
            belief = unary + np.stack([np.bincount(dst, weights=message[:, j], minlength=n) for j in range(k)], axis=1)
            new = _log_sum((belief[src] - message[back])[:, :, None] + psi, axis=1)
            new -= new.max(axis=1, keepdims=True)
            message = damping * message + (1 - damping) * new
        unary = unary + np.stack([np.bincount(dst, weights=message[:, j], minlength=n) for j in range(k)], axis=1)
    p = np.exp(unary - unary.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def added_spans(field: Field, nodes: Nodes) -> dict[int, list[tuple[int, int, int]]]:
    """Spans (kind, start, end) that the field adds, by document."""
    feature, label, chain, skip = nodes.arrays()
    out: dict[int, list] = {}
    if not field.live or not len(label) or (label != NONE).all():
        return out
    unary = field.node[feature].sum(axis=1)
    seen = label != NONE
    unary[seen] = -50.0
    unary[seen, label[seen]] = 50.0
    p = marginals(unary, chain, skip, field.chain, field.skip)
    kind = p.argmax(axis=1)
    new = np.flatnonzero((kind != NONE) & ~seen & (p.max(axis=1) >= MIN_PROBABILITY))
    joined = {int(b) for _, b in chain}
    prev = -2
    for i in new.tolist():
        doc, k, a, b = nodes.doc[i], int(kind[i]), nodes.start[i], nodes.end[i]
        own = out.setdefault(doc, [])
        if prev == i - 1 and i in joined and own and own[-1][0] == k:
            own[-1] = (k, own[-1][1], b)
        else:
            own.append((k, a, b))
        prev = i
    return out


def _scan(texts: list[str | None], field: Field):
    """Per text: (base spans, all spans)."""
    nodes, base = Nodes(), []
    for i, t in enumerate(texts):
        found = base_spans(t) if t else []
        base.append(found)
        if t and field.live:
            nodes.add(i, t, found)
    more = added_spans(field, nodes)
    for i, found in enumerate(base):
        extra = [s for s in more.get(i, ()) if not any(s[1] < e and a < s[2] for _, a, e in found)]
        yield found, sorted({*found, *extra})


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS, sample_tokens: int = SAMPLE_TOKENS) -> Field:
    """Fits the field on about ``sample_docs`` documents of at most ``sample_tokens`` nodes."""
    able = docs.select(F.col(text).alias("t"), F.xxhash64(F.col(key), F.lit("pii")).alias("h")).where(F.col("t").rlike("[0-9@]"))
    rate = min(1.0, sample_docs / max(able.count(), 1))
    drawn = able.where(F.pmod(F.col("h"), F.lit(1 << 20)) < int(rate * (1 << 20)) + 1).select("t")

    def run(batches):
        for b in batches:
            raw = []
            for t in b.column(0).to_pylist():
                nodes = Nodes()
                nodes.add(0, t, base_spans(t))
                if len(nodes.doc) <= sample_tokens:
                    raw.append([a.tobytes() for a in (nodes.feature, nodes.label, nodes.chain, nodes.skip)])
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in raw], pa.binary()) for i in range(4)], names=list("flcs"))

    rows = sorted(in_arrow(drawn, run, "f binary, l binary, c binary, s binary").collect())  # at most sample_docs * sample_tokens nodes
    parts, at = ([], [], [], []), 0
    for r in rows:
        f, lab = np.frombuffer(r["f"], np.int32).reshape(-1, SLOTS), np.frombuffer(r["l"], np.int8).astype(np.int64)
        edges = [np.frombuffer(r[c], np.int64).reshape(-1, 2) + at for c in "cs"]
        for p, x in zip(parts, (f, lab, *edges)):
            p.append(x)
        at += len(lab)
    if not rows:
        return Field()
    return fit(*(np.concatenate(p) for p in parts))


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", field: Field | None = None) -> DataFrame:
    """(key, base, spans): arrays of (kind number, start, end), sorted; ``spans`` includes the field's."""
    field = train(docs, key, text) if field is None else field
    held = docs.sparkSession.sparkContext.broadcast(field)  # BUCKETS * LABELS numbers
    d = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    one = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    kind = "array<struct<kind:int,start:int,end:int>>"

    def run(batches):
        for b in batches:
            found = list(_scan(b.column(1).to_pylist(), held.value))
            cols = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in f[i]] for f in found], one) for i in range(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["k", "base", "spans"])

    return in_arrow(d, run, f"k {d.schema['k'].dataType.simpleString()}, base {kind}, spans {kind}").withColumnRenamed("k", key)


def spelled(spans):
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def masked(docs: DataFrame, key: str = "doc_id", text: str = "text", field: Field | None = None) -> DataFrame:
    """The documents, all columns, with every span replaced by its kind in angle brackets (overlaps: the leftmost, then the longest)."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("body"))
    found = personal_data(whole, "row", "body", train(docs, key, text) if field is None else field)
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("a"), (-s["end"]).alias("z"), s["kind"].alias("kind"))))
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    body = F.col(f"row.`{text}`")
    step = lambda acc, s: F.when(s["a"] < acc["at"], acc).otherwise(F.struct(
        F.concat(acc["out"], F.substring(body, acc["at"] + 1, s["a"] - acc["at"]), F.element_at(names, s["kind"] + 1)).alias("out"), (-s["z"]).alias("at")))
    end = lambda acc: F.concat(acc["out"], F.substring(body, acc["at"] + 1, F.length(body)))
    new = F.aggregate(ordered, start, step, end)
    return found.select(*[new.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
