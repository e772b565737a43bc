"""Skip-chain field for personal data: base spans, message passing and consistency against plain versions."""

import itertools
import random
import re

import numpy as np
import pytest

from lexicarve.llm import pii_skipcrf as P
from lexicarve.llm import queries

SCHEMA = "doc_id long, text string, base string, k int, row string"
SF = "/root/testdata/sf0.001"


def plain_base(text):
    """The contract's patterns word for word."""
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        total = sum(x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for i, x in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, *m.span()))
    return out


TRICKY = ["a@b.c", "a@b", "x@@y.zz", "a@b.c.@d.e", "1@2.3@4.5", "mail%a+b-c@d-e.f.g.", "é.a@b.co", "@b.c", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.1",
          "0001.2.3.255", "1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1111x", "4111  111111111111", "4111 1111 1111 1112", "0" * 19, "0" * 20,
          "+1 (555) 123-4567.", "+1 555", "++49 30 123456", "+1-", "+12((((3", "+1 (744) 555-1421 a", "+49 30 1234567890123456", "٣٤٥ ４１１１", ""]


def test_base_spans():
    rnd = random.Random(5)
    texts = TRICKY + ["".join(rnd.choice("ab1.4@+- ()0_%\n") for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(rnd.choice("0123456789- ") for _ in range(50)) for _ in range(2000)]
    for t in texts:
        assert P.base_spans(t) == plain_base(t), t


def test_base_spans_of_long_runs():
    for t in ("a" * 300_000 + "@", "1" * 300_000, "1." * 100_000 + "x", "1 " * 150_000, "+1" * 100_000, "a@" * 100_000, "+1" + "(" * 200_000):
        P.base_spans(t)


def exact(unary, edges):
    n, k = unary.shape
    p = np.zeros((n, k))
    for y in itertools.product(range(k), repeat=n):
        w = np.exp(sum(unary[i, y[i]] for i in range(n)) + sum(m[y[a], y[b]] for a, b, m in edges))
        for i in range(n):
            p[i, y[i]] += w
    return p / p.sum(axis=1, keepdims=True)


def test_message_passing_is_exact_on_trees_and_near_on_loops():
    rng = np.random.default_rng(1)
    chain_m, skip_m = rng.normal(size=(3, 3)), rng.normal(size=(3, 3))
    skip_m = skip_m + skip_m.T
    unary = rng.normal(size=(6, 3))
    pairs = lambda x: np.array(x, np.int64).reshape(-1, 2)
    chain, skip = [(0, 1), (1, 2), (4, 5)], [(2, 4)]
    want = exact(unary, [(*e, chain_m) for e in chain] + [(*e, skip_m) for e in skip])
    assert np.allclose(P.marginals(unary, pairs(chain), pairs(skip), chain_m, skip_m), want, atol=1e-4)
    skip = [(0, 3), (0, 4), (2, 5)]
    want = exact(unary, [(*e, chain_m / 3) for e in chain] + [(*e, skip_m / 3) for e in skip])
    assert np.abs(P.marginals(unary, pairs(chain), pairs(skip), chain_m / 3, skip_m / 3) - want).max() < 0.03
    assert np.allclose(P.marginals(unary, pairs([]), pairs([]), chain_m, skip_m), exact(unary, []))


def corpus(n=300):
    rnd = random.Random(7)
    words = ["alpha", "order", "sum", "text", "river", "stone", "blue", "green"]
    say = lambda: " ".join(rnd.choice(words) for _ in range(rnd.randint(3, 9)))
    rows = []
    for i in range(n):
        a, b = rnd.randint(200, 999), rnd.randint(1000, 9999)
        entity = rnd.choice([f"+1 ({a}) 555-{b}", f"user.{b}@mail{a}.example.com", f"{rnd.randint(1, 255)}.{a % 256}.{rnd.randint(0, 255)}.7", "4111 1111 1111 1111"])
        rows.append((i, f"{say()} {entity} {say()} {entity if i % 3 else b} {say()} {rnd.randint(1, 10**6)} items"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 0, "y") for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def field(spark):
    return P.train(frame(spark, corpus()))


def test_distant_copies_take_the_label(spark, field):
    text = "call +1 (415) 555-2671 today. The rest of the text says a lot. Then dial (415) 555-2671 again; ref 8812 and 77 items."
    mail = "write to joe.smith.99@corp.example.com or, as before, to joe.smith.99@corp only; 2012 was a year."
    rows = [(1, text), (2, mail), (3, "The year 2012 had 366 days, 8760 hours and 12 months."), (4, None), (5, ""), (5, text)]
    got = {}
    for r in P.personal_data(frame(spark, rows), field=field).collect():
        got.setdefault(r["doc_id"], []).append(([tuple(x) for x in r["base"]], [tuple(x) for x in r["spans"]]))
    second = text.index("(415) 555-2671 again")
    base, spans = got[1][0]
    assert base == plain_base(text) and set(base) < set(spans) and got[5][0] != got[5][1]
    extra = [s for s in spans if s not in base]
    assert [k for k, _, _ in extra] == [3] and second <= extra[0][1] < extra[0][2] <= second + 14 and "555-2671" in text[extra[0][1]:extra[0][2]]
    base, spans = got[2][0]
    assert [mail[a:b] for k, a, b in spans if (k, a, b) not in base] == ["joe.smith.99@corp"]
    assert got[3] == [([], [])] and got[4] == [([], [])] and ([], []) in got[5]


def test_results_do_not_depend_on_partitions(spark, field):
    rows = corpus(120)
    a = sorted(map(str, P.personal_data(frame(spark, rows), field=field).collect()))
    b = sorted(map(str, P.personal_data(frame(spark, rows).repartition(11), field=field).collect()))
    assert a == b


def test_masked(spark, field):
    rows = [(1, "a +1 (415) 555-2671 b x@y.zz c"), (2, None), (3, "")]
    out = {r["doc_id"]: r for r in P.masked(frame(spark, rows), field=field).collect()}
    assert out[1]["text"] == "a <phone> b <email> c" and out[2]["text"] is None and out[3]["text"] == "" and out[1]["row"] == "y"


def test_empty_table_and_table_without_entities(spark):
    assert P.personal_data(frame(spark, [(1, "x")]).limit(0)).count() == 0
    out = P.personal_data(frame(spark, [(1, "room 12"), (None, "no number"), (2, None)])).collect()
    assert len(out) == 3 and all(not r["spans"] for r in out)


def test_query_on_the_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = queries.op13_pii_skipcrf(spark, SF).collect()
    assert len(out) == len(texts)
    import hashlib
    for r in out:
        base = plain_base(texts[r["doc_id"]])
        want = ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == i for k, _, _ in base) for i in range(4)]
        assert set(filter(None, want.split(","))) <= set(r["spans"].split(","))


def test_many_copies_of_a_token_cost_few_edges():
    nodes = P.Nodes()
    nodes.add(0, "x 555-2671 " * 5000, [])
    assert len(nodes.skip) // 2 <= 2 * 5000
