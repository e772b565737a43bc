"""The secret scan's query against its patterns on a whole table."""

import hashlib
import re

from lexicarve.llm import queries

SF = "/root/testdata/sf0.01"


def test_counts_and_digest(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = queries.op6_secret_battery(spark, SF).collect()
    assert len(out) == len(texts) and sum(r["n_hex"] + r["n_assign"] for r in out) > 0
    for r in out:
        t = texts[r["doc_id"]]
        spans = [(m.start(), 0, m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A) if len(m[2]) >= 12]
        spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in spans) for i in range(3)]
        want = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(r["spans"].split(","))


def test_mixed_runs_are_split_and_sparse_strata_pooled(spark):
    import random

    from lexicarve.llm import secret_battery as sb

    rnd = random.Random(4)
    key = "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40))
    text = f"some ordinary words stand here before my-app/{key} and some more of them come after a_b/{key} in the end"
    at = [text.index(key), text.rindex(key)]
    assert [(a, b) for a, b, _, _ in sb.candidates(text)[0]] == [(a, a + 40) for a in at]
    # one document alone: its few candidates are judged by the fallback, not lost
    df = spark.createDataFrame([(1, text), (2, None), (3, "plain words/only-here")], "doc_id long, text string")
    out = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in sb.secrets(df).collect()}
    assert out == {1: [(a, a + 40) for a in at], 2: [], 3: []}
    table = {"mixed-16": (3, None), "mixed-32": (500, 4), "digits-16": (7, None), "mixed-*": (503, 3), "digits-*": (7, None), "*": (510, 6)}
    assert sb.chosen_cuts(table) == {"mixed-16": 3, "mixed-32": 4, "digits-16": 6}
    assert sb.chosen_cuts({"mixed-16": (200, None), "mixed-*": (200, None), "*": (200, None)}) == {}
