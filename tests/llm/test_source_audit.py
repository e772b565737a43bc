"""Source divergence audit against a plain version, and its transducers."""

import random
import re
from collections import Counter

import pytest

from lexicarve.llm import source_audit
from lexicarve.llm.source_audit import Transducer

SCHEMA = "doc_id long, text string, lang string, source string, ord int, p string, value string"


def plain(rows, min_docs=10, top=10):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    df, cnt, groups = Counter(), {}, set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        w = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(low))
        df.update((lang, t) for t in set(w))
        cnt.setdefault((lang, source), Counter()).update(w)
    out = []
    for lang in {g for g, _ in groups}:
        kept = sorted((t for (g, t), n in df.items() if g == lang and n >= min_docs), key=lambda t: t.encode())
        own = sorted(s for g, s in groups if g == lang)

        def ps(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p = {s: ps(cnt[lang, s]) for s in own}
        q = ps(sum((cnt[lang, s] for s in own), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in own:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if cnt[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, r) for r, (v, i) in enumerate(items[:most], 1)]
    return sorted(out)


def corpus(seed=1, n=400, sources=9):
    rnd = random.Random(seed)
    words = ["Alpha", "bêta", "gamma", "ÉTÉ", "zeta", "x", "日本", "it's", "snake_case", "a1b2", "ωμέγα"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)]
    rows = []
    for i in range(n):
        s = f"s{i % sources}" if i % 3 else "hot"
        pick = [rnd.choice(words[(i % 5) * 7:]) for _ in range(rnd.randint(0, 30))]
        rows.append((" ".join(pick) + rnd.choice(["", "!", "\n", "\x00 Z"]), rnd.choice(["en", "fr", None]), rnd.choice([s, s, s, None])))
    rows += [(None, "en", "s1"), ("", "de", "lonely"), (None, None, None), ("rare words only", "nl", "a"), ("others", "nl", "b"), ("", "nl", "c")]
    rows += [rows[0]] * 25  # repeated rows
    return rows


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, t, g, s, 0, "x", "y") for i, (t, g, s) in enumerate(rows)], SCHEMA).repartition(parts)


def got(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in df.collect())


def test_against_plain(spark):
    rows = corpus()
    assert got(source_audit.audit(frame(spark, rows))) == plain(rows)


def test_small_blocks_passes_tiles_and_tables(spark, monkeypatch):
    """The same result when everything is cut: blocks, passes over the texts, ordinals and sources."""
    for name, v in (("BLOCK_TERMS", 7), ("CHUNK", 5), ("TILE", 2), ("HELD", 20), ("PIECE", 16)):
        monkeypatch.setattr(source_audit, name, v)
    rows = corpus(2, 250, 5)
    assert got(source_audit.audit(frame(spark, rows, 2), min_docs=5, top=3, pass_bytes=2500)) == plain(rows, 5, 3)


def test_ties_go_to_the_smaller_term(spark):
    rows = [("b a", "en", "s")] * 10 + [("c", "en", "t")] * 10
    out = got(source_audit.audit(frame(spark, rows)))
    assert out == plain(rows) and [r[3] for r in out if r[1] == "s" and r[2] == "term"] == ["a", "b"]


def test_empty_table(spark):
    assert got(source_audit.audit(frame(spark, [(None, None, None)]).limit(0))) == []


def test_no_kept_term(spark):
    rows = [("one two", "en", "a"), ("two", "en", "b"), ("", "fr", "a")]
    assert got(source_audit.audit(frame(spark, rows))) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


@pytest.mark.parametrize("alphabet,n", [("ab", 60), ("abcé", 500), ("abcdefghij", 3000)])
def test_transducer(alphabet, n):
    rnd = random.Random(n)
    word = lambda a: "".join(rnd.choice(a) for _ in range(rnd.randint(1, 8))).encode()
    terms = sorted({word(alphabet) for _ in range(n)})
    machine = Transducer.load(Transducer.build(terms).dump())
    rank = {t: i for i, t in enumerate(terms)}
    asked = [*terms, *(word(alphabet + "x") for _ in range(400)), b""]
    assert machine.ranks(asked).tolist() == [rank.get(t, -1) for t in asked]
    assert [machine.term(i) for i in range(len(terms))] == terms
    # minimal: no two states have the same continuations
    shape = [(bool(machine.final[i]), *((int(machine.label[j]), int(machine.target[j])) for j in range(machine.first[i], machine.first[i + 1])))
             for i in range(len(machine.final))]
    assert len(set(shape)) == len(shape)


def test_long_text_is_read_in_pieces(monkeypatch):
    text = ("word another " * 50 + "x" * 300 + " tail").encode()
    whole = [w for part in source_audit.term_lists(text) for w in part]
    monkeypatch.setattr(source_audit, "PIECE", 7)
    assert [w for part in source_audit.term_lists(text) for w in part] == whole
