"""Language spans, the toxicity net and the secret battery."""

import random
import re

import numpy as np
import pytest

from lexicarve.llm import langid_viterbi as li
from lexicarve.llm import secret_battery as sb
from lexicarve.llm import toxicity_cnn as tc

SYLLABLES = {"en": "the th an er on re he in ed nd ing".split(), "fr": "le eau ou que ment é è tre eux".split(),
             "ru": "при ва ст но ко да ли".split()}


def sentence(lang, rnd, n):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(4)
    rows = [(i, sentence(g, rnd, rnd.randrange(5, 60)), g, "s") for i, g in enumerate(["en", "fr", "ru"] * 60)]
    rows += [(1000, None, "en", "s"), (1001, "", "fr", "s"), (1002, "123 -- !!", "ru", "s"), (1003, sentence("en", rnd, 30) + ". " + sentence("fr", rnd, 60), "fr", "s"),
             (1004, sentence("en", rnd, 200_000), None, None), (1004, "ᚠᚢᚦ", None, None), (None, sentence("fr", rnd, 9), "fr", "s")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1.5 AS score", "'?' AS lang_pred")


@pytest.fixture(scope="module")
def model(docs):
    return li.train(li.learnable(docs))


def naive_viterbi(s, penalty):
    v, back = s[0].copy(), []
    for t in range(1, len(s)):
        stay = v >= v.max() - penalty
        back.append((stay, int(v.argmax())))
        v = np.maximum(v, v.max() - penalty) + s[t]
    best = v.max()
    return best


def path_value(s, path, penalty):
    return sum(s[t, g] for t, g in enumerate(path)) - penalty * int((np.diff(path) != 0).sum())


def test_viterbi_is_exact():
    rng = np.random.default_rng(0)
    for block in (2, 5, 64):
        sizes = [1, 2, 7, 64, 65, 200, 3]
        s = rng.normal(0, 2, (sum(sizes), 4)).astype(np.float32)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        path = li.viterbi(s, doc, 3.0, block)
        for d in range(len(sizes)):
            own = s[doc == d]
            assert path_value(own, path[doc == d], 3.0) == pytest.approx(naive_viterbi(own, 3.0), abs=1e-3)


def test_languages(docs, model):
    assert model.langs == ["en", "fr", "ru"]
    out = {(r["doc_id"], (r["spans"] or [None])[0] and r["n_spans"]): r for r in li.label_languages(docs, model, with_spans=True).collect()}
    rows = list(out.values())
    by = {r["doc_id"]: r for r in rows}
    truth = {r["doc_id"]: r["lang"] for r in docs.collect() if r["doc_id"] is not None and r["doc_id"] < 1000}
    assert np.mean([by[i]["lang_pred"] == g for i, g in truth.items()]) > 0.97
    for i in (1000, 1001, 1002):
        assert (by[i]["lang_pred"], by[i]["score"], by[i]["n_spans"]) == ("und", 0.0, 0)
    mixed = by[1003]
    assert mixed["lang_pred"] == "fr" and 2 <= mixed["n_spans"] <= 4 and {s["lang"] for s in mixed["spans"]} == {"en", "fr"}
    assert mixed["spans"][0]["start"] == 0 and mixed["score"] < 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_script_narrows(model):
    pred, score, n, spans = li.identify(model, ["при thе", "ᚠᚢᚦ"], with_spans=True)
    assert pred[0] == "ru" and pred[1] in model.langs and score[1] == 0


def test_nothing_learned(spark, docs):
    empty = li.train(docs.where("doc_id < 0"))
    assert {r["lang_pred"] for r in li.label_languages(docs.limit(5), empty).collect()} == {"und"}
    assert li.label_languages(docs.where("doc_id < 0"), empty).count() == 0
    assert li.train(docs.where("lang is null")).langs == []


def test_keep_identified(docs, model):
    kept = li.keep_identified(docs, model, 0.05)
    assert kept.columns == docs.columns
    assert {1000, 1001, 1002}.isdisjoint({r["doc_id"] for r in kept.collect()})
    assert kept.count() == docs.count() - 4  # the three above and the text in a script no one learned


def test_toxicity(spark):
    rnd = random.Random(8)
    rows, labels = [], []
    for i in range(900):
        lang = ("en", "fr")[i % 2]
        toxic = i % 5 == 0
        words = sentence(lang, rnd, rnd.randrange(4, 60)).split()
        if toxic:
            words.insert(rnd.randrange(len(words) + 1), rnd.choice(["scum", "trash"]) if lang == "en" else "vequ" + rnd.choice(SYLLABLES["fr"]))
        rows.append((i, " ".join(words), lang))
        labels.append((i, int(toxic)))
    rows += [(2000, None, None), (2001, "", "en"), (2001, "", "en"), (None, "x", "en"), (2002, "a b " * 60_000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "7 AS toxic", "0.1 AS score")
    lab = spark.createDataFrame(labels + [(0, None), (5, 1), (2002, 0)], "doc_id long, toxic int")
    model = tc.train(docs, tc.learnable(lab))
    out = tc.score(docs, model).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    got = {r["doc_id"]: r["score"] >= 0.5 for r in out}
    held = [i for i in range(900) if __import__("zlib").crc32(str(i).encode()) % 5 == 0]
    truth = np.array([i % 5 == 0 for i in held])
    pred = np.array([got[i] for i in held])
    f1 = 2 * (truth & pred).sum() / (truth.sum() + pred.sum())
    assert f1 > 0.9
    again = tc.train(docs.repartition(7), tc.learnable(lab))
    assert np.array_equal(model.net.e, again.net.e) and np.array_equal(model.shift, again.shift)
    assert {r["score"] for r in tc.score(docs, tc.train(docs, lab.where("toxic = 0"))).collect()} == {0.0}
    assert tc.score(docs.where("doc_id < 0"), model).count() == 0


def test_hashed_words_do_not_depend_on_neighbours():
    a, start, n = tc.hashed_words(["Été one", "", "two, THREE", "Été one"])
    assert n.tolist() == [2, 0, 2, 2]
    assert np.array_equal(a[start[0]:start[0] + 4], a[start[3]:start[3] + 4])
    assert (a[start[1]:start[1] + 2] == tc.PAD).all()


PATTERNS = [("assign", r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 12),
            ("access", r"AKIA[A-Z0-9]+", 18), ("hex", r"[0-9a-f]+", 16)]


def plain_base(text):
    out = []
    for rank, (name, pattern, least) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text, re.A | (re.I if rank == 0 else 0)):
            if len(m[1] if rank == 0 else m[0]) >= least:
                out.append((m.start(), rank, m.end()))
    return sorted(out)


def test_base_spans():
    rnd = random.Random(6)
    bits = ["password", "PassWd", "secret", "token", "api_key", "ApiKey", "=", ": ", "'", '"', "AKIA", "AKIAAKIA", "ABCDEFGH0123456789", "deadbeef", "0123456789abcdef",
            " ", "ſecret", "toKen=abcdefghijkl", "é", "\n", "zzz", "x.y-z"]
    for _ in range(3000):
        t = "".join(rnd.choice(bits) for _ in range(rnd.randrange(12)))
        assert sb.base_spans(t) == plain_base(t), t
    assert sb.base_spans("secret: token: abcdefghijklmnop") == plain_base("secret: token: abcdefghijklmnop") == []


def test_battery_tells_random_from_text():
    rnd = random.Random(9)
    place = sb._SETS[1][4]
    random_ps = [sb.battery("".join(rnd.choice("0123456789abcdef") for _ in range(40)), place) for _ in range(400)]
    text_ps = [sb.battery("".join(rnd.choice("eeeaabd") for _ in range(40)), place) for _ in range(400)]
    assert np.mean(np.array(random_ps) > 0.01) > 0.95 and np.mean(np.array(text_ps) > 0.01) < 0.02
    assert sb.infer("abcdefghijklmnopqrst") is None and sb.infer("Abcdefghijklmnopqrst") is None
    assert sb.infer("0123456789abcdef")[0] == "hex" and sb.infer("aB3" * 6)[0] == "base62"


def test_secrets(spark):
    rnd = random.Random(10)
    rows = []
    for i in range(300):
        text = sentence("en", rnd, 80)
        if i % 3 == 0:
            text = f"{text} {''.join(rnd.choice('ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789') for _ in range(40))} {text}"
        if i % 3 == 1:
            text += " aaaaaaaaa1111111111bbbbbbbbbbb2222222222222 tail"
        rows.append((i, text))
    rows += [(900, None), (901, ""), (901, ""), (None, "token = 0123456789abcdef0123"), (902, "z" * 200_000 + " password=0123456789ab")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS base", "2 AS spans")
    out = sb.secrets(df).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    text = dict(rows)
    for i, r in by.items():
        assert [tuple(x) for x in r["base"]] == plain_base(text[i] or "")
        assert [tuple(x) for x in r["spans"] if x["kind"] < 3] == plain_base(text[i] or "")
    found = lambda i: any(x["kind"] == 3 for x in by[i]["spans"])
    assert np.mean([found(i) for i in range(0, 300, 3)]) > 0.9
    assert not any(found(i) for i in range(300) if i % 3)
    assert sb.secrets(df.where("doc_id < 0")).count() == 0


def test_cuts_of_a_stratum_without_candidates(spark):
    schema = "k long, found array<struct<start:int,end:int,stratum:string,bin:int>>, decoys array<struct<stratum:string,bin:int>>"
    rows = [(1, [(0, 20, "a", 3)] * 50, [("a", 0)] + [("a", 30)] * 49), (2, [], [("b", 0)])]
    got = {r["stratum"]: r["cut"] for r in sb.cuts(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"a": 29} or got == {"a": 3}


def test_letters_of_all_planes_and_marks_alone(spark):
    """A text of combining marks has no letter; one of letters beyond U+30000 has."""
    rows = [(i, "the quick brown fox jumps over it", "en") for i in range(30)]
    model = li.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    odd = [(100, "\u0301\u0300 \u0903"), (101, "\U00030000\U00030001"), (102, "e\u0301a"), (103, "12 \u0301")]
    out = {r["doc_id"]: r["lang_pred"] for r in li.label_languages(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()}
    assert out == {100: "und", 101: "en", 102: "en", 103: "und"}
    assert not any(chr(c).isalpha() for c in range(0x40000, 0x110000))


def test_more_than_500_languages_are_learned(spark):
    rows = [(i, " ".join([f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}word"] * 5), f"l{i:03d}") for i in range(520)]
    model = li.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.langs) == 520
