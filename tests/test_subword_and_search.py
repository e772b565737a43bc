"""Sub-word cutting, length batches and draws without replacement against plain versions."""

import random

import pytest

from lexicarve.operators import search as se
from lexicarve.operators import subword as sw

E = sw.END


def plain_cut(word, vocab, unknown):
    if len(word) > sw.MAX_CHARS:
        return [unknown]
    rest, out = word + E, []
    while rest:
        n = next((n for n in range(len(rest), 0, -1) if rest[:n] in vocab), None)
        if n is None:
            return [unknown]
        out.append(vocab[rest[:n]])
        rest = rest[n:]
    return out


@pytest.fixture(scope="module")
def pieces(spark):
    names = ["a", "b", "ab", "abc" + E, "c" + E, "b" + E, "ca", "d", "é", "é" + E, "abab"]
    vocab = {p: i + 10 for i, p in enumerate(names)}
    return vocab, spark.createDataFrame(list(vocab.items()), "piece string, id long")


def test_cut_words(spark, pieces):
    vocab, table = pieces
    rnd = random.Random(3)
    words = {"".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 9))) for _ in range(300)} | {"a" * 100 + "b", "ab" * 49 + "b", "zzz"}
    df = spark.createDataFrame([(w, "x") for w in words] + [(None, "x"), ("", "x")], "token string, ids string")
    got = {r["token"]: list(r["ids"]) for r in sw.cut_words(df, table, 7).collect()}
    assert got == {w: plain_cut(w, vocab, 7) for w in words}


def test_encode_subwords(spark, pieces):
    vocab, table = pieces
    docs = [(1, ["ab", "abc", "zz"]), (2, []), (3, None), (4, ["abab"] * 40), (5, ["b", "ab"])]
    df = spark.createDataFrame(docs, "doc_id long, tokens array<string>").repartition(3)
    got = {r["doc_id"]: list(r["input_ids"]) for r in sw.encode_subwords(df, table, 1, 2, 7).collect()}
    assert got == {i: [1, *(x for w in t or [] for x in plain_cut(w, vocab, 7)), 2] for i, t in docs}


def test_vocabulary_file(spark, tmp_path):
    path = tmp_path / "t.json"
    path.write_text('{"model": {"type": "x", "vocab": {"ab": 0, "c</w>": 1, "\\"": 2}}}')
    assert {(r["piece"], r["id"]) for r in sw.vocabulary_file(spark, str(path)).collect()} == {("ab", 0), ("c" + E, 1), ('"', 2)}


def test_length_batches(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.randint(1, 9) for _ in range(rnd.choice([0, 1, 5, 5, 5, 30]))]) for i in range(50)] + [(50, None), (51, [3] * 4000)]
    df = spark.createDataFrame(rows, "doc_id long, input_ids array<bigint>").repartition(4)
    out = sorted(sw.length_batches(df, batch=8).collect(), key=lambda r: (len(r["input_ids"]), r["doc_id"]))
    assert [r["batch"] for r in out] == [i // 8 for i in range(52)]
    for r in out:
        own = [x for x in out if x["batch"] == r["batch"]]
        assert r["width"] == max(len(x["input_ids"]) for x in own) == len(r["padded"]) == len(r["attention_mask"])
        n = len(r["input_ids"])
        assert list(r["padded"]) == list(r["input_ids"]) + [0] * (r["width"] - n) and sum(r["attention_mask"]) == n
    assert sw.length_batches(df.where("doc_id < 0"), batch=8).count() == 0


def test_draws_without_replacement_cover_the_grid(spark):
    space = {"a": se.Grid(1, 7, 7), "b": se.Choice(("x", "y", "z")), "c": se.Grid(0, 1, 4, integer=False, none=True), "d": se.Choice((True, False))}
    every = [tuple(r) for r in se.draw_distinct(spark, 10**6, space, 5).collect()]
    assert len(every) == se.grid_size(space) == 210 and len({r[1:] for r in every}) == 210
    few = [tuple(r) for r in se.draw_distinct(spark, 20, space, 5).collect()]
    assert few == every[:20] and few != [tuple(r) for r in se.draw_distinct(spark, 20, space, 6).collect()]
    spread = [r[1:] for r in few]
    assert all(len({s[j] for s in spread}) > 1 for j in range(4))
    big = [r for r in se.draw_distinct(spark, 2000, se.FOREST_SPACE_CV).collect()]
    assert len({tuple(r)[1:] for r in big}) == 2000 and all(1 <= r["min_samples_split"] <= 100 for r in big)


def test_score_names(spark):
    from lexicarve.operators import models as md
    with pytest.raises(ValueError):
        md.score_trial(None, None, "id", "auc")


def test_subwords_move_no_text(spark):
    """Tokens stay where their texts are; rows that share a key are merged as before, a null key has no words."""
    vocab = spark.createDataFrame([("a", 3), ("b", 4), ("a" + sw.END, 5), ("ab" + sw.END, 6), ("b" + sw.END, 7)], "piece string, id long")
    rows = [(1, ["ab", None, "a", "", "x"]), (2, ["ab"] * 3), (3, None), (4, [])]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    enc = sw.encode_subwords(df, vocab, 0, 1, 9)
    assert "Exchange" not in enc._jdf.queryExecution().executedPlan().toString()
    assert {r["doc_id"]: r["input_ids"] for r in enc.collect()} == {1: [0, 6, 5, 9, 1], 2: [0, 6, 6, 6, 1], 3: [0, 1], 4: [0, 1]}
    more = spark.createDataFrame(rows + [(2, ["b", "aab"]), (None, ["ab"])], "doc_id long, tokens array<string>")
    got = sorted(((r["doc_id"], r["input_ids"]) for r in sw.encode_subwords(more, vocab, 0, 1, 9).collect()), key=repr)
    two = (2, [0, 6, 7, 3, 6, 6, 6, 1])
    assert got == sorted([(1, [0, 6, 5, 9, 1]), two, two, (3, [0, 1]), (4, [0, 1]), (None, [0, 1])], key=repr)
