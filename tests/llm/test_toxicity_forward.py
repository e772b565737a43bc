"""The toxicity net against plain loops: forward pass, thresholds, gradients of a step, sample bounds."""

import random

import numpy as np

from lexicarve.llm import toxicity_cnn as tc


def small_net(seed):
    rng = np.random.default_rng(seed)
    net = tc.Net(seed)
    net.e = rng.normal(0, 1, net.e.shape).astype(np.float32)
    net.e[tc.PAD] = 0
    net.b = [rng.normal(0, 1, tc.FILTERS).astype(np.float32) for _ in tc.WIDTHS]
    return net


def plain_logit(net, text):
    rows, _, words = tc.hashed_words([text])
    emb = [sum(net.e[r].astype(float) for r in row) for row in rows[:int(words[0])]] + [np.zeros(tc.DIM)] * 3
    kept = []
    for i, width in enumerate(tc.WIDTHS):
        for f in range(tc.FILTERS):
            values = [sum(emb[p + j] @ net.k[i][j][:, f].astype(float) for j in range(width)) + net.b[i][f] for p in range(int(words[0]) + 1)]
            kept.append(max(max(values), 0))
    return float(np.dot(kept, net.v) + net.c[0])


def test_forward_pass_equals_plain_loops():
    rnd, net = random.Random(4), small_net(5)
    texts = ["", "a", "123 !", "one two"] + [" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 7) for _ in range(rnd.randint(0, 40))) for _ in range(30)]
    rows, start, words = tc.hashed_words(texts)
    assert np.allclose(net.logits(rows, start, words), [plain_logit(net, t) for t in texts], atol=1e-3)


def test_a_score_does_not_depend_on_its_neighbours():
    rnd = random.Random(6)
    model = tc.Model()
    model.net = small_net(7)
    texts = [" ".join(rnd.choice("klmnop") * rnd.randint(1, 4) for _ in range(rnd.randint(0, 5))) for _ in range(60)]
    alone = [model.scores([t])[0] for t in texts]
    assert np.allclose(model.scores(texts), alone, atol=1e-6)
    assert np.allclose(model.scores(texts[::-1])[::-1], alone, atol=1e-6)


def test_threshold_equals_all_cuts_tried():
    rng = np.random.default_rng(8)
    for _ in range(50):
        n = int(rng.integers(2, 30))
        z, y, w = rng.integers(0, 12, n).astype(float), rng.integers(0, 2, n).astype(float), rng.choice([1.0, 3.5], n)
        if not y.any():
            continue

        def f1(cut):
            p = z >= cut
            return 2 * (w * y * p).sum() / ((w * p).sum() + (w * y).sum())

        assert np.isclose(f1(tc.best_threshold(z, y, w)), max(f1(c) for c in z))


def test_sample_bounds(spark):
    docs = spark.createDataFrame([(i, ("bad" if i % 2 else "good") + " word" * 50, "en") for i in range(200)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    whole, few = tc.train(docs, labels), tc.train(docs, labels, sample_bytes=6000)
    assert whole.net is not None and few.net is not None and not np.array_equal(whole.net.e, few.net.e)
    assert tc.train(docs, labels, longest=10).net is None
    again = tc.train(docs.repartition(7), labels, sample_bytes=6000)
    assert np.array_equal(again.net.e, few.net.e)


def test_every_labelled_row_is_learnt_from(spark, monkeypatch):
    """A class of over 3000 rows and texts of over 20,000 words were cut."""
    monkeypatch.setattr(tc, "EPOCHS", 1)
    counted, first = [], tc.Net.start_from
    monkeypatch.setattr(tc.Net, "start_from", lambda net, seen, n: (counted.append(np.array(n).tolist()), first(net, seen, n))[1])
    docs = spark.range(7000).selectExpr("id AS doc_id", "concat(if(id % 2 = 1, 'bad', 'good'), ' word') AS text", "'en' AS lang")
    labels = spark.range(7000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    held = labels.where("pmod(xxhash64(doc_id, 'calibrate'), 5) = 0")
    cells, judge = [], tc.best_threshold
    monkeypatch.setattr(tc, "best_threshold", lambda z, y, w: (cells.append(float(np.sum(w))), judge(z, y, w))[1])
    tc.train(docs, labels)
    n_held = held.count()
    assert sum(counted[0]) == 7000 - n_held and cells[0] == n_held
    long = spark.createDataFrame([(i, ("bad " if i % 2 else "good ") * 21_000, "en") for i in range(20)], "doc_id long, text string, lang string")
    assert tc.train(long, labels).net is not None


def test_shards_do_not_change_what_is_counted(spark, monkeypatch):
    monkeypatch.setattr(tc, "SHARD_ROWS", 30)
    docs = spark.createDataFrame([(i, ("bad" if i % 3 else "good") + f" w{i % 7}", "en") for i in range(400)] * 2, "doc_id long, text string, lang string")
    y = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 400, 2)], "k long, y int")
    rows = tc.hashed_rows(docs, y, "doc_id", "text", "lang")
    assert rows.count() == 400 and rows.select("shard").distinct().count() == 14
    word = int(tc.hashed_words(["bad"])[0][0, 0])
    n = tc.word_counts(rows).where("g = 'en'").where(f"id = {word}").first()["n"]
    assert n == 2 * sum(1 for i in range(0, 400, 2) if i % 3)


def test_long_text_in_pieces_has_the_same_peaks(monkeypatch):
    rnd, net = random.Random(9), small_net(10)
    rows, start, words = tc.hashed_words([" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 7) for _ in range(301))])
    where, value = net.peaks(rows, start, words)
    monkeypatch.setattr(tc, "BATCH_WORDS", 50)
    where2, value2 = net.peaks(rows, start, words)
    assert np.allclose(value, value2, atol=1e-4) and all(np.array_equal(a, b) for a, b in zip(where, where2))
