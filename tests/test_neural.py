"""The dense head: gradients against numerical ones, and a training run against a plain loop."""

import numpy as np
import pytest

from lexicarve.operators import neural as nn


def rows(n=90, width=5):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, width))
    return x, (x[:, 0] + x[:, 1] > 0).astype(float)


def test_gradient_is_the_numerical_one():
    x, y = rows(12, 4)
    w = nn.Weights(4, 6, seed=3)
    mask = (nn.uniform(1, 0, np.arange(12), 6) >= 0.2) / 0.8
    got, loss = nn.gradient(w, x, y, mask)
    f = lambda flat: float(nn.focal(nn.Weights(4, 6, flat).scores(x, mask)[0], y).sum())
    assert loss == pytest.approx(f(w.flat))
    for i in range(len(w.flat)):
        e = np.zeros_like(w.flat)
        e[i] = 1e-6
        assert got[i] == pytest.approx((f(w.flat + e) - f(w.flat - e)) / 2e-6, abs=1e-6)


def test_focal_loss_equals_the_metric(spark):
    from lexicarve.operators import metrics as mt
    p, y = np.array([0.0, 0.2, 0.7, 1.0]), np.array([1, 0, 1, 1])
    df = spark.createDataFrame([(int(b), float(a)) for a, b in zip(p, y)], "label int, score double")
    assert mt.focal_loss(df).first()["focal_loss"] == pytest.approx(nn.focal(p, y).mean())


def test_schedule():
    s, rate, seen = nn.halve_after(), 0.02, []
    for e in range(13):
        rate = s(e, rate)
        seen.append(rate)
    assert seen[:10] == [0.02] * 10 and seen[10:] == [0.01, 0.005, 0.0025]


def test_training_equals_a_plain_loop(spark):
    x, y = rows()
    df = spark.createDataFrame([(i, x[i].tolist(), int(y[i])) for i in range(90)] + [(900, None, 1), (901, [1.0] * 5, None)], "id long, v array<double>, label int")
    head = nn.DenseHead(hidden=8, epochs=4, batch=40, seed=5, schedule=nn.halve_after(2), keep=2)
    model, log = head.fit(df.repartition(4), "id", "v", validation=df.where("label is not null and v is not null"))
    log = log.orderBy("epoch").collect()
    order = df.where("label is not null and v is not null").selectExpr("id", "xxhash64(id) AS h", "md5(concat(xxhash64(id), '-5')) AS o").orderBy("o", "h").collect()
    at, h = [r["id"] for r in order], np.array([r["h"] for r in order])
    w, m1, m2, t, rate = nn.Weights(5, 8, seed=5), 0.0, 0.0, 0, 0.02
    for epoch in range(4):
        rate = rate if epoch < 2 else rate * 0.5
        loss = 0.0
        for s in range(0, 90, 40):
            mask = (nn.uniform(5, epoch, h[s:s + 40], 8) >= 0.2) / 0.8
            g, part = nn.gradient(w, x[at[s:s + 40]], y[at[s:s + 40]], mask)
            g, loss, t = g / len(at[s:s + 40]), loss + part, t + 1
            m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
            w = nn.Weights(5, 8, w.flat - rate * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.999 ** t)) + 1e-8))
        assert log[epoch]["loss"] == pytest.approx(loss / 90) and log[epoch]["rate"] == rate and log[epoch]["n_rows"] == 90
    assert np.allclose(model.weights.flat, w.flat)
    assert [r["kept"] is not None for r in log] == [False, True, False, True] and log[3]["val_loss"] < log[0]["val_loss"]
    back = nn.HeadModel.load(spark, log[3]["kept"])
    assert np.array_equal(back.weights.flat, model.weights.flat)
    out = {r["id"]: r["score"] for r in back.transform(df, "id", "v").collect()}
    assert len(out) == 92 and np.allclose([out[i] for i in range(90)], w.scores(x)[0])


def test_no_rows(spark):
    df = spark.createDataFrame([(1, [1.0], None)], "id long, v array<double>, label int")
    model, log = nn.DenseHead(hidden=2, epochs=2).fit(df, "id", "v")
    assert log.count() == 0 and model.transform(df, "id", "v").count() == 1


def test_small_steps_share_a_job(spark, monkeypatch):
    """One job takes many steps; steps taken in tasks and steps as jobs of their own give the same weights."""
    x, y = rows(200)
    df = spark.createDataFrame([(i, x[i].tolist(), int(y[i])) for i in range(200)], "id long, v array<double>, label int")
    head, calls = nn.DenseHead(hidden=4, epochs=2, batch=10, seed=3), []
    old = nn.DenseHead.steps
    monkeypatch.setattr(nn.DenseHead, "steps", lambda self, *a: calls.append(1) or old(self, *a))
    one, log = head.fit(df, "id", "v")
    assert len(calls) == 2 and [r["n_rows"] for r in log.collect()] == [200, 200]  # 20 steps an epoch
    monkeypatch.setattr(nn, "IN_TASK", 3 * 10 * 5 * 8)
    few, _ = head.fit(df, "id", "v")
    assert len(calls) == 2 + 2 * 7
    monkeypatch.setattr(nn, "IN_TASK", 1)
    far, _ = nn.DenseHead(hidden=4, epochs=2, batch=100, seed=3).fit(df, "id", "v")
    monkeypatch.setattr(nn, "IN_TASK", 1 << 20)
    near, _ = nn.DenseHead(hidden=4, epochs=2, batch=100, seed=3).fit(df, "id", "v")
    assert np.allclose(one.weights.flat, few.weights.flat) and np.allclose(far.weights.flat, near.weights.flat)
