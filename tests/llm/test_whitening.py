"""Whitening against a plain numpy version."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexicarve.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n int, p string, w string"


def plain(rows, components=16, weight="one"):
    """{(id, component): (n, deviation, |whitened|, explained)} by the contract's words."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 10**6 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    xs = {}
    for _, x in kept:
        xs[tuple(x)] = xs.get(tuple(x), 0) + 1
    w = [c if weight == "count" else 1 for c in xs.values()]
    n = sum(w)
    m = np.array(list(xs), float)
    s = [sum(a * x[j] for a, x in zip(w, xs)) for j in range(m.shape[1])]
    mean = np.array(s, float) / n
    c = m - mean
    v = (c * np.array(w, float)[:, None]).T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, int((e > 1e-10 * e[0]).sum()))
    out = []
    for i, x in kept:
        z = (np.array(x, float) - mean) @ u[:, :k] / np.sqrt(e[:k])
        dev = sum((n * a - b) ** 2 for a, b in zip(x, s))
        out += [(i, j + 1, n, dev, abs(z[j]), e[j] / e.sum()) for j in range(k)]
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[4]))


def got(df):
    out = df.collect()
    assert all(r["identity_error"] < 1e-9 for r in out)
    return sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"]) for r in out),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[4]))


def agree(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[:4] == y[:4]
        assert x[4] == pytest.approx(y[4], rel=1e-6, abs=1e-7) and x[5] == pytest.approx(y[5], rel=1e-9)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("weight", ["one", "count"])
@pytest.mark.parametrize("dims,components", [(24, 16), (5, 16)])
def test_against_numpy(spark, weight, dims, components):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=dims) * np.linspace(3, 0.2, dims)).astype(np.float32).tolist()) for i in range(150)]
    rows += [(1000 + i, rows[0][1]) for i in range(70)]  # a hot vector
    rows += [(2000, rows[1][1]), (2000, rows[1][1]), (None, rows[2][1])]
    rows += [(3000, None), (3001, [None] * dims), (3002, [float("nan")] + [0.0] * (dims - 1)), (3003, [float("-inf")] + [0.0] * (dims - 1))]
    agree(got(whitening.whitened(frame(spark, rows), weight=weight, components=components)), plain(rows, components, weight))


def test_signs_are_the_same_for_all_rows_and_rows_of_one_x_agree(spark):
    rows = [(i, [0.1 * (i % 7), 0.3 * (i % 3), 0.01 * (i % 11)]) for i in range(60)]
    a = {}
    for r in whitening.whitened(frame(spark, rows)).collect():
        a.setdefault(r["component"], {})[r["vec_id"]] = r["whitened"]
    ref = {}
    for r in whitening.whitened(frame(spark, rows, 7)).collect():
        ref.setdefault(r["component"], {})[r["vec_id"]] = r["whitened"]
    assert a == ref  # nothing depends on the partitions


def test_wide_entries_and_other_lengths(spark):
    rng = np.random.default_rng(4)
    wide = [(i, (rng.normal(size=3) * [1e8, 1e7, 1e6]).astype(np.float32).tolist()) for i in range(40)]
    agree(got(whitening.whitened(frame(spark, wide))), [(*r[:3], r[3] if r[3] < 1 << 63 else None, *r[4:]) for r in plain(wide)])
    other = [(100 + i, [float(i % 5), float(i % 3)]) for i in range(20)]
    both = got(whitening.whitened(frame(spark, [*wide, *other, (500, [])])))
    agree([r for r in both if (r[0] or 0) >= 100], plain(other))


def test_no_variance_and_empty(spark):
    assert whitening.whitened(frame(spark, [(i, [1.0, 2.0]) for i in range(9)])).count() == 0
    assert whitening.whitened(frame(spark, [(1, [1.0, 2.0])])).count() == 0
    empty = whitening.whitened(frame(spark, []))
    assert empty.count() == 0 and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    flat = whitening.whitened(frame(spark, [(i, [float(i % 4), 5.0]) for i in range(9)])).agg(F.max("component")).first()[0]
    assert flat == 1


def test_packed_form_is_exact():
    for v in ([1.5, -2.0], [300.0, 0.0], [1e6, -1e6], [1e12, 1.0], [3e38, -3e38]):
        y = whitening.unpack([whitening.pack(np.array(v))], len(v))[0]
        assert y.tolist() == [max(-(1 << 61), min(1 << 61, math.floor(64 * c))) for c in v]
