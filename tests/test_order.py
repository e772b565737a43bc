"""Stored positions, the sliding shuffle buffer and timed steps."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lexicarve.operators import encode as en
from lexicarve.operators import sampling as sm
from lexicarve.operators.positions import stored_index


def test_stored_index_with_payload_at_scale(spark):
    """1.1 million rows in scattered order, ties, nulls and a column named like the helpers."""
    n = 1_100_000
    df = spark.range(n).select((F.xxhash64("id") % 500_000).alias("o0"), F.col("id").alias("row"), F.lit("p").alias("part"))
    df = df.unionByName(spark.createDataFrame([(None, -1, "p"), (None, -2, "q")], df.schema))
    out = stored_index(df, ["o0", "row"], "idx")
    assert out.columns == ["o0", "row", "part", "idx"]
    r = out.agg(F.count("*").alias("n"), F.countDistinct("idx").alias("d"), F.min("idx").alias("a"), F.max("idx").alias("b")).first()
    assert (r["n"], r["d"], r["a"], r["b"]) == (n + 2, n + 2, 0, n + 1)
    first = [tuple(x) for x in out.where("idx < 3").orderBy("idx").select("o0", "row").collect()]
    assert first[:2] == [(None, -2), (None, -1)]
    # neighbours by position are neighbours in order
    a = out.select("idx", F.struct("o0", "row").alias("s"))
    b = out.select((F.col("idx") - 1).alias("idx"), F.struct("o0", "row").alias("t"))
    assert a.join(b, "idx").where("s.o0 is not null and not (s < t)").count() == 0
    assert stored_index(df.where("row > 2000000"), ["row"]).count() == 0


@pytest.mark.parametrize("n,size", [(300, 40), (30, 40), (40, 40), (41, 1), (0, 5)])
def test_buffered_shuffle_equals_a_plain_buffer(spark, n, size):
    ids = random.Random(1).sample(range(10**6), n)
    df = spark.createDataFrame([(i, "x") for i in ids], "doc_id long, _slot string").repartition(4).withColumnRenamed("_slot", "other")
    rows, buffer, want, t = iter(sorted(ids)), [], [], 0
    for r in rows:
        if len(buffer) < size:
            buffer.append(r)
            continue
        j = int(hashlib.md5(f"7-step-{t}".encode()).hexdigest()[:8], 16) % size
        want.append(buffer[j])
        buffer[j], t = r, t + 1
    want += [buffer[j] for j in sorted(range(len(buffer)), key=lambda j: hashlib.md5(f"7-slot-{j}".encode()).hexdigest())]
    out = sm.buffered_shuffle(df, size, 7).orderBy("shuffle_rn").collect()
    assert [r["doc_id"] for r in out] == want and [r["shuffle_rn"] for r in out] == list(range(1, n + 1))


def test_a_timed_step_runs_once(spark):
    seen = spark.sparkContext.accumulator(0)
    df = spark.range(130).select("id", F.floor(F.col("id") / 64).alias("batch"))

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    out, m = en.timed_step(df.mapInArrow(count, df.schema), "encode")
    r = m.first()
    assert (r["step"], r["n_rows"], r["n_batches"]) == ("encode", 130, 3) and r["seconds"] > 0 and seen.value == 130
    assert out.count() == 130 and seen.value == 130
    assert en.timed_step(df.where("id < 0"), "none")[1].first()["n_batches"] == 0


def test_helpers_do_not_meet_columns_of_the_caller(spark):
    names = ["_s", "_bkt", "_off", "_cuts", "_row", "_n"]
    df = spark.createDataFrame([(i, i % 3, *[f"{c}{i}" for c in names]) for i in range(50)], "id long, label int, " + ", ".join(f"{c} string" for c in names))
    out = sm.reset_index(df, ["label", "id"]).orderBy("row").collect()
    assert [(r["label"], r["id"]) for r in out] == sorted((i % 3, i) for i in range(50)) and all(r["_s"] == f"_s{r['id']}" for r in out)
    assert sm.stratified_folds(df, "label", 5, key="id").count() == 50
