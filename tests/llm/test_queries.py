"""Registered queries: oracles on a small table set, and the pipeline stage by stage."""

import sys
from pathlib import Path

import pytest

import corpus_pipeline
from lexicarve.llm import queries
from oracle import compare, duck
from test_fm_chat_ann_lines import plain_contamination
from test_simhash_ring_mix import plain_mix, plain_simhash, union

SF = "/root/testdata/sf0.001"
sys.path.insert(0, str(Path(__file__).parent))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    ok, detail = compare(spark, duck(SF), name, queries.QUERIES[name], queries.ORACLE[name], SF)
    assert ok, detail


def test_names():
    assert [n.split("_")[0] for n in sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{i}" for i in range(1, 14)]
    assert [s for s, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "source_mix", "sharding"]


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", "src1", 0), (10**6 + 2, "!!", "en", "src1", 2)], docs.schema)
    docs = docs.unionByName(extra)
    stages = dict(corpus_pipeline.STAGES)
    one = stages["language_id"](spark, docs, SF).cache()
    assert one.columns == docs.columns and one.count() == docs.count() - 3
    two = stages["simhash_near_dedup"](spark, one, SF).cache()
    fp = {r["doc_id"]: plain_simhash(r["text"]) for r in one.collect()}
    comp = union(set(fp.values()), [(a, b) for a in set(fp.values()) for b in set(fp.values()) if bin(a ^ b).count("1") <= 2])
    first = {}
    for i in sorted(fp):
        first.setdefault(comp[fp[i]], i)
    assert two.columns == docs.columns and sorted(r["doc_id"] for r in two.collect()) == sorted(first.values())
    three = stages["benchmark_decontamination"](spark, two, SF).cache()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(r["doc_id"], r["text"]) for r in two.collect()]
    clean = [k for k, n, h, _ in plain_contamination(rows, items) if not (h > 0 and 20 * h >= n)]
    assert three.columns == docs.columns and sorted(r["doc_id"] for r in three.collect()) == sorted(clean)
    four = stages["source_mix"](spark, three, SF).cache()
    want = {r["doc_id"]: r.get("n", 1) for r in plain_mix([r.asDict() for r in three.collect()])}
    got = {r["doc_id"]: r["count"] for r in four.groupBy("doc_id").count().collect()}
    assert four.columns == docs.columns and got == {i: n for i, n in want.items() if n}
    five = stages["sharding"](spark, four, SF)
    assert five.count() == four.count()
    assert {r["n"] == r["m"] + 1 for r in five.groupBy("shard").agg({"slot": "max", "doc_id": "count"}).toDF("shard", "m", "n").collect()} == {True}


def test_pipeline_on_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_language_stage_keeps_every_text_with_a_letter(spark):
    """Texts of three languages, scripts that no labelled row uses, and input without any label stay; null and letterless texts go."""
    words = {g: [f"{a}{b}{c}" for a in p[0] for b in p[1] for c in p[2]] for g, p in
             {"aa": ("bdg", "aei", "nst"), "bb": ("klm", "ouy", "rvz"), "cc": ("fhp", "äöü", "cqx")}.items()}
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(i, " ".join(words[g][(i * 7 + j * 5) % 27] for j in range(40)), g, "s", 1) for i in range(60) for g in [sorted(words)[i % 3]]]
    part = {"aa": 36, "bb": 33, "cc": 31}
    mixed = " ".join(" ".join((words[g] * 40)[:10 * n]) for g, n in part.items())
    extra = [(100, mixed, "aa", "s", 1), (101, "Это обычный русский текст без метки", None, "s", 1), (102, "これは日本語です", None, "s", 1), (103, "naïve 中文 mixed", None, "s", 1)]
    gone = [(200, None, "aa", "s", 1), (201, "", None, "s", 1), (202, "123 !!", "aa", "s", 1)]
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    docs = spark.createDataFrame(rows + extra + gone, schema)
    want = {r[0] for r in rows + extra}
    assert {r["doc_id"] for r in stage(spark, docs, SF).collect()} == want
    bare = spark.createDataFrame([(*r[:2], None, *r[3:]) for r in rows + extra + gone], schema)
    assert {r["doc_id"] for r in stage(spark, bare, SF).collect()} == want
