"""Hand-computed units and invariants (FIXTURES.md edge rows)."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexicarve.functions import arrays as ar
from lexicarve.functions import labels as lb
from lexicarve.functions import text as tx
from lexicarve.operators import encode as en
from lexicarve.operators import metrics as mt
from lexicarve.operators import positions as ps
from lexicarve.operators import sampling as sm
from lexicarve.operators import search as se
from lexicarve.operators import text as ot
from lexicarve.operators import tfidf as tf


def test_vote_labels(spark):
    rows = [(1, 0.0, 0.0, 0.0), (2, 1.0, 0.0, 0.0), (3, 1.0, 0.0, 1.0), (4, 0.9, 0.9, None), (5, None, 1.0, None)]
    df = spark.createDataFrame(rows, "id long, v1 double, v2 double, v3 double")
    votes = ["v1", "v2", "v3"]
    got = {r["id"]: (r["any"], r["thr"]) for r in df.select(
        "id", lb.any_vote(votes).alias("any"), lb.threshold_vote(votes).alias("thr")).collect()}
    assert got == {1: (0, 0), 2: (1, 0), 3: (1, 1), 4: (1, 0), 5: (1, 0)}


def test_preprocess_accents_punctuation(spark):
    df = spark.createDataFrame([("Olá, MUNDO! Não-é?",), ("Straße Æther",), (None,)], "text string")
    got = [r[0] for r in df.select(tx.preprocess("text")).collect()]
    assert got == ["ola mundo naoe", "strasse aether", ""]


def test_tokenize_and_stop_words(spark):
    df = spark.createDataFrame([("The cat, não é?",)], "text string")
    toks = df.select(tx.tokenize(tx.normalise("text")).alias("t")).first()["t"]
    assert toks == ["the", "cat", ",", "nao", "e", "?"]
    kept = df.select(tx.remove_stop_words(tx.tokenize(tx.normalise("text")))).first()[0]
    # accented list entries ("não", "é") never match folded tokens; "e" is itself a stop word
    assert kept == ["cat", ",", "nao", "?"]
    folded = df.select(tx.remove_stop_words(tx.tokenize(tx.normalise("text")), fold_list=True)).first()[0]
    assert folded == ["cat", ",", "?"]


def test_lemmatize_identity_fallback(spark):
    df = spark.createDataFrame([(["was", "cats", "foi"],)], "t array<string>")
    assert df.select(tx.lemmatize("t")).first()[0] == ["be", "cats", "ser"]


def test_short_and_empty_documents(spark):
    df = spark.createDataFrame([(1, "um dois"), (2, ""), (3, "um")], "doc_id long, text string")
    c = ot.ngram_counts(df.select("doc_id", tx.word_tokens(tx.preprocess("text")).alias("tokens")))
    got = {r["doc_id"]: (r["n1"], r["n2"], r["n3"], r["n4"]) for r in c.collect()}
    assert got[1] == (2, 1, 0, 0) and got[2] == (0, 0, 0, 0)
    w = tf.tfidf(df, tokenizer=lambda c: tx.word_tokens(tx.preprocess(c)))
    assert w.where("doc_id = 2").count() == 0
    # smoothed idf uses N = 3 documents including the empty one
    row = w.where("doc_id = 1 AND term = 'dois'").first()
    assert math.isclose(row["idf"], math.log(4 / 2) + 1)
    norms = {r[0]: r[1] for r in w.groupBy("doc_id").agg(F.sum(F.col("tfidf") ** 2)).collect()}
    assert all(math.isclose(v, 1.0) for v in norms.values())


def test_balanced_sample_short_class_and_holdout(spark):
    rows = [(i, 0) for i in range(20)] + [(100 + i, 1) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, bin_class int")
    s = sm.balanced_sample(df, "bin_class", 5)
    assert sorted(r["doc_id"] for r in s.collect()) == [0, 1, 2, 3, 4, 100, 101, 102]
    h = sm.holdout(df, "bin_class", 6, 4)
    assert sorted(r["doc_id"] for r in h.collect()) == [6, 7, 8, 9]
    assert s.select("doc_id").intersect(h.select("doc_id")).count() == 0


def test_positional_index_matches_row_number(spark):
    rnd = random.Random(7)
    ids = rnd.sample(range(1, 10_000_000), 3000)
    rows = [(i, rnd.choice([0, 0, 0, 1, 2])) for i in ids]
    df = spark.createDataFrame(rows, "doc_id long, g int")
    want = df.withColumn("want", F.row_number().over(Window.partitionBy("g").orderBy("doc_id")))
    got = ps.positional_index(want, "doc_id", ["g"], cuts=50)
    assert got.where(F.col("rn") != F.col("want")).count() == 0
    # global sorted index equals a global row_number - 1
    gi = ps.sorted_index(df, ["g", "doc_id"], cuts=7)
    w = gi.withColumn("want", F.row_number().over(Window.orderBy("g", "doc_id")) - 1)
    assert w.where(F.col("idx") != F.col("want")).count() == 0


def test_folds_equal_ntile(spark):
    rows = [(i, i % 3) for i in range(1, 403)]
    df = spark.createDataFrame(rows, "doc_id long, bin_class int")
    got = sm.stratified_folds(df, "bin_class", 5)
    want = got.withColumn("want", F.ntile(5).over(Window.partitionBy("bin_class").orderBy("doc_id")) - 1)
    assert want.where(F.col("fold") != F.col("want")).count() == 0


def test_ordered_split_and_head(spark):
    df = spark.range(1, 101).withColumnRenamed("id", "doc_id")
    s = sm.ordered_split(df, 0.85)
    assert s.where("slice = 'train'").agg(F.max("doc_id")).first()[0] == 85
    assert sm.head(df, 7).count() == 7 and sm.head(df, 0).count() == 100


def test_golden_confusion_0816(spark):
    rows = [(1, 1)] * 408 + [(0, 0)] * 408 + [(0, 1)] * 92 + [(1, 0)] * 92
    df = spark.createDataFrame(rows, "label int, prediction int")
    m = mt.binary_metrics(df).first()
    for k in ("precision", "recall", "accuracy", "f1", "f1_micro"):
        assert round(m[k], 3) == 0.816
    cells = mt.confusion_matrix(df).collect()
    assert sum(r["n"] for r in cells) == 1000 and len(cells) == 4


def test_no_positive_prediction(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    m = mt.binary_metrics(df).first()
    assert m["precision"] == 0.0 and m["f1"] == 0.0 and m["accuracy"] == 0.5
    cm = {(r["true_label"], r["pred_label"]): r["n"] for r in mt.confusion_matrix(df).collect()}
    assert cm == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_focal_and_binary_accuracy(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.2)], "label int, score double")
    acc = mt.thresholded_accuracy(df).first()[0]
    loss = mt.focal_loss(df).first()[0]
    want = ((0.1 ** 2) * -math.log(0.9) + (0.2 ** 2) * -math.log(0.8)) / 2
    assert acc == 1.0 and math.isclose(loss, want)


def test_search_log_flags(spark):
    log = spark.createDataFrame([(i, f) for i, f in enumerate([.5, .5, .4, .6, .6])], "iter long, f1 double")
    out = {r["iter"]: (r["flag"], r["best"]) for r in se.annotate_log(log).collect()}
    assert [out[i][0] for i in range(5)] == [0, 0, 1, 1, 0]
    assert [i for i in range(5) if out[i][1]] == [3]


def test_early_stop_is_cumulative(spark):
    f1 = [.9, .8, .7, .6, .5, .4, .3, .9]
    log = spark.createDataFrame(list(enumerate(f1)), "iter long, f1 double")
    ran = {r["iter"]: r["ran"] for r in se.annotate_log(log, patience=5).collect()}
    assert [ran[i] for i in range(8)] == [True] * 6 + [False] * 2


def test_grid_and_draws(spark):
    g = se.Grid(100, 5000, 1000)
    df = spark.range(1000).select(g.value(F.col("id")).alias("v"))
    import numpy as np
    want = [int(x) for x in np.linspace(100, 5000, num=1000)]
    assert [r[0] for r in df.orderBy(F.monotonically_increasing_id()).collect()] == want
    t = se.draw_trials(spark, 4, se.FOREST_SPACE, 42).collect()
    assert t == se.draw_trials(spark, 4, se.FOREST_SPACE, 42).collect()


def test_threshold_sweep_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.randint(0, 50), rnd.randint(0, 1)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, v long, label int")
    ths = spark.createDataFrame([(0, 10), (1, 25), (2, 49), (3, -1)], "iter long, threshold long")
    got = {r["iter"]: (r["tp"], r["fp"], r["fn"], r["tn"]) for r in se.threshold_sweep(df, "v", "label", ths).collect()}
    for it, th in [(0, 10), (1, 25), (2, 49), (3, -1)]:
        tp = sum(1 for _, v, y in rows if v > th and y == 1)
        fp = sum(1 for _, v, y in rows if v > th and y == 0)
        fn = sum(1 for _, v, y in rows if v <= th and y == 1)
        tn = sum(1 for _, v, y in rows if v <= th and y == 0)
        assert got[it] == (tp, fp, fn, tn)


def test_padding_mask_segments(spark):
    df = spark.createDataFrame([(1, [2, 7, 8, 3]), (2, [2, 3])], "doc_id long, input_ids array<int>")
    p = en.pad_to_longest(df)
    assert {r["doc_id"]: r["padded"] for r in p.collect()} == {1: [2, 7, 8, 3], 2: [2, 3, 0, 0]}
    ex = en.examples(en.fixed_length(df, max_len=3), "padded", None).collect()
    f = {r["doc_id"]: r["features"] for r in ex}
    assert f[1]["input_ids"] == [2, 7, 3]  # end marker kept on cut
    assert f[2]["attention_mask"] == [1, 1, 0] and f[2]["token_type_ids"] == [0, 0, 0]


def test_whole_word_encode(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, [])], "doc_id long, tokens array<string>")
    v = en.word_vocabulary(df)
    assert {r["token"]: r["id"] for r in v.collect()} == {"a": 4, "b": 5}
    enc = {r["doc_id"]: r["input_ids"] for r in en.encode_words(df, v).collect()}
    assert enc == {1: [2, 5, 4, 5, 3], 2: [2, 3]}


def test_random_split_is_stable(spark):
    df = spark.range(2000).withColumnRenamed("id", "doc_id")
    a = sm.random_split(df, 0.2, 42)
    frac = a.where("slice = 'test'").count() / 2000
    assert 0.15 < frac < 0.25
    assert a.exceptAll(sm.random_split(df, 0.2, 42)).count() == 0


def test_first_position_slice(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 4.0]],)], "s array<array<double>>")
    assert df.select(en.first_position("s")).first()[0] == [1.0, 2.0]


def test_batch_scoring_in_pandas(spark):
    df = spark.range(10).selectExpr("id", "cast(id as double) as x")

    def load():
        return lambda pdf: pdf["x"] * 2.0

    out = en.score_in_batches(df, load, "id long, x double, y double", batch_rows=3)
    assert sorted(r["y"] for r in out.collect()) == [2.0 * i for i in range(10)]


def test_streaming_clean_text(spark, tmp_path):
    from lexicarve.streaming import clean_text_stream, write_parquet_stream
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, "Olá, MUNDO!")], "doc_id long, text string").write.parquet(src)
    schema = spark.read.parquet(src).schema
    q = write_parquet_stream(clean_text_stream(spark, src, schema), str(tmp_path / "out"),
                             str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    row = spark.read.parquet(str(tmp_path / "out")).first()
    assert row["clean"] == "ola mundo" and row["tokens"] == ["ola", "mundo"]


def jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def hashed_frame(spark, n):
    """Sparse signed 64-bit keys, a null class, and a payload."""
    return spark.range(n).select(F.xxhash64("id").alias("doc_id"), F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 3).cast("int").alias("c"),
                                 F.concat(F.lit("payload-"), F.col("id")).alias("payload"))


def test_sorted_index_of_a_wide_frame(spark):
    df = hashed_frame(spark, 1_100_000)
    before = jobs(spark)
    out = sm.reset_index(df, ["doc_id"], name="i")
    assert jobs(spark) == before
    r = out.agg(F.countDistinct("i").alias("d"), F.min("i").alias("lo"), F.max("i").alias("hi"), F.countDistinct("payload").alias("p")).first()
    assert (r["d"], r["lo"], r["hi"], r["p"]) == (1_100_000, 0, 1_099_999, 1_100_000)


def test_positions_define_no_job_and_keep_null_classes(spark):
    df = hashed_frame(spark, 5000)
    before = jobs(spark)
    frames = [sm.balanced_sample(df, "c", 20), sm.holdout(df, "c", 20, 10), sm.head(df, 5), sm.stratified_folds(df, "c", 5),
              sm.ordered_split(df, 0.85, ["c", "doc_id"]), sm.shuffle_order(df)]
    assert jobs(spark) == before
    rn = F.row_number().over(Window.partitionBy("c").orderBy("doc_id"))
    want = df.withColumn("rn", rn)
    assert frames[0].exceptAll(want.where("rn <= 20").drop("rn")).count() == 0 and frames[0].count() == 80
    assert frames[1].exceptAll(want.where("rn > 20 and rn <= 30").drop("rn")).count() == 0 and frames[1].count() == 40
    folds = frames[3].withColumn("w", F.ntile(5).over(Window.partitionBy("c").orderBy("doc_id")) - 1)
    assert folds.count() == 5000 and folds.where("fold <> w").count() == 0
    stacked = frames[4].withColumn("r", F.row_number().over(Window.orderBy("c", "doc_id")))
    assert stacked.where((F.col("slice") == "train") != (F.col("r") <= 4250)).count() == 0
    even = sm.ordered_split(df, 0.85, "doc_id", stratify="c").withColumn("r", rn).withColumn("n", F.count("*").over(Window.partitionBy("c")))
    assert even.where((F.col("slice") == "train") != (F.col("r") <= F.floor(F.col("n") * 0.85))).count() == 0
    assert sorted(r["shuffle_rn"] for r in frames[5].select("shuffle_rn").collect()) == list(range(1, 5001))
    empty = df.limit(0)
    assert sm.balanced_sample(empty, "c", 3).count() == sm.reset_index(empty, ["doc_id"]).count() == sm.ordered_split(empty).count() == 0


def test_fractional_votes_pass_through(spark):
    df = spark.createDataFrame([(-0.5, 0.0), (0.2, 0.1), (0.0, None)], "a double, `b c` double")
    assert lb.positional_votes(["text", "a", "b c", "doc_id"], key="doc_id") == ["a", "b c"]
    assert [r[0] for r in df.select(lb.any_vote(["a", "`b c`"])).collect()] == [-0.5, 1.0, 0.0]


def test_folding_of_decomposed_and_other_letters(spark):
    df = spark.createDataFrame([("ac\u0327a\u0303o \u1ebf \u201cq\u201d \u2026 \u2014 \u65e5x",)], "t string")
    assert df.select(tx.fold_accents("t")).first()[0] == 'acao e "q" ... -- x'
    assert df.select(tx.fold_accents(F.lit("plain ascii"))).first()[0] == "plain ascii"


def test_hot_term_is_split(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                                           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
                                           "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(keep, ("-1", "8k", "16k", "1.5", "false")):
            spark.conf.set(k, v)
        docs = spark.range(30_000).select(F.xxhash64("id").alias("doc_id"), F.concat(F.lit("hot x"), F.col("id")).alias("text")).repartition(16)
        w = tf.tfidf(docs, tokenizer=lambda c: F.split(c, " "), n_min=1, n_max=1)
        w.write.format("noop").mode("overwrite").save()
        joined = w.select("doc_id", "term", "df")
        rows = joined.where("term = 'hot'").collect()
        assert len(rows) == 30_000 and {r["df"] for r in rows} == {30_000}
        q = w.groupBy().agg(F.sum("tfidf"))
        q.collect()
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan and plan.count("Generate") == 0
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_sparse_vectors_keep_empty_documents(spark):
    df = spark.createDataFrame([(1, "um dois um"), (2, ""), (3, None)], "doc_id long, text string")
    w = tf.tfidf(df, tokenizer=lambda c: tx.word_tokens(tx.preprocess(c)))
    arrays = tf.sparse_arrays(w, tf.vocabulary(w), df)
    plan = arrays._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    vecs = {r["doc_id"]: r["features"] for r in tf.sparse_vectors(arrays).collect()}
    assert set(vecs) == {1, 2, 3} and {v.size for v in vecs.values()} == {vecs[1].size}
    assert vecs[2].numNonzeros() == vecs[3].numNonzeros() == 0 and math.isclose(vecs[1].norm(2), 1.0)


def test_encode_examples_limit_and_bytes(spark):
    df = spark.createDataFrame([(3, bytearray("c a".encode()), 1), (1, bytearray("a b".encode()), 0), (2, None, 1)], "doc_id long, text binary, label int")
    v = en.word_vocabulary(df.select("doc_id", tx.word_tokens(tx.preprocess(tx.decode_utf8("text"))).alias("tokens")))
    got = {r["doc_id"]: r["features"]["input_ids"] for r in en.encode_examples(df, v, limit=2, max_len=4).collect()}
    assert got == {1: [2, 4, 5, 3], 2: [2, 3, 0, 0]}
    assert en.encode_examples(df, v).count() == 3


def test_search_fits_what_it_draws(spark):
    from lexicarve.operators import models as md
    from pyspark.ml.functions import array_to_vector
    rows = [(i, [float(i % 7), float(i % 2)], float(i % 2)) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, v array<double>, label double").select("doc_id", array_to_vector("v").alias("features"), "label")
    space = {"n_estimators": se.Grid(2, 6, 5), "max_depth": se.Grid(2, 40, 3, none=True), "bootstrap": se.Choice((True, False))}
    model, log = md.holdout_search(spark, df, df, "doc_id", n_iter=3, space=space)
    for r in log.collect():
        assert r["fitted_trees"] == r["n_estimators"] and r["fitted_depth"] == md.tree_depth(r["max_depth"]) and r["n_scored"] == 80
    assert log.where("best").count() == 1
    best = log.where("best").first()
    assert md.fitted_shape(model) == (best["fitted_trees"], best["fitted_depth"])
    folds = sm.stratified_folds(df, "label", 4)
    _, cv = md.cv_search(spark, folds, n_iter=2, space=space, k=4)
    assert [(r["n_folds"], r["n_scored"]) for r in cv.collect()] == [(4, 80)] * 2
    assert md.forest({"n_estimators": 700}).getNumTrees() == 700


def test_flows_run_small(spark):
    from lexicarve.plans import flows
    from lexicarve.sources.corpus import labelled_corpus
    c = labelled_corpus(spark, "/root/testdata/sf0.001")
    out = flows.neural_examples(c, ["toxic", "quality"], n=10, max_len=32, batch=4)
    tr = out["train"].collect()
    assert tr and all(len(r["features"]["input_ids"]) == 32 for r in tr)
    assert max(r["batch"] for r in tr) == (len(tr) - 1) // 4
    # rare terms are dropped, documents are not
    space = {"n_estimators": se.Grid(2, 3, 2), "max_depth": se.Grid(2, 3, 2)}
    res = flows.tfidf_classification(spark, c, ["toxic"], n_min=1, n_max=2, min_df=40, n_iter=2, space=space, boosted_space=space)
    assert res["features"].count() == c.count()
    assert sum(r["n"] for r in res["confusion"].collect()) == res["predictions"].count() == res["boosted_predictions"].count()


def test_decode_and_format(spark):
    df = spark.createDataFrame([(bytearray("não".encode("utf-8")), 0.8156)], "b binary, x double")
    r = df.select(tx.decode_utf8("b").alias("s"), tx.format3("x").alias("f")).first()
    assert r["s"] == "não" and r["f"] == "0.816"


def test_csv_quoted_newlines_and_key(spark, tmp_path):
    from lexicarve.sources import corpus as src
    p = tmp_path / "labelled.csv"
    p.write_text('text,v1,v2\n"linha um, com vírgula\nsegunda linha",1,0\n"diz ""oi""",0,\n', encoding="utf-8")
    df = src.read_labelled_csv(spark, str(p), src.labelled_schema(["v1", "v2"]))
    rows = df.orderBy("doc_id").collect()
    assert [r["text"] for r in rows] == ["linha um, com vírgula\nsegunda linha", 'diz "oi"']
    assert rows[0]["doc_id"] < rows[1]["doc_id"]  # key follows file order
    lab = df.select(lb.any_vote(["v1", "v2"]).alias("y")).orderBy(F.monotonically_increasing_id())
    assert [r["y"] for r in lab.collect()] == [1, 0]


def test_csv_key_of_several_files(spark, tmp_path):
    from lexicarve.sources import corpus as src
    for name, words in (("b.csv", ["x", "y"]), ("a.csv", ["u", "v", "w"])):
        (tmp_path / name).write_text("text,v1\n" + "".join(f"{w},1\n" for w in words), encoding="utf-8")
    df = src.read_labelled_csv(spark, str(tmp_path), src.labelled_schema(["v1"]))
    keys = {r["text"]: r["doc_id"] for r in df.collect()}
    assert sorted(keys, key=keys.get) == ["u", "v", "w", "x", "y"] and len(set(keys.values())) == 5
    assert keys == {r["text"]: r["doc_id"] for r in df.collect()}
    assert keys["u"] == 0 and keys["x"] == 1 << 40


def test_no_temp_folder_on_a_cluster():
    from types import SimpleNamespace
    from lexicarve.session import checkpoint_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: SimpleNamespace(get=lambda k: None), master="spark://host:7077")
    with pytest.raises(RuntimeError):
        checkpoint_dir(SimpleNamespace(sparkContext=sc))
