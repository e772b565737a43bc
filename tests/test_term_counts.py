"""Term counts and frequencies: every row shape against plain Python, and what their plans move."""

from collections import Counter, defaultdict

import pytest

from lexicarve.operators import encode as en
from lexicarve.operators import tfidf as tf
from lexicarve.operators.positions import stored_index

ROWS = [(1, "uma casa amarela grande casa amarela grande uma casa"), (1, "casa amarela nova uma casa"), (2, "x"), (3, ""), (4, None),
        (None, "casa amarela"), (None, "casa amarela grande! grande! casa"), (5, "a1 a1 a1 a1 a1 a1"), (6, "a1 a1 a1"), (7, "nova casa amarela grande uma")]


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string")


def words(text):
    import pyspark.sql.functions as F
    return F.filter(F.split(F.coalesce(text, F.lit("")), " "), lambda t: t != "")


def plain(n_min, n_max):
    counts = Counter()
    for k, t in ROWS:
        w = (t or "").split()
        counts.update((k, " ".join(w[i:i + n])) for n in range(n_min, n_max + 1) for i in range(len(w) - n + 1))
    return counts


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n_min,n_max", [(1, 4), (1, 1), (2, 3), (3, 4), (2, 2)])
def test_counts_with_repeated_and_null_keys(docs, n_min, n_max):
    want = plain(n_min, n_max)
    got = tf.term_frequency(docs, tokenizer=words, n_min=n_min, n_max=n_max).collect()
    assert sorted(map(repr, got)) == sorted(repr(type(got[0])(doc_id=k, term=t, tf=n)) for (k, t), n in want.items())
    df = defaultdict(int)
    for _, t in want:
        df[t] += 1
    freq = tf.corpus_frequency(docs, tokenizer=words, n_min=n_min, n_max=n_max).collect()
    assert len(freq) == len(df) and {r["term"]: r["df"] for r in freq} == df


def test_ngrams_are_not_shuffled_for_counts(docs):
    """Only the key deals the rows: no exchange by (key, term)."""
    p = plan(tf.term_frequency(docs))
    moves = [x for x in p.splitlines() if "Exchange hashpartitioning" in x]
    assert moves and all("term" not in x for x in moves)


def test_windows_travel_once(docs):
    """Longer n-grams are read off windows dealt by their first words; only single words are combined by term."""
    p = plan(tf.corpus_frequency(docs))
    moves = [x for x in p.splitlines() if "Exchange hashpartitioning" in x and "term" in x.split("hashpartitioning", 1)[1].split(",")[0]]
    assert len(moves) == 1 and "hashpartitioning(head" in p


def test_encoding_gathers_where_it_was_dealt(spark):
    """With a vocabulary small enough to broadcast, tokens are not moved by word nor gathered by another shuffle."""
    d = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, None), (None, ["a"])], "doc_id long, tokens array<string>")
    v = en.word_vocabulary(d)
    enc = en.encode_words(d, v)
    assert {r["doc_id"]: r["input_ids"] for r in enc.collect()} == {1: [2, 5, 4, 5, 3], 2: [2, 3], 3: [2, 3], None: [2, 3]}
    p = plan(en.encode_words(d, v))
    assert "hashpartitioning(token" not in p and p.count("Exchange hashpartitioning(doc_id") <= 2


def test_stored_index_moves_a_row_once(spark):
    """The order columns are not copied beside the row; helper names may be the caller's."""
    d = spark.createDataFrame([("b", 1, 2), ("a", 2, 1), (None, 3, 0)], "row string, held int, part int")
    got = stored_index(d, ["row"], name="at").orderBy("at").collect()
    assert [tuple(r) for r in got] == [(None, 3, 0, 0), ("a", 2, 1, 1), ("b", 1, 2, 2)]


def exchanges(df):
    return str(df._jdf.queryExecution().executedPlan().toString()).split("Initial Plan")[-1].count("Exchange hashpartitioning")


@pytest.mark.parametrize("n_min, n_max", [(1, 4), (1, 1), (2, 3)])
def test_counts_and_frequencies_of_one_corpus_meet_where_windows_arrive(docs, n_min, n_max):
    """Texts, windows and weights are shuffled once each; no n-gram is joined. The rows are those of counts joined with frequencies."""
    counts = tf.corpus_counts(docs, n_min=n_min, n_max=n_max)
    two = tf.term_frequency(docs, n_min=n_min, n_max=n_max)
    want = sorted(map(tuple, two.join(tf.document_frequency(two), "term").select("doc_id", "term", "tf", "df").collect()), key=repr)
    assert sorted(map(tuple, counts.select("doc_id", "term", "tf", "df").collect()), key=repr) == want
    if n_min == 2:
        assert exchanges(tf.weighted(counts, tf.F.lit(9.0))) == 3 and "Join" not in counts._jdf.queryExecution().executedPlan().toString()


def test_distinct_terms_are_not_shuffled_again(docs, monkeypatch):
    seen = []
    one = tf.terms(docs)
    monkeypatch.setattr(tf, "shared", lambda df, name: seen.append(exchanges(df)) or df)
    monkeypatch.setattr(tf, "stored_index", lambda df, *a, **k: df)
    monkeypatch.setattr(tf, "discard", lambda df: None)
    assert sorted(r["term"] for r in tf.vocabulary(one, distinct=True).collect()) == sorted({r["term"] for r in one.collect()})
    tf.vocabulary(one)
    assert seen[0] < seen[1]
