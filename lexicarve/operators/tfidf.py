"""TF-IDF as relational operators.

Smoothed idf ``ln((1 + N) / (1 + df)) + 1`` times the raw count, then
L2-normalised per document; Spark ML's ``IDF`` has no ``+ 1`` and no norm,
so it is not used.

Plan at scale: texts move once, by key, to tell rows that share one. Tokens
and n-grams are made and counted inside the row, so n-grams are not
shuffled for the counts. Document frequencies come from the texts: only
their distinct windows of the longest length travel, and shorter n-grams
are read off them where they arrive. ``tfidf`` over one corpus sends each
window once, with its document, and finds counts and frequencies where it
arrives, so neither is written or joined but for single words, of which
there are few. Where counts and frequencies are of different corpora, both
are written and joined on the term, and AQE can split a hot term. The norm
is a window by document, whose size is bounded by the document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..session import discard, free_shuffles, scratch_path, shared, shuffle_partitions
from .positions import stored_index
from .text import dealt_by_key, ngram_arrays


def default_tokenizer(text: Column) -> Column:
    """F2 default: fold, lower, tokenise, drop stop words, lemmatise."""
    return tx.lemmatize(tx.remove_stop_words(tx.tokenize(tx.normalise(text))))


def _by_row(docs: DataFrame, key: str, text: str, tokenizer: Callable[[Column], Column]) -> DataFrame:
    """(key, _same, _tok): the tokens of every row, and how many rows share its key. Texts move once, by key."""
    d = dealt_by_key(docs.select(key, F.col(text).alias("_text")), key).withColumn("_same", F.count(F.lit(1)).over(Window.partitionBy(key)))
    return d.select(key, "_same", tokenizer(F.col("_text")).alias("_tok"))


def term_frequency(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   tokenizer: Callable[[Column], Column] = default_tokenizer,
                   n_min: int = 1, n_max: int = 4) -> DataFrame:
    """(key, term, tf) over word n-grams of the tokenised text.

    A row's n-grams are sorted and counted inside the row, so they are not
    shuffled. Only rows that share their key are added up by (key, term).
    """
    grams = ngram_arrays(_by_row(docs, key, text, tokenizer), "_tok", n_min, n_max, out="_grams")
    d = grams.select(key, "_same", F.sort_array("_grams").alias("_s"))
    places = F.when(F.size("_s") > 0, F.sequence(F.lit(0), F.size("_s") - 1)).otherwise(F.array().cast("array<int>"))
    d = d.withColumn("_at", F.filter(places, lambda i: (i == 0) | (F.get("_s", i) != F.get("_s", i - 1))))  # where a term begins
    runs = F.transform("_at", lambda i, j: F.struct(F.get("_s", i).alias("term"), (F.coalesce(F.get("_at", j + 1), F.size("_s")) - i).cast("long").alias("tf")))
    # explode_outer: a plain explode lets Catalyst infer ``size(...) > 0``
    # and push it under the projection, re-running the tokenizer per n.
    rows = d.select(key, "_same", F.explode_outer(runs).alias("_t")).where(F.col("_t").isNotNull()).select(key, "_same", "_t.term", "_t.tf")
    again = rows.where("_same > 1").groupBy(key, "term").agg(F.sum("tf").alias("tf"))
    return rows.where("_same = 1").select(key, "term", "tf").unionByName(again)


def document_frequency(tf: DataFrame) -> DataFrame:
    """(term, df)."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def corpus_frequency(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: Callable[[Column], Column] = default_tokenizer,
                     n_min: int = 1, n_max: int = 4) -> DataFrame:
    """A7 from the texts: (term, df), the same rows as ``document_frequency(term_frequency(...))``.

    Instead of all its n-grams a text sends its distinct windows of
    ``n_max`` words (shorter at its end) in word order, each with the length
    of the shortest beginning that the window before it lacks. Beginnings of
    that length or more are new to the text and count one, so every n-gram
    of a text counts once. Windows are dealt by their first words, which
    all beginnings share. Rows that share their key are counted as one
    text. Tokens hold no blank.
    """
    d = _by_row(docs, key, text, tokenizer)
    one, many = d.where("_same = 1"), d.where("_same > 1")
    grams = ngram_arrays(many, "_tok", n_min, n_max, out="_grams")
    again = grams.select(key, F.explode_outer("_grams").alias("term")).where(F.col("term").isNotNull()).distinct()
    parts = []
    if n_min == 1:
        own = one.select(F.explode_outer(F.array_distinct("_tok")).alias("term")).where(F.col("term").isNotNull())
        words = again.where(~F.contains("term", F.lit(" "))).select("term")
        parts.append(own.unionByName(words).groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    if n_max > 1:
        head = max(2, n_min)
        starts = F.when(F.size("_tok") >= head, F.sequence(F.lit(1), F.size("_tok") - (head - 1))).otherwise(F.array().cast("array<int>"))
        w = one.select(F.array_sort(F.array_distinct(F.transform(starts, lambda i: F.slice("_tok", i, n_max)))).alias("_w"))

        def shortest(x: Column, i: Column) -> Column:
            before, out = F.get("_w", i - 1), F.lit(head)
            for n in range(head, n_max):
                out = out + F.when((i > 0) & (F.slice(x, 1, n) == F.slice(before, 1, n)), 1).otherwise(0)
            return out

        sent = F.transform("_w", lambda x, i: F.struct(F.array_join(F.slice(x, 1, head), " ").alias("head"), F.array_join(x, " ").alias("term"), shortest(x, i).alias("k")))
        sent = w.select(F.explode_outer(sent).alias("s")).where(F.col("s").isNotNull()).select("s.*")
        size = F.size(F.split("term", " "))
        sent = sent.unionByName(again.where(size >= head).select(F.substring_index("term", " ", head).alias("head"), "term", size.alias("k")))
        # one shuffle: the grouping below finds its rows dealt by head already; more parts than usual, as beginnings are four times the windows
        dealt = sent.repartition(4 * shuffle_partitions(docs.sparkSession), "head")
        dealt = dealt.select("head", "term", F.explode_outer(F.sequence("k", size)).alias("n")).select("head", F.call_function("substring_index", "term", F.lit(" "), "n").alias("term"))
        parts.append(dealt.groupBy("head", "term").agg(F.count(F.lit(1)).alias("df")).select("term", "df"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def corpus_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: Callable[[Column], Column] = default_tokenizer,
                  n_min: int = 1, n_max: int = 4) -> DataFrame:
    """A6 + A7: (key, term, tf, df) of one corpus.

    Every position of a text sends its window of ``n_max`` words (shorter at
    its end) with the key to the task of its first words, where it counts
    for all its beginnings; there all documents of a term meet. Single words
    are counted where the text is, and join their own small table. Rows that
    share their key are counted as one text. Tokens hold no blank. The
    counts of single words are written when this is called.
    """
    d = dealt_by_key(docs.select(key, F.col(text).alias("_text")), key).select(key, tokenizer(F.col("_text")).alias("_tok"))
    parts = []
    if n_min == 1:
        # dealt by key, so the words are counted without a shuffle
        words = d.select(key, F.explode_outer("_tok").alias("term")).where(F.col("term").isNotNull()).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
        words = shared(words, "tf-words")
        parts.append(words.join(shared(document_frequency(words), "df-words"), "term").select(key, "term", "tf", "df"))
    if n_max > 1:
        head = max(2, n_min)
        starts = F.when(F.size("_tok") >= head, F.sequence(F.lit(1), F.size("_tok") - (head - 1))).otherwise(F.array().cast("array<int>"))
        sent = d.select(key, F.explode_outer(F.transform(starts, lambda i: F.array_join(F.slice("_tok", i, n_max), " "))).alias("term")).where(F.col("term").isNotNull())
        first, size = F.substring_index("term", " ", head), F.size(F.split("term", " "))
        dealt = sent.repartition(4 * shuffle_partitions(docs.sparkSession), first).withColumn("head", first)  # the head does not travel
        each = dealt.select("head", key, "term", F.explode_outer(F.sequence(F.lit(head), size)).alias("n"))
        each = each.select("head", key, F.call_function("substring_index", "term", F.lit(" "), "n").alias("term"))
        tf = each.groupBy("head", "term", key).agg(F.count(F.lit(1)).alias("tf"))
        parts.append(tf.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("head", "term"))).select(key, "term", "tf", "df"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def terms(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: Callable[[Column], Column] = default_tokenizer,
          n_min: int = 1, n_max: int = 4) -> DataFrame:
    """The distinct terms of a corpus, without counts per document."""
    return corpus_frequency(docs, key, text, tokenizer, n_min, n_max).select("term")


def vocabulary(tf_or_df: DataFrame, name: str = "term_index", distinct: bool = False) -> DataFrame:
    """Distinct terms in sorted order, numbered from 0 (a long). The distinct terms are written once.

    A caller whose terms are ``distinct`` (as from ``terms``) saves their second shuffle.
    """
    once = tf_or_df.select("term") if distinct else tf_or_df.select("term").distinct()
    once = shared(once, "terms")
    free_shuffles(once.sparkSession)
    out = stored_index(once, ["term"], name=name)
    discard(once)
    return out


def indexed_frequency(tf_or_df: DataFrame, name: str = "term_index") -> DataFrame:
    """A7 + A8: (term, df, term_index) from term counts or document frequencies; one join on the term brings both to the counts."""
    dfreq = tf_or_df if "df" in tf_or_df.columns else document_frequency(tf_or_df)
    return stored_index(shared(dfreq, "df"), ["term"], name=name)


def tfidf(docs: DataFrame, key: str = "doc_id", text: str = "text",
          tokenizer: Callable[[Column], Column] = default_tokenizer,
          n_min: int = 1, n_max: int = 4, fit_docs: DataFrame | None = None) -> DataFrame:
    """(key, term, tf, df, idf, tfidf) with smoothed idf and L2 norm per document.

    ``fit_docs`` (default: ``docs``) are the documents the idf is fitted
    on; the reference fits on all rows, pass the training part for a clean
    hold-out. Terms unseen in the fit set get no weight (as a fitted
    vocabulary would ignore them). Term counts and document frequencies of
    another fit set, or else the counts of single words, are written to the
    shared folder when this is called.
    """
    if fit_docs is None:
        return weighted(corpus_counts(docs, key, text, tokenizer, n_min, n_max), docs.select(F.count(F.lit(1)).cast("double")).scalar(), key)
    tf = shared(term_frequency(docs, key, text, tokenizer, n_min, n_max), "tf")
    dfreq = shared(corpus_frequency(fit_docs, key, text, tokenizer, n_min, n_max), "df")
    return weights(tf, dfreq, fit_docs.select(F.count(F.lit(1)).cast("double")).scalar(), key)


def weights(tf: DataFrame, dfreq: DataFrame, n_docs: Column, key: str = "doc_id") -> DataFrame:
    """J3 + T10 from written term counts and document frequencies."""
    return weighted(tf.join(dfreq, "term"), n_docs, key)


def weighted(counts: DataFrame, n_docs: Column, key: str = "doc_id") -> DataFrame:
    """T10 from (key, term, tf, df), with any further columns."""
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    # moved by key before the weights are worked out, so that the counts travel alone
    w = counts.repartition(key).withColumn("idf", idf).withColumn("_w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return w.withColumn("tfidf", F.col("_w") / norm).drop("_w")


def doc_norms(weighted: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document the L2 norm before normalising, and the squared norm after it."""
    raw = F.col("tf") * F.col("idf")
    return weighted.groupBy(key).agg(F.sqrt(F.sum(raw * raw)).alias("l2"), F.sum(F.col("tfidf") * F.col("tfidf")).alias("unit"))


def sparse_arrays(weighted: DataFrame, vocab: DataFrame, docs: DataFrame, key: str = "doc_id", col: str = "tfidf") -> DataFrame:
    """(key, size, indices, values), one row per document of ``docs``, also one without a term.

    Indices are longs in ascending order, so a vocabulary may pass 2^31.
    Weights that hold ``term_index`` already (from ``indexed_frequency``)
    are not joined with the vocabulary again.
    """
    size = vocab.agg(F.coalesce(F.max("term_index") + 1, F.lit(0))).scalar()
    placed = weighted if "term_index" in weighted.columns else weighted.join(vocab, "term")
    pairs = (placed.groupBy(key)
                     .agg(F.array_sort(F.collect_list(F.struct(F.col("term_index").alias("i"), F.col(col).cast("double").alias("v")))).alias("_p")))
    none = F.array().cast("array<struct<i:bigint,v:double>>")
    out = docs.select(key).join(pairs, key, "left").withColumn("_p", F.coalesce("_p", none))
    return out.select(key, size.alias("size"), F.transform("_p", lambda s: s["i"]).alias("indices"), F.transform("_p", lambda s: s["v"]).alias("values"))


def sparse_vectors(arrays: DataFrame, key: str = "doc_id", out: str = "features") -> DataFrame:
    """T11 for Spark ML: the same rows as ML sparse vectors, whose indices are 32-bit (a larger one is an error).

    The arrays are written as the vector type's storage struct and read
    back as vectors, so no row passes through Python.
    """
    path = scratch_path(arrays.sparkSession, "vectors")
    parts = F.struct(F.lit(0).cast("tinyint").alias("type"), F.col("size").cast("int").alias("size"),
                     F.transform("indices", lambda i: i.cast("int")).alias("indices"), F.col("values").alias("values"))
    arrays.select(key, parts.alias(out)).write.parquet(path)
    schema = T.StructType([T.StructField(key, arrays.schema[key].dataType), T.StructField(out, VectorUDT())])
    return arrays.sparkSession.read.schema(schema).parquet(path)
