"""Token pipelines over DataFrames.

Array-at-a-time column expressions do the per-document work; the long
(one row per token) form is used only where a dictionary is a table that
must be joined (J4).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.feature import NGram
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.lexicon import LEMMAS, STOP_WORDS
from ..session import shuffle_partitions


def tokens(df: DataFrame, text: str = "text", out: str = "tokens", stop_words: Iterable[str] | None = None,
           lemmas: Iterable[tuple[str, str]] | None = None, remove_stops: bool = True,
           lemmatize: bool = True, fold_list: bool = False) -> DataFrame:
    """T2 -> T3 -> T5 -> T7 -> T8b: normalised, tokenised, stop words out, lemmatised."""
    t = tx.tokenize(tx.normalise(text))
    if remove_stops:
        t = tx.remove_stop_words(t, stop_words, fold_list)
    if lemmatize:
        t = tx.lemmatize(t, lemmas)
    return df.withColumn(out, t)


def ngram_arrays(df: DataFrame, tokens_col: str = "tokens", n_min: int = 1, n_max: int = 4,
                 out: str = "grams") -> DataFrame:
    """All word n-grams, n in [n_min, n_max], as one array column.

    Uses ML ``NGram`` (one pass per n, JVM side). Nested higher-order
    lambdas followed by ``explode`` re-evaluate the tokenizer per element
    after Catalyst's generator-filter inference and must be avoided.
    """
    cols = []
    cur = df
    for n in range(n_min, n_max + 1):
        name = f"_g{n}"
        cur = NGram(n=n, inputCol=tokens_col, outputCol=name).transform(cur)
        cols.append(name)
    return cur.withColumn(out, F.concat(*[F.col(c) for c in cols])).drop(*cols)


def ngram_counts(df: DataFrame, key: str = "doc_id", tokens_col: str = "tokens",
                 n_min: int = 1, n_max: int = 4) -> DataFrame:
    """Per document and n: number of n-grams and the last of them."""
    out = df
    for n in range(n_min, n_max + 1):
        out = ngram_arrays(out, tokens_col, n, n, out=f"_grams{n}")
    cols = [c for n in range(n_min, n_max + 1)
            for c in (F.size(f"_grams{n}").alias(f"n{n}"), F.get(f"_grams{n}", F.size(f"_grams{n}") - 1).alias(f"last{n}"))]
    return out.select(key, *cols)


def dealt_by_key(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows dealt to tasks by key. Tokens exploded from them and gathered again by key stay where they are,
    unless a join in between has to move them."""
    return df.repartition(shuffle_partitions(df.sparkSession), key)


def explode_tokens(df: DataFrame, key: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """(key, pos, token), pos 0-based."""
    # *_outer + filter: keeps Catalyst from copying the token expression
    # into an inferred ``size(tokens) > 0`` filter below the projection.
    return (df.select(key, F.posexplode_outer(tokens_col).alias("pos", "token"))
              .where(F.col("pos").isNotNull()))


def collect_tokens(long: DataFrame, key: str = "doc_id", out: str = "tokens") -> DataFrame:
    """Inverse of :func:`explode_tokens`; one group per document (bounded by its length)."""
    return (long.groupBy(key)
                .agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("_pt"))
                .select(key, F.transform("_pt", lambda s: s["token"]).alias(out)))


def _literal_table(spark: SparkSession, rows: list[tuple[str, ...]], cols: list[str]) -> DataFrame:
    """A table of literals. Unlike one made from Python objects its size is known, so a join can broadcast it."""
    if not rows:
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in cols))
    quoted = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return spark.sql(f"SELECT * FROM VALUES {', '.join('(' + ', '.join(map(quoted, r)) + ')' for r in rows)} AS t({', '.join(cols)})")


def word_table(spark: SparkSession, words: Iterable[str], col: str = "token") -> DataFrame:
    return _literal_table(spark, [(w,) for w in sorted(set(words))], [col])


def lexicon_table(spark: SparkSession, pairs: Iterable[tuple[str, str]] | None = None) -> DataFrame:
    return _literal_table(spark, list(LEMMAS if pairs is None else pairs), ["token", "lemma"])


def drop_stop_words_table(long: DataFrame, stop: DataFrame) -> DataFrame:
    """``left_anti`` against a stop-word table; Spark broadcasts it by its measured size or not at all."""
    return long.join(stop, "token", "left_anti")


def lemmatize_table(long: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Left join to a (token, lemma) table, identity fallback."""
    j = long.join(lexicon, "token", "left")
    return j.withColumn("token", F.coalesce("lemma", "token")).drop("lemma")


def default_stop_table(spark: SparkSession) -> DataFrame:
    return word_table(spark, STOP_WORDS)


def clean_tokens_long(df: DataFrame, key: str = "doc_id", text: str = "text",
                      stop: DataFrame | None = None, lexicon: DataFrame | None = None) -> DataFrame:
    """T5 + J4 in long form: (key, pos, token) with stop words removed and lemmas applied."""
    spark = df.sparkSession
    t = df.select(key, tx.tokenize(tx.normalise(text)).alias("tokens"))
    long = explode_tokens(t, key)
    long = drop_stop_words_table(long, stop if stop is not None else default_stop_table(spark))
    return lemmatize_table(long, lexicon if lexicon is not None else lexicon_table(spark))

