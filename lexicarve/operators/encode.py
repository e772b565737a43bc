"""Token-id encoding for neural features.

E1 (whole word): the vocabulary is a Spark job (distinct words, sorted,
numbered after the special ids); documents are dealt by key, ids are
attached by a join on the word (a vocabulary that Spark does not broadcast
is shuffled, and AQE splits hot words) and gathered back per document in
position order. Padding, truncation, masks and segment ids are array expressions.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import arrays as ar
from ..functions import text as tx
from ..functions.lexicon import CLS_ID, FIRST_WORD_ID, SEP_ID, UNK_ID
from ..session import shared
from .positions import stored_index
from .text import collect_tokens, dealt_by_key, explode_tokens


def word_vocabulary(tokens_df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """(token, id): distinct tokens in sorted order, ids from FIRST_WORD_ID."""
    words = tokens_df.select(F.explode_outer(tokens_col).alias("token")).where(F.col("token").isNotNull()).distinct()
    v = stored_index(shared(words, "words"), ["token"], name="_i")
    # written, so that its size is known and Spark can broadcast a small one
    return shared(v.select("token", (F.col("_i") + F.lit(FIRST_WORD_ID)).alias("id")), "word-ids")


def encode_words(tokens_df: DataFrame, vocab: DataFrame, key: str = "doc_id",
                 tokens_col: str = "tokens", out: str = "input_ids") -> DataFrame:
    """[CLS] id(w1) ... id(wn) [SEP]; unknown words get UNK_ID; empty docs give [CLS, SEP]."""
    long = explode_tokens(dealt_by_key(tokens_df.select(key, tokens_col), key), key, tokens_col)
    ided = (long.join(vocab, "token", "left")
                .select(key, "pos", F.coalesce(F.col("id"), F.lit(UNK_ID)).alias("token")))
    ids = collect_tokens(ided, key, out="_ids")
    base = tokens_df.select(key).join(ids, key, "left")
    body = F.coalesce(F.col("_ids"), F.array().cast("array<bigint>"))
    return base.select(key, F.concat(F.array(F.lit(CLS_ID).cast("long")), body, F.array(F.lit(SEP_ID).cast("long"))).alias(out))


def pad_to_longest(df: DataFrame, ids: str = "input_ids", out: str = "padded") -> DataFrame:
    """E2 + A5: right-pad every row with 0 to the longest row of the frame (scalar subquery).

    One very long row makes every row that long. Keep ids ragged between
    steps and pad a batch at a time at the model boundary, or use E3; this
    is for frames whose longest row is known to be short.
    """
    longest = df.select(F.max(F.size(ids))).scalar()
    return df.withColumn(out, ar.pad_right(ids, longest))


def fixed_length(df: DataFrame, ids: str = "input_ids", max_len: int = 512, out: str = "padded") -> DataFrame:
    """Truncate to ``max_len`` keeping the end marker, then pad to ``max_len``."""
    return df.withColumn(out, ar.pad_right(ar.truncate_keep_end(ids, max_len), max_len))


def examples(df: DataFrame, padded: str = "padded", label: str | None = "label",
             key: str = "doc_id") -> DataFrame:
    """E4 + E5 + E6 (+E7 composition): (key, features struct, label)."""
    feats = ar.example_struct(F.col(padded), ar.segment_ids(padded), ar.attention_mask(padded)).alias("features")
    cols = [key, feats] + ([F.col(label).cast("int").alias("label")] if label else [])
    return df.select(*cols)


def padded_width(df: DataFrame, ids: str = "input_ids") -> DataFrame:
    """E2 without the padding: adds ``padded_len`` (A5), and ``n_real``, the part that is not padding."""
    return df.withColumn("padded_len", df.select(F.max(F.size(ids))).scalar()).withColumn("n_real", F.size(ids))


def encode_examples(df: DataFrame, vocab: DataFrame, label: str | None = "label", limit: int = -1, max_len: int = 512,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """The first ``limit`` rows by key (all rows unless it is positive) as encoded examples.

    ``text`` holds UTF-8 bytes, as a dataset iterator gives them (T12), or strings.
    """
    rows = df.orderBy(key).limit(limit) if limit > 0 else df
    c = tx.decode_utf8(text) if isinstance(df.schema[text].dataType, T.BinaryType) else F.col(text)
    words = rows.select(key, tx.word_tokens(tx.preprocess(c)).alias("tokens"))
    enc = encode_words(words, vocab, key)
    if label:
        enc = enc.join(rows.select(key, label), key)
    return examples(fixed_length(enc, "input_ids", max_len), "padded", label, key)


def timed_step(df: DataFrame, step: str) -> tuple[DataFrame, DataFrame]:
    """Writes a step's result and measures it: (result, one row (step, n_rows, n_batches, seconds)).

    The time is that of the writing job. The counts are read from the
    written ``batch`` column alone, so the step's own work runs once.
    (``DataFrame.observe`` is not used: once a session has an observation,
    Spark ML fits in it fail, as their tasks cannot be serialised.)
    """
    started = time.monotonic()
    out = shared(df, step)
    took = time.monotonic() - started
    # the largest number, not a distinct count: batches are numbered without gaps
    m = out.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("batch") + 1, F.lit(0)).alias("b")).first()
    return out, df.sparkSession.createDataFrame([(step, int(m["n"]), int(m["b"]), took)], "step string, n_rows long, n_batches long, seconds double")


def first_position(states: Column | str) -> Column:
    """E8 slice: the vector at sequence position 0 of a (positions x width) matrix."""
    s = F.col(states) if isinstance(states, str) else states
    return F.element_at(s, 1)


def score_in_batches(df: DataFrame, load_model: Callable[[], Callable[[pd.DataFrame], pd.Series]],
                     out_schema: str, batch_rows: int = 64) -> DataFrame:
    """E8 scoring: ``mapInPandas`` with the model loaded once per task and fixed-size batches.

    ``load_model()`` returns a function from a pandas batch to a Series of
    outputs; ``out_schema`` is the input schema plus the output column.
    Batch size bounds memory where the reference pushed the whole corpus
    through the encoder in one call.
    """
    out_col = out_schema.split(",")[-1].strip().split(" ")[0]

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for pdf in it:
            for s in range(0, len(pdf), batch_rows):
                part = pdf.iloc[s:s + batch_rows].copy()
                part[out_col] = model(part).values
                yield part

    return df.mapInPandas(run, out_schema)
