"""Sub-word encoding with a given vocabulary (E1) and length-grouped batches.

Words are cut by greedy longest match from the left: the longest piece of
the vocabulary that starts the rest of the word is taken, again and again.
Texts are not moved: a task has the vocabulary, which is given and small,
as a dictionary, and cuts each distinct word of a batch once, in Python, as
Spark has no built-in for a longest match.

The vocabulary is a table (piece, id). Pieces that end a word carry
``END`` as their last character, as the words do while they are cut.
Vocabularies are given, never trained.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays as ar
from ..session import shared
from .positions import stored_index

END = "\ue000"  # private-use character in place of a file's own end-of-word mark
MAX_CHARS = 100  # longer words are unknown as a whole


def vocabulary_file(spark: SparkSession, path: str, end_mark: str = "</w>") -> DataFrame:
    """(piece, id) of a tokenizer file in JSON whose ``model.vocab`` maps pieces to ids."""
    whole = spark.read.text(path, wholetext=True)
    pairs = F.from_json(F.get_json_object("value", "$.model.vocab"), "map<string,int>")
    v = whole.select(F.explode(pairs).alias("piece", "id"))
    ends = F.endswith(F.col("piece"), F.lit(end_mark))
    return v.select(F.when(ends, F.concat(F.substring("piece", F.lit(1), F.length("piece") - len(end_mark)), F.lit(END))).otherwise(F.col("piece")).alias("piece"),
                    F.col("id").cast("long").alias("id"))


def _cutter(pieces: dict[str, int], unknown: int, max_chars: int):
    """A function that gives the piece ids of a word."""
    longest = max(map(len, pieces), default=0)

    def cut(word: str | None) -> list[int]:
        if not word:
            return []
        t, at, ids = word + END, 0, []
        while at < len(t) and len(word) <= max_chars:
            hit = next((n for n in range(min(longest, len(t) - at), 0, -1) if t[at:at + n] in pieces), None)
            if hit is None:
                break
            ids.append(pieces[t[at:at + hit]])
            at += hit
        return ids if at == len(t) else [unknown]

    return cut


def _sent(vocab: DataFrame):
    """The vocabulary, which is given and as small as a model's table of pieces, for all tasks."""
    rows = vocab.groupBy("piece").agg(F.max("id").alias("id")).where(F.col("piece").isNotNull()).toArrow()
    return vocab.sparkSession.sparkContext.broadcast(dict(zip(rows.column("piece").to_pylist(), rows.column("id").to_pylist())))


def cut_lists(df: DataFrame, key: str, tokens_col: str, sent, unknown: int, max_chars: int = MAX_CHARS, flat: bool = True) -> DataFrame:
    """(key, ids): the piece ids of a list of words, in their order; without ``flat`` a list for every word. No row is moved.

    In a batch each distinct word is cut once.
    """
    d = df.select(F.col(key).alias("k"), F.col(tokens_col).alias("t"))

    def run(batches):
        cut = _cutter(sent.value, unknown, max_chars)
        for b in batches:
            col = b.column(1)
            words = col.flatten().dictionary_encode()
            ids = [np.array(cut(w), np.int64) for w in words.dictionary.to_pylist()] + [np.zeros(0, np.int64)]  # the last is that of a null
            which = words.indices.fill_null(len(ids) - 1).to_numpy(zero_copy_only=False).astype(np.int64)
            size = np.array([len(x) for x in ids])
            first, length = (np.cumsum(size) - size)[which], size[which]
            ends = np.concatenate(([0], np.cumsum(length)))
            value = np.concatenate(ids)[np.repeat(first - ends[:-1], length) + np.arange(ends[-1])]
            words_to = np.concatenate(([0], np.cumsum(col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))).astype(np.int64)
            if flat:
                out = pa.ListArray.from_arrays(pa.array(ends[words_to], pa.int32()), pa.array(value))
            else:
                out = pa.ListArray.from_arrays(pa.array(words_to, pa.int32()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(value)))
            yield pa.RecordBatch.from_arrays([b.column(0), out], names=["k", "ids"])

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    kind = d.schema["k"].dataType.simpleString()
    return d.mapInArrow(run, f"k {kind}, ids {'array<bigint>' if flat else 'array<array<bigint>>'}").withColumnRenamed("k", key)


def cut_words(words: DataFrame, vocab: DataFrame, unknown: int, token: str = "token", max_chars: int = MAX_CHARS) -> DataFrame:
    """(token, ids): the piece ids of each distinct word; ``[unknown]`` where no cut reaches the word's end.

    A null or empty word has no ids.
    """
    w = words.select(F.col(token).alias("token")).where(F.col("token").isNotNull() & (F.col("token") != "")).distinct()
    return cut_lists(w.withColumn("one", F.array("token")), "token", "one", _sent(vocab), unknown, max_chars)


def encode_subwords(tokens_df: DataFrame, vocab: DataFrame, begin: int, end: int, unknown: int, key: str = "doc_id",
                    tokens_col: str = "tokens", out: str = "input_ids") -> DataFrame:
    """[begin] pieces of word 1 ... pieces of word n [end]; a document without words, or without a key, gives [begin, end].

    Rows that share a key are one document, whose words are in the order of
    their positions and ids; only such rows are moved.
    """
    sent = _sent(vocab)
    repeated = shared(tokens_df.select(key).where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key), "subword-repeated")
    one = lambda v: F.array(F.lit(v).cast("long"))
    framed = lambda ids: F.concat(one(begin), ids, one(end)).alias(out)
    words = F.when(F.col(key).isNotNull(), F.col(tokens_col)).alias(tokens_col)
    if repeated.isEmpty():
        return cut_lists(tokens_df.select(key, words), key, tokens_col, sent, unknown).select(key, framed(F.col("ids")))
    alone = cut_lists(tokens_df.join(repeated, key, "left_anti").select(key, words), key, tokens_col, sent, unknown)
    many = tokens_df.join(repeated, key, "left_semi")
    each = cut_lists(many, key, tokens_col, sent, unknown, flat=False).select(key, F.posexplode("ids").alias("pos", "ids"))
    body = each.groupBy(key).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", "ids"))), lambda x: x["ids"])).alias("ids"))
    merged = many.select(key).join(body, key, "left").select(key, F.coalesce("ids", F.array().cast("array<bigint>")).alias("ids"))
    return alone.unionByName(merged).select(key, framed(F.col("ids")))


def length_batches(df: DataFrame, key: str = "doc_id", ids: str = "input_ids", batch: int = 64, out: str = "padded") -> DataFrame:
    """E2 + E4 + L5: rows in order of length, in batches of ``batch``, each padded with 0 to its own longest row.

    Adds ``batch`` (from 0), ``width``, ``padded`` and ``attention_mask``.
    A batch only holds neighbours in length, so padding stays small at any
    skew, and one very long row widens only its own batch. Rows of equal
    length are ordered by key. A null list counts as empty.
    """
    d = df.withColumn(ids, F.coalesce(F.col(ids), F.array().cast(df.schema[ids].dataType))).withColumn("n_ids", F.size(ids))
    d = shared(d, "length-batches")  # numbering reads it more than once
    numbered = stored_index(d.select(key, "n_ids"), ["n_ids", key], name="rank").withColumn("batch", F.floor(F.col("rank") / batch))
    width = numbered.groupBy("batch").agg(F.max("n_ids").alias("width"))
    placed = numbered.join(width, "batch").select(key, "batch", "width")
    padded = d.drop("n_ids").join(placed, key).withColumn(out, ar.pad_right(F.col(ids), F.col("width")))
    return padded.withColumn("attention_mask", ar.attention_mask(out))
