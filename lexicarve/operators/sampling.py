"""Balanced samples, hold-outs, heads, splits, shuffles, batches, folds.

Positional selections go through :mod:`.positions`: a bucket count and a
comparison with boundary values, never a class-wide window, and no job
runs while a query is being defined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .positions import kth_rows, positional_index, rank_range, sorted_index


def balanced_sample(df: DataFrame, label: str, n: int, key: str = "doc_id") -> DataFrame:
    """First ``n`` rows (by ``key``) of every class; a short class gives what it has."""
    return rank_range(df, key, 1, n, group=[label])


def holdout(df: DataFrame, label: str, start: int, n: int, key: str = "doc_id") -> DataFrame:
    """Zero-based rows ``[start, start + n)`` of every class (disjoint from W1 when start >= N)."""
    return rank_range(df, key, start + 1, start + n, group=[label])


def head(df: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    """L1: first ``n`` rows by ``key`` (``n <= 0``: all rows, as ``take`` only runs for a positive limit)."""
    return df if n <= 0 else df.orderBy(key).limit(n)


def stack(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name, duplicates kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def reset_index(df: DataFrame, order: Sequence[str], name: str = "row") -> DataFrame:
    """New 0-based row number in the given order; existing columns (the old key) are kept."""
    return sorted_index(df, order, name=name)


def ordered_split(df: DataFrame, fraction: float = 0.85, order: str | Sequence[str] = "doc_id", name: str = "slice",
                  stratify: str | None = None) -> DataFrame:
    """L2: the first ``floor(fraction * n)`` rows in ``order`` are 'train', the rest 'test'.

    The reference splits the class-stacked order, i.e. ``order=[class,
    key]``: the end of the last class becomes the test part. With
    ``stratify`` the same fraction is taken from the start of every class.
    """
    order = [order] if isinstance(order, str) else list(order)
    g = [stratify] if stratify else []
    last = kth_rows(df, order, F.array(F.floor(F.col("_size") * F.lit(float(fraction)))), g)
    if g:
        ends = last.select(F.col(stratify).alias("_g"), F.col("_at").alias("_end"))
        out = df.join(ends, df[stratify].eqNullSafe(ends["_g"]), "left").withColumn("_e", F.col("_end")).drop("_g", "_end")
    else:
        out = df.withColumn("_e", last.agg(F.max("_at")).scalar())
    train = F.col("_e").isNotNull() & (F.struct(*order) <= F.col("_e"))
    return out.withColumn(name, F.when(train, F.lit("train")).otherwise(F.lit("test"))).drop("_e")


def hash_fraction_key(key: str, seed: int) -> "F.Column":
    """Stateless pseudo-random key in [0, 2^32): first 8 hex digits of md5(key || '-' || seed)."""
    h = F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}"))), 1, 8)
    return F.conv(h, 16, 10).cast("long")


def random_split(df: DataFrame, test_fraction: float = 0.2, seed: int = 42, key: str = "doc_id",
                 name: str = "slice") -> DataFrame:
    """L3: portable seeded split; a row is 'test' when its md5 key falls below the fraction."""
    thr = int(test_fraction * (1 << 32))
    return df.withColumn(name, F.when(hash_fraction_key(key, seed) < thr, F.lit("test"))
                                 .otherwise(F.lit("train")))


def shuffle_order(df: DataFrame, seed: int = 42, key: str = "doc_id", name: str = "shuffle_rn") -> DataFrame:
    """L4: full seeded shuffle; ``name`` is the 1-based position in the order of (md5 key, key)."""
    out = df.withColumn("_shuffle_key", hash_fraction_key(key, seed))
    return positional_index(out, ["_shuffle_key", key], name=name).drop("_shuffle_key")


def buffered_shuffle(df: DataFrame, buffer: int = 10_000, seed: int = 42, key: str = "doc_id", name: str = "shuffle_rn") -> DataFrame:
    """L4 as the reference's input pipeline does it: a sliding buffer over the rows in order of ``key``.

    The buffer holds ``buffer`` rows. Step t gives out the row in slot
    hash(seed, t) mod buffer and fills the slot with the next row; when no
    row is left, the slots are given out in order of a hash of the slot.
    ``name`` is the 1-based position of a row in what is given out.

    The draws do not depend on the rows, so the process need not run in
    one place: row p (from 0) of the input enters the slot that step
    p - buffer gives out, and leaves at the next step that draws the same
    slot, which is a lead over the steps of a slot. Slots get equal shares
    of the rows; at most ``buffer`` rows are ordered together at the end.
    Rows of equal key take neighbouring places in any order.
    """
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{key}`").alias("key"))
    rows = positional_index(whole, "key", name="_p").withColumn("_t", F.col("_p") - 1 - F.lit(buffer))
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}-step-"), F.col("_t").cast("string"))), 1, 8), 16, 10).cast("long") % buffer
    rows = rows.withColumn("_slot", F.when(F.col("_t") < 0, F.col("_p") - 1).otherwise(drawn))
    rows = rows.withColumn("_out", F.lead("_t").over(Window.partitionBy("_slot").orderBy("_t")))
    steps = df.select(F.greatest(F.count(F.lit(1)) - F.lit(buffer), F.lit(0))).scalar()
    left = rows.where("_out is null").withColumn("_h", F.md5(F.concat(F.lit(f"{seed}-slot-"), F.col("_slot").cast("string"))))
    left = left.withColumn(name, (steps + F.row_number().over(Window.orderBy("_h", "_slot"))).cast("long"))
    given = rows.where("_out is not null").withColumn(name, (F.col("_out") + 1).cast("long"))
    return given.select("row.*", name).unionByName(left.select("row.*", name))


def batches(df: DataFrame, order_col: str, size: int = 64, name: str = "batch") -> DataFrame:
    """0-based batch id from a 1-based position column; the last batch may be short."""
    return df.withColumn(name, F.floor((F.col(order_col) - 1) / F.lit(size)).cast("long"))


def stratified_folds(df: DataFrame, label: str, k: int = 5, key: str = "doc_id", name: str = "fold") -> DataFrame:
    """``ntile(k) - 1`` over (partition by label order by key), without a class-wide window."""
    r = positional_index(df, key, [label], name="_rn", with_group_size="_cnt")
    q = F.floor(F.col("_cnt") / k)
    rem = F.col("_cnt") - q * k
    big = rem * (q + 1)
    fold = F.when(F.col("_rn") <= big, F.floor((F.col("_rn") - 1) / (q + 1))) \
            .otherwise(rem + F.floor((F.col("_rn") - 1 - big) / q))
    return r.withColumn(name, fold.cast("int")).drop("_rn", "_cnt")
