"""Positional operators without a group-wide window and without a job before the action.

The reference addresses rows by position ("first N rows of class 1",
"rows 5001..5501", "first 85 %"). ``row_number() over (partition by class
order by key)`` would put a whole class - possibly a third of the data -
into one task. Here the order is cut at up to ``cuts`` sampled values, held
in one scalar subquery, so every use of a bucket sees the same cuts. A
partial aggregate counts rows per (group, bucket), a running sum over that
small table (at most groups x (cuts + 1) rows) gives each bucket's offset,
and only rows of one (group, bucket) are ordered together.

Any sortable columns can be the order: the cuts come from a sample chosen by
hash, so sparse 64-bit keys and strings are cut as evenly as dense
integers. Order columns should identify a row; rows that are equal in all
of them get neighbouring positions in any order. A null group is a group of
its own, and null order values come first. The frame is evaluated more than
once, so it must be deterministic; write an expensive one to the shared
folder first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared

CUTS = 1023


def sample_cuts(df: DataFrame, order: Sequence[str], cuts: int = CUTS) -> Column:
    """Sorted order values of the ``cuts`` rows with the smallest hash, as one scalar array."""
    s = df.select(F.struct(*order).alias("_s")).withColumn("_h", F.xxhash64("_s"))
    return s.orderBy("_h", "_s").limit(cuts).agg(F.array_sort(F.collect_list("_s"))).scalar()


def with_bucket(df: DataFrame, order: Sequence[str], cuts: Column, n: int = CUTS) -> DataFrame:
    """Adds ``_bkt``: how many cuts are at or below the row's order value (binary search)."""
    steps = [1 << i for i in reversed(range(max(1, n.bit_length())))]
    d = df.withColumn("_cuts", cuts).withColumn("_s", F.struct(*order))

    def climb(at: Column, step: Column) -> Column:
        return F.when(F.get("_cuts", at + step - 1) <= F.col("_s"), at + step).otherwise(at)

    return d.withColumn("_bkt", F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), climb)).drop("_cuts", "_s")


def _same(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    """Null-safe equality of ``cols`` with their prefixed twins in ``right``."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[f"_o_{c}"])
    return cond


def _twins(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"_o_{c}" for c in cols})


def bucket_offsets(bucketed: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """(group..., _bkt, _n, _off): rows per bucket and rows in earlier buckets of the group."""
    g = list(group)
    counts = bucketed.groupBy(*g, "_bkt").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*g).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)).cast("long"))


def kth_rows(df: DataFrame, order: Sequence[str], rank: Column, group: Sequence[str] = (),
             cuts: int = CUTS) -> DataFrame:
    """(group..., _k, _at): the order value (a struct) at each wanted 1-based rank of each group.

    ``rank`` is an array of ranks that may use ``_size``, the group's row
    count. A rank that a group does not reach gives no row.
    """
    g = list(group)
    cols = list(dict.fromkeys([*g, *order]))
    b = with_bucket(df.select(*cols), order, sample_cuts(df, order, cuts), cuts)
    offs = bucket_offsets(b, g).withColumn("_size", F.sum("_n").over(Window.partitionBy(*g)))
    hits = offs.withColumn("_k", F.explode(F.array_distinct(rank))) \
               .where((F.col("_off") < F.col("_k")) & (F.col("_off") + F.col("_n") >= F.col("_k")))
    hits = _twins(hits.select(*g, "_bkt", "_off", F.col("_k").cast("long").alias("_k")), [*g, "_bkt"])
    rows = b.join(hits, _same(b, hits, [*g, "_bkt"]))
    w = Window.partitionBy(*g, "_bkt", "_k").orderBy(*order)
    return (rows.withColumn("_r", F.col("_off") + F.row_number().over(w)).where(F.col("_r") == F.col("_k"))
                .select(*g, "_k", F.struct(*order).alias("_at")))


def rank_range(df: DataFrame, key: str, first: int, last: int | None, group: Sequence[str] = ()) -> DataFrame:
    """Rows whose 1-based rank within the group lies in ``[first, last]`` (``last=None``: no end).

    The input is only compared with two boundary values per group; it is
    neither shuffled by key nor ranked.
    """
    g = list(group)
    ranks = [r for r in (first - 1 if first > 1 else None, last) if r is not None]
    if not ranks:
        return df
    ks = kth_rows(df, [key], F.array(*[F.lit(r).cast("long") for r in ranks]), g)
    lo = F.max(F.when(F.col("_k") == first - 1, F.col("_at"))) if first > 1 else F.lit(None)
    hi = F.max(F.when(F.col("_k") == last, F.col("_at"))) if last is not None else F.lit(None)
    ends = _twins(ks.groupBy(*g).agg(lo.alias("_lo"), hi.alias("_hi")), g)
    out = df.join(ends, _same(df, ends, g), "left") if g else df.join(ends, F.lit(True), "left")
    at = F.struct(key)
    keep = F.lit(True)
    if first > 1:  # a group that does not reach rank first - 1 has no row in the range
        keep = keep & F.col("_lo").isNotNull() & (at > F.col("_lo"))
    if last is not None:
        keep = keep & (F.col("_hi").isNull() | (at <= F.col("_hi")))
    return out.where(keep).select(*[df[c] for c in df.columns])


def positional_index(df: DataFrame, order: str | Sequence[str], group: Sequence[str] = (), name: str = "rn",
                     with_group_size: str | None = None, cuts: int = CUTS) -> DataFrame:
    """Exact ``row_number() over (partition by group order by order)`` for every row.

    The window runs per (group, bucket). ``with_group_size`` also attaches
    the group's row count (for ntile-style numbering).
    """
    order = [order] if isinstance(order, str) else list(order)
    # the row travels as one struct, so no helper meets a column of the caller's
    o, g = [f"_o{i}" for i in range(len(order))], [f"_g{i}" for i in range(len(group))]
    d = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *[F.col(f"`{c}`").alias(n) for c, n in zip([*order, *group], [*o, *g])])
    b = with_bucket(d, o, sample_cuts(d, o, cuts), cuts)
    offs = bucket_offsets(b.select(*g, "_bkt"), g)
    if with_group_size:
        offs = offs.withColumn("_size", F.sum("_n").over(Window.partitionBy(*g)).cast("long"))
    offs = _twins(offs.drop("_n"), [*g, "_bkt"])
    rows = b.join(offs, _same(b, offs, [*g, "_bkt"]))
    w = Window.partitionBy(*g, "_bkt").orderBy(*o)
    size = [F.col("_size").alias(with_group_size)] if with_group_size else []
    return rows.withColumn("_rank", (F.col("_off") + F.row_number().over(w)).cast("long")).select("_row.*", F.col("_rank").alias(name), *size)


def sorted_index(df: DataFrame, order: Sequence[str], name: str = "idx", cuts: int = CUTS) -> DataFrame:
    """0-based position of each row in the global order of ``order``."""
    return positional_index(df, order, name=name, cuts=cuts).withColumn(name, F.col(name) - 1)


def stored_index(df: DataFrame, order: Sequence[str], name: str = "idx") -> DataFrame:
    """0-based position of each row in the order of ``order``, in one shuffle and one write.

    The rows are dealt to as many ranges as the session shuffles into (more
    data, more ranges) and sorted inside them, and are written with the
    number of their range and their place in it. Rows per range are counted
    from that table, and what lies before a range (one number each) is
    added by a join on the range. No window, and ``df`` is read twice at
    most: write an expensive one first. This runs jobs when it is called.
    """
    held = F.monotonically_increasing_id()  # range number * 2^33 + place, frozen by the write
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    keys = [F.col(f"`{c}`") for c in order]
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    # the columns themselves are the order: a copy of them would double what is shuffled
    rows = shared(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select(whole, held.alias("held")), "stored-index")
    ranged = rows.withColumn("part", F.shiftright("held", 33))
    counts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("part", F.coalesce(before, F.lit(0)).cast("long").alias("off"))  # one row per range
    place = F.col("off") + F.col("held").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.join(F.broadcast(offsets), "part").select("row.*", place.cast("long").alias(name))
