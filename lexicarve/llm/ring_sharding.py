"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

A document's ring position is the hash of its text, so equal texts sit at
one point. Each shard owns ``VNODES`` points; a document belongs to the
next point clockwise. No shard may hold more than ``1 + EPSILON`` times
the mean of bytes: what overflows a full shard continues clockwise to the
next shard, round by round, until it fits.

The ring is cut into 2^CELL_BITS cells. Bytes per cell are one partial
aggregate; a cell heavier than a quarter of the slack (a third of all rows
may be one text) is cut into pieces by the hash of the id, and where rows
of such a cell share an id, of their checksum and number too. These pieces,
at most 2^CELL_BITS + 4 * shards / EPSILON of them at any input size, are
placed whole. Only that bounded table is ordered in one task and broadcast;
the rows are shuffled once, as narrow rows by piece, to number the slots.

Guarantee: a load is at most ``cap`` = (1 + EPSILON) * mean, and where one
document alone is heavier than the slack, ``cap`` plus the largest piece.

Defined cases: a null text has size 1 and checksum 0 and is placed by its
id; repeated rows each get a slot; rows with equal ids are numbered in any
order among themselves; an empty table gives no rows.

Only DataFrame operations run here.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import number_repeated, shared

SHARDS = 8
VNODES = 64
CELL_BITS = 14
EPSILON = 0.01
RING = 1 << 32


def vnode_positions(shards: int, vnodes: int = VNODES) -> list[list[int]]:
    """Ring positions of the virtual nodes of each shard."""
    return [[zlib.crc32(f"shard-{s}-node-{v}".encode()) for v in range(vnodes)] for s in range(shards)]


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    t = F.col(text)
    point = F.when(t.isNull(), F.xxhash64(F.col(key), F.lit("null"))).otherwise(F.xxhash64(t))
    return docs.select(F.col(key).alias("id"), (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("size"),
                       F.coalesce(F.crc32(t.cast("binary")), F.lit(0)).cast("long").alias("crc"),
                       F.shiftrightunsigned(point, 64 - CELL_BITS).cast("int").alias("cell"))


def place(units: DataFrame, cap, shards: int) -> DataFrame:
    """Shard of every piece (cell, sub, bytes): clockwise from its cell, past full shards."""
    at = F.col("cell").cast("long") * (RING >> CELL_BITS)
    away = [F.struct(F.array_min(F.transform(F.array(*[F.lit(p) for p in own]), lambda p: F.pmod(p - at, F.lit(RING)))).alias("d"),
                     F.lit(s).alias("s")) for s, own in enumerate(vnode_positions(shards))]
    state = shared(units.withColumn("pref", F.transform(F.array_sort(F.array(*away)), lambda x: x["s"])), "ring-pieces")
    state = state.withColumn("k", F.lit(0)).coalesce(1)
    most = F.max("bytes").over(Window.partitionBy())
    state = state.withColumn("cap", cap).withColumn("most", most)
    # a piece that found all shards full goes round once more, with room for the largest piece added;
    # then some shard has room for it
    for r in range(2 * shards):
        shard = F.element_at("pref", F.col("k") % shards + 1)
        filled = F.sum("bytes").over(Window.partitionBy(shard).orderBy("k", "cell", "sub"))
        room = F.col("cap") + F.when(F.col("k") >= shards, F.col("most")).otherwise(0)
        state = state.withColumn("k", F.when(filled <= room, F.col("k")).otherwise(F.col("k") + 1).cast("int"))
    return state.withColumn("shard", F.element_at("pref", F.col("k") % shards + 1).cast("int"))


def assign(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text",
           epsilon: float = EPSILON) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard, moved) for every row.

    ``slot`` numbers the rows of a shard from 0 without gaps; ``moved`` is
    how many full shards the row went past.
    """
    rows = shared(_rows(docs, key, text), "ring-rows")
    total = rows.agg(F.sum("size")).scalar()
    cells = rows.groupBy("cell").agg(F.sum("size").alias("bytes"))
    limit = F.greatest(F.lit(1.0), total * (epsilon / (4 * shards)))
    heavy = shared(cells.where(F.col("bytes") > limit)
                        .select("cell", F.ceil(F.col("bytes") / limit).cast("long").alias("pieces")), "ring-heavy")
    # at most 4 * shards / epsilon cells are heavy
    crowd = rows.join(F.broadcast(heavy), "cell")
    same = F.xxhash64(F.col("id").isNull(), F.col("id").cast("string"), "cell")
    crowd = number_repeated(crowd, same, F.xxhash64(same, "crc", "size"), "number")
    piece = F.when(F.col("number").isNull(), F.xxhash64("id", F.lit("piece"))).otherwise(F.xxhash64("id", F.lit("piece"), "crc", "number"))
    light = rows.join(F.broadcast(heavy), "cell", "left_anti").withColumn("sub", F.lit(0))
    cut = light.unionByName(crowd.withColumn("sub", F.pmod(piece, F.col("pieces")).cast("int")).drop("pieces", "number"))
    units = cut.groupBy("cell", "sub").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    cap = F.ceil(total * ((1 + epsilon) / shards))
    placed = place(units, cap, shards)
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("cell", "sub").rowsBetween(Window.unboundedPreceding, -1))
    table = shared(placed.withColumn("base", F.coalesce(before, F.lit(0)))
                         .select("cell", "sub", "shard", "base", F.col("k").alias("moved")), "ring-units")
    rank = F.row_number().over(Window.partitionBy("cell", "sub").orderBy("id"))
    out = cut.withColumn("_r", rank - 1).join(F.broadcast(table), ["cell", "sub"])
    return out.select(F.col("id").alias(key), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
                      (F.col("base") + F.col("_r")).cast("long").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"), "moved")
