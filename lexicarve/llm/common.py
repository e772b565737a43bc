"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

WORD_RE = "[^\\x20\\x09-\\x0D]+"
BATCH_BYTES = 8 << 20


def in_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` with record batches of at most about BATCH_BYTES (or one row), whatever the length of the texts."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    conf.set(name, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Delete tables of ``shared`` that no later step reads, and let the driver's JVM drop the shuffle files of ended jobs."""
    for table in tables:
        jvm = table.sparkSession._jvm
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    for spark in {t.sparkSession for t in tables}:
        spark._jvm.System.gc()


def id_mod(key: str, m: int) -> Column:
    """crc32 of the id written as text, modulo ``m``; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % m


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def number_repeated(rows: DataFrame, same: Column, equal: Column, out: str, salts: int = 256) -> DataFrame:
    """Adds ``out``: null for rows that share ``same`` with no other row, else numbers from 0 without gaps among rows with equal ``equal``.

    Rows without repetition are not shuffled. Repeated ones are numbered
    inside ``salts`` parts of their group, whose counts give the offsets,
    so a group of a third of all rows is no single task. Rows that are
    equal in all that ``equal`` covers take the numbers in any order.
    """
    keyed = rows.withColumn("_same", same)
    repeated = shared(keyed.groupBy("_same").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_same"), "repeated")
    if repeated.isEmpty():
        return rows.withColumn(out, F.lit(None).cast("long"))
    alone = keyed.join(repeated, "_same", "left_anti").withColumn(out, F.lit(None).cast("long"))
    many = keyed.join(repeated, "_same", "left_semi").withColumn("_equal", equal)
    many = shared(many.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts))), "repeated-rows")
    before = Window.partitionBy("_equal").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offset = (many.groupBy("_equal", "_salt").agg(F.count(F.lit(1)).alias("n"))
                  .select("_equal", "_salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_off")))
    inside = F.row_number().over(Window.partitionBy("_equal", "_salt").orderBy("_salt"))
    many = many.withColumn("_r", inside - 1).join(offset, ["_equal", "_salt"]).withColumn(out, (F.col("_off") + F.col("_r")).cast("long"))
    return alone.select(*rows.columns, out).unionByName(many.select(*rows.columns, out))


def by_size(sizes: list[int], limit: int) -> Iterator[range]:
    """Consecutive index ranges whose sizes sum to at most ``limit`` (a larger item is alone)."""
    at = total = 0
    for i, n in enumerate(sizes):
        if i > at and total + n > limit:
            yield range(at, i)
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield range(at, len(sizes))


def mix32(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 32-bit hashes (in place where possible)."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def _rounds_state(e: DataFrame):
    return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def connected_components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(node, component) of an undirected link table (a, b): component = smallest node reachable.

    Distributed union-find by alternating large-star and small-star steps:
    every step is a grouped minimum and a join on the node, so a hot node
    is pre-aggregated map-side and its join side can be split by AQE. The
    links of each round are written to the shared folder. Nodes without a
    link do not appear; self links and null ends are ignored.
    """
    e = shared(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .where("a <> b").distinct(), f"{name}-links")
    state = _rounds_state(e)
    while state[0]:
        # large star: every larger neighbour of u points to the least of u's neighbourhood
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        big = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                   .where("a <> b").distinct())
        big = shared(big, f"{name}-large")
        # small star: u and its smaller neighbours point to the least of them
        low = big.groupBy("a").agg(F.min("b").alias("m"))
        e = shared(big.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .unionByName(low.select("a", F.col("m").alias("b"))).distinct(), f"{name}-small")
        now = _rounds_state(e)
        if now == state:
            break
        state = now
    members = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(roots)
