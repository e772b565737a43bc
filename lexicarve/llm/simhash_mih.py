"""SimHash near-dedup by multi-index hashing.

Every text gets a 64-bit SimHash of its word shingles. Documents are
collapsed by fingerprint, and links (``max_bits`` = 2 or fewer differing
bits) are searched between distinct fingerprints. The fingerprint is cut
into two 32-bit segments with one table each. Two fingerprints at
distance 2 or less differ by at most one bit in the first segment, or not
at all in the second, so a fingerprint probes the first table with the
ball of radius 1 around its segment (33 keys) and the second with the
exact segment; matches are verified on all 64 bits.

Table buckets larger than ``bucket_rows`` (thousands of near copies share
a segment) are not compared pair by pair. Two fingerprints are within two
bits exactly if the balls of radius 1 around them share a point, so the
members of such buckets are grouped by the 65 points of their own ball. A
point has at most 65 distinct fingerprints around it, so these groups are
bounded whatever the data, and each gives a star of links. A pair is
missed by the tables only if both ends lie in large buckets, and all of
those take part in that second search, so no link is lost.

Null and empty texts have fingerprint zero and link like any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, in_arrow, shared

SHINGLE = 3
MAX_BITS = 2
BUCKET_ROWS = 64
SEED = 42
_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SLICE = 1 << 16


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one UTF-8 text; 0 without words."""
    import xxhash

    words = text.translate(_FOLD).split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        parts = [line[a:b] for a, b in zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
    dig = xxhash.xxh64_digest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(parts), _SLICE):
        raw = np.frombuffer(b"".join([dig(p, SEED) for p in parts[at:at + _SLICE]]), np.uint8)
        ones += np.unpackbits(raw.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > len(parts)).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp): the fingerprint as a signed long, one row per input row."""
    d = docs.select(F.col(key).alias("k"), F.col(text).cast("binary").alias("t"))

    def run(batches):
        for b in batches:
            fp = np.fromiter((simhash(t, shingle) for t in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["k", "fp"])

    kind = d.schema["k"].dataType.simpleString()
    return in_arrow(d, run, f"k {kind}, fp long").select(F.col("k").alias(key), "fp")


def _high(fp):
    return F.shiftrightunsigned(fp, 32)


def _low(fp):
    return F.col(fp).bitwiseAND(F.lit(0xFFFFFFFF))


def _near(a: str, b: str, max_bits: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def fingerprint_links(fps: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect all pairs within MAX_BITS bits.

    From small buckets every pair is returned; from large ones a star per
    ball point, which has the same connected components.
    """
    one = F.lit(1).cast("long")
    table = shared(fps.select(F.lit(0).alias("seg"), _high("fp").alias("v"), "fp")
                      .unionByName(fps.select(F.lit(1).alias("seg"), _low("fp").alias("v"), "fp")), "mih-table")
    sizes = table.groupBy("seg", "v").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") > bucket_rows).select("seg", "v")
    small = table.join(large, ["seg", "v"], "left_anti")
    flips = F.concat(F.array(F.col("v")),
                     F.transform(F.sequence(F.lit(0), F.lit(31)),
                                 lambda i: F.col("v").bitwiseXOR(F.call_function("shiftleft", one, i))))
    ball = F.when(F.col("seg") == 0, flips).otherwise(F.array("v"))
    probes = table.select("seg", F.explode(ball).alias("v"), F.col("fp").alias("q"))
    # Spark takes the probes for no larger than their table, though they are 34 times its rows: neither side is broadcast
    exact = (small.hint("merge").join(probes.hint("merge"), ["seg", "v"]).where((F.col("fp") != F.col("q")) & _near("fp", "q", MAX_BITS))
                  .select(F.col("fp").alias("a"), F.col("q").alias("b")))
    crowd = table.join(large, ["seg", "v"], "left_semi").select("fp").distinct()
    points = F.concat(F.array(F.col("fp")),
                      F.transform(F.sequence(F.lit(0), F.lit(63)),
                                  lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", one, i))))
    around = crowd.select("fp", F.explode(points).alias("p"))
    star = (around.groupBy("p").agg(F.collect_list("fp").alias("f")).where(F.size("f") > 1)
                  .select(F.array_min("f").alias("b"), F.explode("f").alias("a"))
                  .where((F.col("a") != F.col("b")) & _near("a", "b", MAX_BITS)).select("a", "b"))
    return exact.unionByName(star)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE) -> DataFrame:
    """(key, fingerprint, component_id, component_rows) for every input row.

    ``component_id`` is the smallest key reachable over links, the row's
    own included (null if no row of the component has a key). Repeated rows
    are returned as often as they occur; an empty table gives no rows.
    """
    each = shared(fingerprints(docs, key, text, shingle), "simhash")
    distinct = shared(each.groupBy("fp").agg(F.min(key).alias("low"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    comp = connected_components(fingerprint_links(distinct.select("fp")), "simhash")
    placed = distinct.join(comp, distinct["fp"] == comp["node"], "left") \
                     .select("fp", "low", "n", F.coalesce("component", "fp").alias("component"))
    ids = placed.groupBy("component").agg(F.min("low").alias("component_id"), F.sum("n").alias("component_rows"))
    named = placed.select("fp", "component").join(ids, "component").select("fp", "component_id", "component_rows")
    return (each.join(named, "fp")
                .select(key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "component_rows"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each component one row, with all its columns: the first by key (null last), then by hash of the text.

    Rows are told apart by key and text, so texts that share a key are
    judged each by its own component; of rows equal in both any one stays.
    """
    th = F.xxhash64(F.col(text))
    first = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), th.alias("th"))
    name = lambda none, i, h: F.concat_ws("/", none.cast("string"), F.coalesce(i.cast("string"), F.lit("")), h.cast("string"))
    of = lambda c: name(F.col(f"{c}.none"), F.col(f"{c}.id"), F.col(f"{c}.th"))
    near = near_duplicates(docs.select(first.alias("row"), F.col(text).alias("text")), "row", "text")
    kept = near.select(of("row").alias("name"), of("component_id").alias("first")).where("name = first").select("name").distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                        name(F.col(key).isNull(), F.col(key), th).alias("name"))
    # equal rows collapse before the shuffle, which the join on the same column uses again
    return whole.dropDuplicates(["name"]).join(kept, "name", "left_semi").select("doc.*")
