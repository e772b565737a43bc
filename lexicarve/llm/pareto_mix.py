"""Mixing sources to target weights by Pareto order sampling.

Targets: sources share ``budget`` times all words by weight, a source is
filled to at most ``MOST`` times its own words and the excess goes to the
others by weight (water filling). Inside a source, classes of document
length share its target the same way with a weight that falls slowly with
length, which gives every document its expected copies. The whole part is
certain. The fraction is the inclusion probability p of one more copy:
documents are ranked by random odds over inclusion odds,
(u / (1 - u)) / (p / (1 - p)) with u a fixed hash of the id (where rows
share an id, of their text and number among equal rows too), and taken in
that order until the source's remaining words are reached as nearly as
whole documents can. So the size in words is fixed, within half a document.

No source is ordered as a whole: a histogram of the rank value per source
finds the one bin where the words run out, and only that bin is ordered.
The plan is two small tables, by (source, length class) and by source,
which are joined to the rows; texts are never shuffled.

Defined cases: a null text has no words; documents without words are
passed once and count nothing; a null source is a source of its own, last
in order; a source without words takes its turn in the weights and has
target 0; a null id hashes as the empty string; rows that share an id, or
are equal in all columns, are drawn one by one; an empty table gives no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_RE, number_repeated, shared

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST = 2
SEED = 17
BINS = 1000  # per unit of log-odds, where at most a quarter of a source's documents lie
DAMPING = 16.0  # larger: closer to equal expected copies for all lengths


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def uniform(key: Column, seed: int = SEED, more: Column | None = None) -> Column:
    """A fixed number in (0, 1) for every id, and ``more`` where it is not null."""
    more = F.lit("") if more is None else F.coalesce(F.concat(F.lit("#"), more), F.lit(""))
    h = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), more, F.lit(f"-{seed}")))
    return (F.conv(F.substring(h, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_key(source: Column) -> Column:
    """Sorts by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def length_class(size: Column) -> Column:
    return (F.length(F.bin(size + 1)) - 1).cast("int")


def water_fill(df: DataFrame, group: list[str], amount: Column, weight: str, most: str, out: str) -> DataFrame:
    """Share ``amount`` in each group by ``weight``, no row above ``most``; the excess is shared again."""
    w = Window.partitionBy(*group).orderBy(F.col(most) / F.col(weight), weight)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (amount - F.coalesce(F.sum(most).over(before), F.lit(0.0))) / F.sum(weight).over(after)
    d = df.withColumn("_level", level).withColumn("_full", F.col(most) <= F.col(weight) * F.col("_level"))
    # the first row that is not filled has the largest level of those, and it is the common one
    t = F.max(F.when(~F.col("_full"), F.col("_level"))).over(Window.partitionBy(*group))
    return d.withColumn("_t", t).withColumn(out, F.when(F.col("_full") | F.col("_t").isNull(), F.col(most))
                                            .otherwise(F.col(weight) * F.col("_t"))).drop("_level", "_full", "_t")


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", whole: Column | None = None) -> DataFrame:
    """(id, size, src, cls, u) and ``whole``, if given: what the mix needs to know of a row."""
    d = docs.select(*([] if whole is None else [whole]), F.col(key).alias("id"), word_count(F.col(text)).alias("size"),
                    source_key(F.col(source)).alias("src"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_md5"))
    if whole is None:
        d = shared(d, "mix-measured")
    same = F.xxhash64(F.col("id").isNull(), F.col("id").cast("string"))
    d = number_repeated(d, same, F.xxhash64(same, "text_md5", "src"), "number")
    # equal rows of one id are told apart by their number, other rows of one id by their text
    more = F.concat_ws("#", "text_md5", F.col("number").cast("string"))
    return d.withColumn("cls", length_class(F.col("size"))) \
            .withColumn("u", uniform(F.col("id"), more=F.when(F.col("number").isNotNull(), more))).drop("text_md5", "number")


def _ranked(rows: DataFrame) -> DataFrame:
    """Adds the rank value q and its bin.

    Bins are even on the log scale, where an inclusion probability near 0
    or 1 only moves the values and does not press them into one bin.
    """
    p = F.col("copies") - F.floor("copies")
    q = F.when(p > 0, (F.col("u") / (1 - F.col("u"))) / (p / (1 - p)))
    return rows.withColumn("q", q).withColumn("bin", F.floor(F.log("q") * BINS).cast("int"))


class Mix:
    """Targets and cuts of a mix: ``classes`` by (src, cls), ``cuts`` by src."""

    def __init__(self, rows: DataFrame, weights=WEIGHTS, budget: float = BUDGET):
        every = rows.groupBy("src", "cls").agg(F.sum("size").cast("double").alias("words"))
        sums = every.where("words > 0")
        src = every.groupBy("src").agg(F.sum("words").alias("source_size"))
        turn = (F.row_number().over(Window.orderBy("src")) - 1) % len(weights)
        src = src.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), turn + 1)) \
                 .withColumn("most", MOST * F.col("source_size"))
        total = F.sum("source_size").over(Window.partitionBy())
        src = shared(water_fill(src.withColumn("all", total), [], budget * F.col("all"), "w", "most", "target")
                     .select("src", "source_size", "target"), "mix-targets")
        cls = sums.join(src, "src").withColumn("w", F.col("words") / (DAMPING + F.col("cls"))) \
                  .withColumn("most", MOST * F.col("words"))
        cls = water_fill(cls, ["src"], F.col("target"), "w", "most", "amount")
        self.classes = shared(cls.select("src", "cls", F.least(F.col("amount") / F.col("words"), F.lit(float(MOST))).alias("copies"),
                                         F.col("source_size").cast("long").alias("source_size"), "target", "words"), "mix-classes")
        rest = self.classes.groupBy("src").agg(F.sum((F.col("copies") - F.floor("copies")) * F.col("words")).alias("rest"))
        ranked = _ranked(rows.where("size > 0").join(self.classes.select("src", "cls", "copies"), ["src", "cls"])).where("q is not null")
        bins = ranked.groupBy("src", "bin").agg(F.sum("size").alias("words")).join(rest, "src")
        off = F.sum("words").over(Window.partitionBy("src").orderBy("bin"))
        edge = shared(bins.withColumn("end", off).where((F.col("end") > F.col("rest")) & (F.col("end") - F.col("words") <= F.col("rest")))
                          .select("src", F.col("bin").alias("edge"), (F.col("end") - F.col("words")).alias("off"), "rest"), "mix-edges")
        inside = ranked.join(edge, "src").where("bin = edge")
        run = F.sum("size").over(Window.partitionBy("src").orderBy("q", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        last = inside.withColumn("end", F.col("off") + run).where("end - size / 2.0 <= rest") \
                     .groupBy("src").agg(F.max(F.struct("q", "id")).alias("last"))
        self.cuts = shared(edge.select("src", "edge").join(last, "src", "left"), "mix-cuts")

    def take(self, rows: DataFrame) -> DataFrame:
        """Rows with (id, size, src, cls, u) and any other columns, plus source_size, target and n_copies."""
        d = _ranked(rows.join(self.classes.drop("words"), ["src", "cls"], "left").join(self.cuts, "src", "left"))
        # a source without an edge takes the rest of all its documents
        more = F.col("q").isNotNull() & (F.col("edge").isNull() | (F.col("bin") < F.col("edge"))
                                         | ((F.col("bin") == F.col("edge")) & (F.struct("q", "id") <= F.col("last"))))
        n = F.floor("copies") + F.when(F.coalesce(more, F.lit(False)), 1).otherwise(0)
        return d.withColumn("n_copies", F.when(F.col("size") == 0, F.lit(1)).otherwise(n).cast("int")) \
                .drop("copies", "q", "bin", "edge", "last", "cls", "u")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key, size, source_size, target, taken, n_copies) for every row."""
    rows = shared(measured(docs, key, text, source), "mix-rows")
    plan = Mix(rows)
    sizes = plan.classes.groupBy("src").agg(F.first("source_size").alias("s"), F.first("target").alias("t"))
    out = plan.take(rows).join(sizes, "src", "left")
    return out.select(F.col("id").alias(key), "size", F.coalesce("s", F.lit(0)).cast("long").alias("source_size"),
                      F.coalesce("t", F.lit(0.0)).alias("target"), (F.col("size") * F.col("n_copies")).cast("long").alias("taken"), "n_copies")


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns."""
    plan = Mix(shared(measured(docs, key, text, source), "mix-rows"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    d = plan.take(measured(docs, key, text, source, whole))
    return d.where("n_copies > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("copy")).select("doc.*")
