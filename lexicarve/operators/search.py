"""Random search bookkeeping (R1, R2, W3, W4, L6) and the threshold sweep.

Parameter grids are evenly spaced and integer-truncated like the
reference (``int(x) for x in linspace(a, b, n)``); draws are a seeded
hash per (trial, parameter), so they are reproducible and need no state.
The search log is a DataFrame; flags, early stop and the best trial are
window expressions over it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """``num`` evenly spaced values from ``start`` to ``stop``; ``integer`` truncates; ``none`` appends None."""
    start: float
    stop: float
    num: int
    integer: bool = True
    none: bool = False

    @property
    def size(self) -> int:
        return self.num + (1 if self.none else 0)

    def value(self, idx: Column) -> Column:
        """Grid value at a 0-based index column (the appended None is null)."""
        step = (self.stop - self.start) / (self.num - 1) if self.num > 1 else 0.0
        v = F.when(idx == self.num - 1, F.lit(float(self.stop))).otherwise(idx.cast("double") * F.lit(step) + F.lit(float(self.start)))
        v = v.cast("long") if self.integer else v
        return F.when(idx < self.num, v)


@dataclass(frozen=True)
class Choice:
    options: tuple

    @property
    def size(self) -> int:
        return len(self.options)

    def value(self, idx: Column) -> Column:
        out = None
        for i, o in enumerate(self.options):
            out = (F.when(idx == i, F.lit(o)) if out is None else out.when(idx == i, F.lit(o)))
        return out


# Forest search space of the reference (fixed values).
FOREST_SPACE = {
    "n_estimators": Grid(100, 5000, 1000),
    "max_features": Choice(("log2", "sqrt", "all")),
    "max_depth": Grid(10, 500, 1000, none=True),
    "min_samples_leaf": Grid(10, 100, 1000),
    "bootstrap": Choice((True, False)),
}


# The forest space of the k-fold searches (fixed values).
FOREST_SPACE_CV = {
    "n_estimators": Grid(100, 5000, 1000),
    "max_features": Choice(("log2", "sqrt", "all")),
    "max_depth": Grid(10, 5000, 1000, none=True),
    "min_samples_split": Grid(1, 100, 1000),
    "min_samples_leaf": Grid(10, 100, 1000),
    "bootstrap": Choice((True, False)),
}

ROUNDS = 6  # of the keyed permutation


def draw_index(trial: Column, param: str, size: int, seed: int) -> Column:
    """R2: seeded uniform pick of an index in [0, size) for (trial, parameter)."""
    h = F.md5(F.concat(F.lit(f"{seed}-"), trial.cast("string"), F.lit(f"-{param}")))
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), F.lit(size))


def draw_trials(spark: SparkSession, n_iter: int, space: dict, seed: int = 42) -> DataFrame:
    """R1 + R2: one row per trial with one drawn value per parameter."""
    t = spark.range(n_iter).withColumnRenamed("id", "iter")
    return t.select("iter", *[p.value(draw_index(F.col("iter"), name, p.size, seed)).alias(name)
                              for name, p in space.items()])


def grid_size(space: dict) -> int:
    """How many parameter sets a space has."""
    n = 1
    for p in space.values():
        n *= p.size
    return n


def draw_distinct(spark: SparkSession, n_iter: int, space: dict, seed: int = 42) -> DataFrame:
    """R6's draws: distinct parameter sets, as many as asked for or as the grid has.

    The grid is a number line in mixed radix. Trial i is the i-th number of
    a keyed permutation of that line: the number is cut into two halves
    (the first parameters and the rest), and in each round a hash of one
    half is added to the other, modulo its size. Every round can be undone,
    so no two trials meet, and the grid is never listed.
    """
    names = list(space)
    head, tail = names[:(len(names) + 1) // 2], names[(len(names) + 1) // 2:]
    a, b = grid_size({k: space[k] for k in head}), grid_size({k: space[k] for k in tail})
    t = spark.range(min(n_iter, a * b)).select(F.col("id").alias("iter"), F.floor(F.col("id") / b).alias("x"), (F.col("id") % b).alias("y"))
    for r in range(ROUNDS):
        to, of, size = ("x", "y", a) if r % 2 == 0 else ("y", "x", b)
        h = F.md5(F.concat(F.lit(f"{seed}-{r}-"), F.col(of).cast("string")))
        t = t.withColumn(to, (F.col(to) + F.conv(F.substring(h, 1, 13), 16, 10).cast("long")) % size)
    out = [F.col("iter")]
    for half, at in ((head, F.col("x")), (tail, F.col("y"))):
        for k in half:
            out.append(space[k].value(at % space[k].size).alias(k))
            at = F.floor(at / space[k].size)
    return t.select(*out)


def annotate_log(log: DataFrame, score: str = "f1", iter_col: str = "iter", patience: int = 5) -> DataFrame:
    """W3 + W4 + L6 over a search log.

    ``flag``: before trial i (i >= 2) the score of trial i-2 was >= that of i-1.
    ``ran``: the running count of flags (cumulative, not consecutive) is
    still below ``patience`` when trial i starts. ``best``: the highest
    score among trials that ran, earliest on ties.
    """
    o = Window.orderBy(iter_col)
    flag = F.coalesce((F.lag(score, 2).over(o) >= F.lag(score, 1).over(o)).cast("int"), F.lit(0))
    out = log.withColumn("flag", flag)
    out = out.withColumn("ran", F.sum("flag").over(o.rowsBetween(Window.unboundedPreceding, 0)) < patience)
    rank = F.row_number().over(Window.partitionBy("ran").orderBy(F.desc(score), F.asc(iter_col)))
    return out.withColumn("best", F.col("ran") & (rank == 1))


def threshold_sweep(df: DataFrame, value: str, label: str, thresholds: DataFrame,
                    t_col: str = "threshold") -> DataFrame:
    """Confusion counts of the rule ``value > t`` for every t, without pairing rows with thresholds.

    The thresholds (one row per trial) are held in one sorted array. A row
    finds how many of them lie below its value, the data are counted by
    that number (at most trials + 1 groups, whatever the values), and
    running sums over those few counts give every threshold's part above.
    """
    marks = thresholds.where(F.col(t_col).isNotNull())
    cuts = marks.select(F.col(t_col).cast("double").alias("t")).distinct().agg(F.array_sort(F.collect_list("t"))).scalar()
    v = F.col(value).cast("double")
    d = df.select(v.alias("_v"), (F.col(label) == 1).alias("_y")).withColumn("_cuts", cuts)
    below = d.select("_y", F.size(F.filter("_cuts", lambda t: t < F.col("_v"))).alias("_b"))
    counts = below.groupBy("_b").agg(F.count_if("_y").alias("_pos"), F.count_if(~F.col("_y")).alias("_neg"))
    ranked = marks.withColumn("_b", F.dense_rank().over(Window.orderBy(F.col(t_col).cast("double"))))
    rows = ranked.withColumn("_mark", F.lit(True)).unionByName(counts.withColumn("_mark", F.lit(False)), allowMissingColumns=True)
    # a value above exactly b thresholds is above those of rank b and less
    w = Window.orderBy(F.desc("_b")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    tot = Window.partitionBy(F.lit(1))
    swept = (rows.withColumn("tp", F.coalesce(F.sum("_pos").over(w), F.lit(0))).withColumn("fp", F.coalesce(F.sum("_neg").over(w), F.lit(0)))
                 .withColumn("_P", F.coalesce(F.sum("_pos").over(tot), F.lit(0))).withColumn("_N", F.coalesce(F.sum("_neg").over(tot), F.lit(0))))
    return swept.where("_mark").select(*thresholds.columns, "tp", "fp", (F.col("_P") - F.col("tp")).alias("fn"),
                                       (F.col("_N") - F.col("fp")).alias("tn"))
