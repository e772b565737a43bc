"""Data-parallel mini-batch training of a dense classifier head.

The head is dense ``hidden`` with ReLU, dropout, and one sigmoid output,
trained on the focal loss (M10) with Adam. The rows are put in a random
order once (by hash) and stored by step, so a step reads its own rows only.
Steps follow one another, so small ones are not spread: as many as fit
``IN_TASK`` bytes of rows are taken one by one in a task that gets the
weights and returns them, and a job ends them. A step of more rows than
that is a job of its own: the tasks compute the gradient sums of their rows
(numpy over Arrow batches), one grouped sum adds them up, and the driver
moves the weights, which are all that it holds. Dropout is a hash of (seed, epoch,
row, unit): no state, the same on a retry, and independent of partitions.

``schedule(epoch, rate)`` is called before every epoch with the current
rate, as the reference's callback is (F4). Weights are kept every ``keep``
epochs, as a table in the shared folder, from which a head can be loaded.

At scale choose ``batch`` with the cluster: only a step beyond ``IN_TASK``
is shared by several cores, so a batch should hold many rows per core. Rows with a null label, or without
features, are not trained on; missing features count as 0; a table without
rows leaves the first weights.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, shared
from . import metrics as mt
from .positions import positional_index
from .trees import feature_array, hashed

CLIP = 1e-7
IN_TASK = 64 << 20  # bytes of features whose steps a task takes one by one


def halve_after(first: int = 10, factor: float = 0.5) -> Callable[[int, float], float]:
    """the rate stays for ``first`` epochs and is then multiplied by ``factor`` before each further one."""
    return lambda epoch, rate: rate if epoch < first else rate * factor


def uniform(seed: int, epoch: int, keys: np.ndarray, units: int) -> np.ndarray:
    """Numbers in [0, 1) of each row and unit."""
    return (hashed(seed, epoch, keys[:, None], np.arange(units)[None, :]) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


class Weights:
    """w1 [width, hidden], b1 [hidden], w2 [hidden], b2 in one flat array."""

    def __init__(self, width: int, hidden: int, flat: np.ndarray | None = None, seed: int = 42):
        self.width, self.hidden = width, hidden
        if flat is None:  # uniform within the usual limits of a dense layer
            a, b = np.sqrt(6 / (width + hidden)), np.sqrt(6 / (hidden + 1))
            u = uniform(seed, -1, np.arange(width + 1), hidden) * 2 - 1
            flat = np.concatenate([(u[:width] * a).reshape(-1), np.zeros(hidden), u[width] * b, [0.0]])
        self.flat = flat

    def parts(self):
        n, h = self.width * self.hidden, self.hidden
        return self.flat[:n].reshape(self.width, h), self.flat[n:n + h], self.flat[n + h:n + 2 * h], self.flat[-1]

    def scores(self, x: np.ndarray, mask: np.ndarray | None = None):
        """(scores, hidden outputs before the mask)."""
        w1, b1, w2, b2 = self.parts()
        z = np.maximum(x @ w1 + b1, 0.0)
        out = (z if mask is None else z * mask) @ w2 + b2
        return 1.0 / (1.0 + np.exp(-out)), z


def focal(p: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(1 - p_t)^2 * -ln(p_t) with p clipped."""
    p = np.clip(p, CLIP, 1 - CLIP)
    t = np.where(y == 1, p, 1 - p)
    return (1 - t) ** 2 * -np.log(t)


def gradient(weights: Weights, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, float]:
    """Gradient of the summed focal loss, flat, and that sum."""
    _, _, w2, _ = weights.parts()
    p, z = weights.scores(x, mask)
    q = np.clip(p, CLIP, 1 - CLIP)
    t = np.where(y == 1, q, 1 - q)
    by_t = 2 * (1 - t) * np.log(t) - (1 - t) ** 2 / t
    inside = (p > CLIP) & (p < 1 - CLIP)
    d = by_t * np.where(y == 1, 1.0, -1.0) * q * (1 - q) * inside  # by the output before the sigmoid
    hidden = d[:, None] * w2 * mask * (z > 0)
    return np.concatenate([(x.T @ hidden).reshape(-1), hidden.sum(axis=0), (z * mask).T @ d, [d.sum()]]), float(focal(p, y).sum())


def _features(col, width: int) -> np.ndarray:
    size = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    if len(col) and (size == width).all():
        return np.nan_to_num(col.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(col), width))
    out = np.zeros((len(col), width))
    for i, v in enumerate(col.to_pylist()):
        if v:
            a = np.array(v[:width], float)
            out[i, :len(a)] = np.nan_to_num(a)
    return out


class HeadModel:
    def __init__(self, weights: Weights):
        self.weights = weights

    def transform(self, df: DataFrame, key: str, features: str = "features", label: str = "label") -> DataFrame:
        """(key, label, prediction, score); class 1 where the score is above one half. No dropout."""
        d = df.select(F.col(key).alias("k"), F.col(label).cast("int").alias("label"), feature_array(df, features).alias("v"))
        kept = df.sparkSession.sparkContext.broadcast(self.weights)

        def run(batches):
            for b in batches:
                p, _ = kept.value.scores(_features(b.column(2), kept.value.width))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array((p > 0.5).astype(np.int32)), pa.array(p)],
                                                 names=["k", "label", "prediction", "score"])

        kind = d.schema["k"].dataType.simpleString()
        return d.mapInArrow(run, f"k {kind}, label int, prediction int, score double").withColumnRenamed("k", key)

    def save(self, spark: SparkSession, path: str) -> str:
        w = self.weights
        spark.createDataFrame([(w.width, w.hidden, w.flat.tolist())], "width int, hidden int, flat array<double>").write.parquet(path)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> HeadModel:
        r = spark.read.parquet(path).first()
        return cls(Weights(r["width"], r["hidden"], np.array(r["flat"])))


@dataclass
class DenseHead:
    """R9 with F4. ``fit`` returns (model, log): one log row per epoch."""
    hidden: int = 128
    dropout: float = 0.2
    epochs: int = 100
    batch: int = 64
    rate: float = 2e-2
    epsilon: float = 1e-8
    keep: int = 3
    schedule: Callable[[int, float], float] = halve_after()
    seed: int = 42

    def step(self, rows: DataFrame, weights: Weights, epoch: int) -> tuple[np.ndarray, float, int]:
        """Mean gradient, summed loss and number of rows of one step."""
        kept = rows.sparkSession.sparkContext.broadcast(weights)
        seed, drop = self.seed, self.dropout

        def run(batches):
            total, loss, n = np.zeros(len(kept.value.flat)), 0.0, 0
            for b in batches:
                if not b.num_rows:
                    continue
                w = kept.value
                keys, y = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
                mask = (uniform(seed, epoch, keys, w.hidden) >= drop) / (1 - drop)
                g, s = gradient(w, _features(b.column(2), w.width), y, mask)
                total, loss, n = total + g, loss + s, n + len(y)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(-2, len(total))), pa.array(np.concatenate([[loss, n], total]))], names=["i", "g"])

        got = rows.select("h", "y", "v").mapInArrow(run, "i long, g double").groupBy("i").agg(F.sum("g").alias("g")).toArrow()  # one row per weight
        out = np.zeros(len(weights.flat) + 2)
        out[got.column("i").to_numpy() + 2] = got.column("g").to_numpy()
        kept.unpersist()
        n = int(out[1])
        return out[2:] / max(n, 1), float(out[0]), n

    def moved(self, weights: Weights, m1: np.ndarray, m2: np.ndarray, t: int, rate: float, g: np.ndarray) -> tuple[Weights, np.ndarray, np.ndarray]:
        """Adam's step ``t`` by the mean gradient ``g``."""
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        flat = weights.flat - rate * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.999 ** t)) + self.epsilon)
        return Weights(weights.width, weights.hidden, flat), m1, m2

    def steps(self, rows: DataFrame, weights: Weights, m1: np.ndarray, m2: np.ndarray, t: int, rate: float, epoch: int):
        """(weights, m1, m2, t, summed loss, number of rows) after the steps that ``rows`` hold, taken one by one in one task."""
        kept = rows.sparkSession.sparkContext.broadcast((weights, m1, m2))
        seed, drop, moved = self.seed, self.dropout, self.moved

        def run(batches):
            w, a, b = kept.value
            got = [x for x in batches if x.num_rows]
            if not got:
                return
            step, h, y = (np.concatenate([x.column(i).to_numpy(zero_copy_only=False) for x in got]) for i in range(3))
            v = np.concatenate([_features(x.column(3), w.width) for x in got])
            order = np.lexsort((h, step))
            at, loss = t, 0.0
            for on in np.split(order, np.flatnonzero(np.diff(step[order])) + 1):
                mask = (uniform(seed, epoch, h[on], w.hidden) >= drop) / (1 - drop)
                g, part = gradient(w, v[on], y[on], mask)
                at, loss = at + 1, loss + part
                w, a, b = moved(w, a, b, at, rate, g / len(on))
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (w.flat, a, b)] + [pa.array([at]), pa.array([loss]), pa.array([len(order)])],
                                             names=["w", "a", "b", "t", "loss", "n"])

        got = rows.select("step", "h", "y", "v").coalesce(1).mapInArrow(run, "w binary, a binary, b binary, t long, loss double, n long").toArrow()  # one row
        kept.unpersist()
        if not got.num_rows:
            return weights, m1, m2, t, 0.0, 0
        r = got.to_pylist()[0]
        flat, m1, m2 = (np.frombuffer(r[c]) for c in "wab")
        return Weights(weights.width, weights.hidden, flat), m1, m2, r["t"], r["loss"], r["n"]

    def fit(self, train: DataFrame, key: str, features: str = "features", label: str = "label",
            validation: DataFrame | None = None) -> tuple[HeadModel, DataFrame]:
        spark = train.sparkSession
        d = train.select(F.xxhash64(F.col(key)).alias("h"), F.col(label).cast("double").alias("y"), feature_array(train, features).alias("v"))
        d = shared(d.where(F.col("y").isNotNull() & (F.size("v") > 0)).withColumn("o", F.md5(F.concat(F.col("h").cast("string"), F.lit(f"-{self.seed}")))), "head-rows")
        size = d.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("w")).first()
        n, width = int(size["n"]), int(size["w"] or 1)
        steps = -(-n // self.batch)
        placed = positional_index(d, ["o", "h"], name="rn").withColumn("step", F.floor((F.col("rn") - 1) / self.batch))
        at_once = IN_TASK // (8 * width * self.batch)  # steps of a task; none if a step is larger
        # stored by the steps that a job reads: the other folders are not opened
        path = scratch_path(spark, "head-steps")
        parted = placed.select("h", "y", "v", "step", F.floor(F.col("step") / max(1, at_once)).alias("part"))
        parted.repartition("part").sortWithinPartitions("part", "step").write.partitionBy("part").parquet(path)
        rows = spark.read.schema(parted.schema).parquet(path)
        weights = Weights(width, self.hidden, seed=self.seed)
        m1, m2, t, rate, log = np.zeros_like(weights.flat), np.zeros_like(weights.flat), 0, self.rate, []
        for epoch in range(self.epochs if n else 0):
            rate = self.schedule(epoch, rate)
            loss, seen = 0.0, 0
            for s in range(-(-steps // max(1, at_once))):
                own = rows.where(F.col("part") == s)
                if at_once:
                    weights, m1, m2, t, part, k = self.steps(own, weights, m1, m2, t, rate, epoch)
                else:
                    g, part, k = self.step(own, weights, epoch)
                    t += 1
                    weights, m1, m2 = self.moved(weights, m1, m2, t, rate, g)
                loss, seen = loss + part, seen + k
            kept = None
            if (epoch + 1) % self.keep == 0:
                kept = HeadModel(weights).save(spark, scratch_path(spark, f"head-epoch-{epoch}"))
            valid = (None, None)
            if validation is not None:
                p = HeadModel(weights).transform(validation, key, features, label)
                valid = (mt.focal_loss(p).first()["focal_loss"], mt.thresholded_accuracy(p).first()["binary_accuracy"])
            log.append((epoch, float(rate), seen, loss / max(seen, 1), *valid, kept))
        schema = "epoch int, rate double, n_rows long, loss double, val_loss double, val_acc double, kept string"
        return HeadModel(weights), spark.createDataFrame(log, schema)


__all__ = ["DenseHead", "HeadModel", "Weights", "focal", "gradient", "halve_after"]
