"""Binary classification metrics as one conditional-sum aggregate.

Positive class is 1; a zero denominator gives 0.0. Every metric is
grouped by optional ``by`` columns (model, slice, params, fold ...), so a
whole evaluation grid is one aggregate with map-side combine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction",
                     by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn, n per group."""
    y, p = F.col(label), F.col(pred)

    def cnt(cond: Column) -> Column:
        return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")

    return df.groupBy(*by).agg(cnt((y == 1) & (p == 1)).alias("tp"), cnt((y != 1) & (p == 1)).alias("fp"),
                               cnt((y == 1) & (p != 1)).alias("fn"), cnt((y != 1) & (p != 1)).alias("tn"),
                               F.count(F.lit(1)).cast("long").alias("n"))


def metrics_from_counts(c: DataFrame) -> DataFrame:
    """M1-M5 from confusion counts."""
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return (c.withColumn("precision", _ratio(tp, tp + fp))
             .withColumn("recall", _ratio(tp, tp + fn))
             .withColumn("accuracy", _ratio(tp + tn, tp + tn + fp + fn))
             .withColumn("f1", _ratio(2 * tp, 2 * tp + fp + fn))
             .withColumn("f1_micro", _ratio(tp + tn, tp + tn + fp + fn)))


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "prediction",
                   by: Sequence[str] = ()) -> DataFrame:
    """M1 precision, M2 recall, M3 accuracy, M4 binary F1, M5 micro F1 (= accuracy)."""
    return metrics_from_counts(confusion_counts(df, label, pred, by))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction",
                     by: Sequence[str] = ()) -> DataFrame:
    """M6: rows = truth, columns = prediction, all four cells present (zero cells included)."""
    c = confusion_counts(df, label, pred, by)
    cells = F.array(*[F.struct(F.lit(t).alias("true_label"), F.lit(q).alias("pred_label"), F.col(k).alias("n"))
                      for t, q, k in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))])
    return c.select(*by, F.explode(cells).alias("_c")).select(*by, "_c.*")


def thresholded_accuracy(df: DataFrame, label: str = "label", score: str = "score",
                         threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """M9: mean of (score > threshold) == label."""
    hit = F.when((F.col(score) > threshold).cast("int") == F.col(label), F.lit(1.0)).otherwise(F.lit(0.0))
    return df.groupBy(*by).agg(F.avg(hit).alias("binary_accuracy"))


def focal_loss_expr(label: str, score: str, gamma: float = 2.0, eps: float = 1e-7) -> Column:
    """Per-row binary focal cross-entropy ``-(1 - p_t)^gamma * ln(p_t)``, p clipped to [eps, 1 - eps]."""
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    y = F.col(label).cast("double")
    p_t = y * p + (F.lit(1.0) - y) * (F.lit(1.0) - p)
    bce = -(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))
    return F.pow(F.lit(1.0) - p_t, F.lit(gamma)) * bce


def focal_loss(df: DataFrame, label: str = "label", score: str = "score", gamma: float = 2.0,
               eps: float = 1e-7, by: Sequence[str] = ()) -> DataFrame:
    """Mean focal loss."""
    return df.groupBy(*by).agg(F.avg(focal_loss_expr(label, score, gamma, eps)).alias("focal_loss"))


def transfer_evaluation(scored: DataFrame, slices: dict[str, DataFrame] | None = None,
                        label: str = "label", pred: str = "prediction", model: str = "model",
                        key: str = "doc_id") -> DataFrame:
    """M7: metrics of every model on every slice of a second corpus.

    ``scored`` holds (model, key, label, prediction) for the whole corpus;
    ``slices`` maps a slice name to a frame of the keys it contains (the
    whole corpus is always the slice 'all').
    """
    parts = [scored.withColumn("slice", F.lit("all"))]
    for name, keys in (slices or {}).items():
        parts.append(scored.join(keys.select(key), key, "left_semi").withColumn("slice", F.lit(name)))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    return binary_metrics(stacked, label, pred, by=[model, "slice"])


def cv_summary(fold_predictions: DataFrame, params: Sequence[str], fold: str = "fold",
               label: str = "label", pred: str = "prediction") -> DataFrame:
    """M8: accuracy and F1 per (params, fold), then their mean per parameter set."""
    per_fold = binary_metrics(fold_predictions, label, pred, by=[*params, fold])
    return per_fold.groupBy(*params).agg(F.avg("accuracy").alias("mean_accuracy"),
                                         F.avg("f1").alias("mean_f1"),
                                         F.count(F.lit(1)).cast("long").alias("n_folds"))
