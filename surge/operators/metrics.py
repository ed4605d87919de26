"""Model metrics over a *scored* DataFrame: one row per prediction with
(group keys..., label, score) for classifiers and (group keys..., y, yhat) for
regressors.  Every metric is an aggregate grouped by (model, dataset); AUROC
and ROC points need cumulative counts over the distinct scores, computed with
a two-level scan over score buckets so no group sits in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUP = ("model", "dataset")


def predicted_class(score: Column, threshold: float = 0.5) -> Column:
    """Class from a probability: 1 only when strictly above the threshold
    (a two-class argmax picks the first class on a tie)."""
    return (score > threshold).cast("int")


def _score_counts(df: DataFrame, group: Sequence[str], label: str, score: str, buckets: int) -> DataFrame:
    """(group, score, pos, neg) per distinct score, plus the count of negatives /
    positives at strictly lower scores (``n_below``, ``p_below``) - via
    per-bucket totals and their running sums."""
    g = list(group)
    s = df.groupBy(*g, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    # bucket boundaries at approximate quantiles of the distinct scores, so each
    # bucket holds a similar share whatever the score distribution; the split
    # list is bounded by ``buckets``
    qs = [i / buckets for i in range(1, buckets)]
    cuts = s.agg(F.percentile_approx("score", qs, 20 * buckets)).first()[0] or []
    splits = [-math.inf, *sorted(set(c for c in cuts if c is not None)), math.inf]
    s = Bucketizer(splits=splits, inputCol="score", outputCol="_bk", handleInvalid="keep").transform(s)
    wl = Window.partitionBy(*g, "_bk").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    local = s.withColumns({"_nb": F.coalesce(F.sum("neg").over(wl), F.lit(0)),
                           "_pb": F.coalesce(F.sum("pos").over(wl), F.lit(0))})
    tot = s.groupBy(*g, "_bk").agg(F.sum("neg").alias("_bn"), F.sum("pos").alias("_bp"))
    wc = Window.partitionBy(*g).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    carry = tot.select(*g, "_bk", F.coalesce(F.sum("_bn").over(wc), F.lit(0)).alias("_cn"),
                       F.coalesce(F.sum("_bp").over(wc), F.lit(0)).alias("_cp"))
    allg = tot.groupBy(*g).agg(F.sum("_bn").alias("all_neg"), F.sum("_bp").alias("all_pos"))
    out = local.join(carry, on=[*g, "_bk"]).join(allg, on=g)
    return out.select(*g, "score", "pos", "neg", "all_neg", "all_pos",
                      (F.col("_nb") + F.col("_cn")).alias("n_below"), (F.col("_pb") + F.col("_cp")).alias("p_below"))


def auroc(df: DataFrame, *, group: Sequence[str] = GROUP, label: str = "label", score: str = "score",
          buckets: int = 512) -> DataFrame:
    """Area under the ROC curve with ties counted half:
    sum over distinct scores of pos * (negatives below + neg / 2) / (all_pos * all_neg)."""
    c = _score_counts(df, group, label, score, buckets)
    return c.groupBy(*group).agg(
        F.try_divide(F.sum(F.col("pos") * (F.col("n_below") + F.col("neg") / 2.0)),
                     (F.first("all_pos") * F.first("all_neg")).cast("double")).alias("AUROC"))


def roc_curve(df: DataFrame, *, group: Sequence[str] = GROUP, label: str = "label", score: str = "score",
              buckets: int = 512) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score: rates of rows scoring >= threshold."""
    c = _score_counts(df, group, label, score, buckets)
    return c.select(*group, F.col("score").alias("threshold"),
                    F.try_divide((F.col("all_neg") - F.col("n_below")).cast("double"), F.col("all_neg")).alias("fpr"),
                    F.try_divide((F.col("all_pos") - F.col("p_below")).cast("double"), F.col("all_pos")).alias("tpr"))


def classification_metrics(df: DataFrame, *, group: Sequence[str] = GROUP, label: str = "label",
                           score: str = "score", threshold: float = 0.5, with_auroc: bool = True,
                           predicted: str | None = None) -> DataFrame:
    """Accuracy, AUROC, Recall, Precision, F1-Score per group (undefined -> 0).  The class is the column ``predicted``, or, without
    one, whether the score exceeds ``threshold``."""
    pred = predicted_class(F.col(score), threshold) if predicted is None else F.col(predicted)
    y = F.col(label)
    g = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if((pred == 1) & (y == 1)).alias("_tp"), F.count_if((pred == 1) & (y != 1)).alias("_fp"),
        F.count_if((pred == 0) & (y == 1)).alias("_fn"), F.count_if(pred == y).alias("_ok"))
    tp, fp, fn = F.col("_tp"), F.col("_fp"), F.col("_fn")
    prec = F.coalesce(F.try_divide(tp.cast("double"), tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp.cast("double"), tp + fn), F.lit(0.0))
    out = g.select(*group, (F.col("_ok") / F.col("_n")).alias("Accuracy"), rec.alias("Recall"),
                   prec.alias("Precision"),
                   F.coalesce(F.try_divide(2.0 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("F1-Score"))
    if with_auroc:
        out = out.join(auroc(df, group=group, label=label, score=score), on=list(group), how="left")
    return out


def regression_metrics(df: DataFrame, *, group: Sequence[str] = GROUP, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """RMSE, MAE, R-squared (1 - SSE/SST) and MAPE x 100 over rows with y != 0."""
    e = F.col(y) - F.col(yhat)
    g = df.groupBy(*group).agg(
        F.avg(e * e).alias("_mse"), F.avg(F.abs(e)).alias("MAE"), F.sum(e * e).alias("_sse"),
        (F.count(F.col(y)) * F.var_pop(F.col(y))).alias("_sst"),
        F.avg(F.when(F.col(y) != 0, F.abs(e) / F.abs(F.col(y)))).alias("_mape"))
    return g.select(*group, F.sqrt("_mse").alias("RMSE"), "MAE",
                    (1 - F.try_divide(F.col("_sse"), F.col("_sst"))).alias("R2"),
                    (F.col("_mape") * 100).alias("MAPE"))


def confusion_matrix(df: DataFrame, *, group: Sequence[str] = GROUP, label: str = "label", score: str = "score",
                     threshold: float = 0.5) -> DataFrame:
    """Complete 2 x 2 grid (actual, predicted, count) per group, zeros included."""
    pred = predicted_class(F.col(score), threshold)
    y = (F.col(label) == 1).cast("int")
    cells = [(a, p) for a in (0, 1) for p in (0, 1)]
    g = df.groupBy(*group).agg(*[F.count_if((y == a) & (pred == p)).alias(f"c{a}{p}") for a, p in cells])
    return g.select(*group, F.explode(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"c{a}{p}").alias("count"))
        for a, p in cells])).alias("r")).select(*group, "r.*")


def best_by(metrics: DataFrame, *, metric: str, order: Sequence[str], dataset: str = "Test",
            model: str = "model") -> DataFrame:
    """Row of the best model on ``dataset`` by ``metric``; ties go to the model
    listed first in ``order``.  The window runs over the small leaderboard."""
    pos = F.array_position(F.array(*[F.lit(m) for m in order]), F.col(model))
    w = Window.orderBy(F.desc_nulls_last(metric), pos)
    return metrics.where(F.col("dataset") == dataset).withColumn("_r", F.row_number().over(w)) \
                  .where(F.col("_r") == 1).drop("_r")


def residuals(df: DataFrame, *, id_col: str = "id", y: str = "y", yhat: str = "yhat") -> DataFrame:
    return df.select(id_col, F.col(y).alias("actual"), F.col(yhat).alias("predicted"),
                     (F.col(y) - F.col(yhat)).alias("residual"))
