"""Exact areas under the ROC and precision-recall curves, for any number of rows and scores.

Rows with one score are one point of a curve. They are counted first, in the map
tasks; the points are then dealt over buckets of scores by a quantile sketch, and
each bucket's points are added up from the totals of the buckets above. No task
sees all scores, and none is thinned out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loyaltide.functions.columns import quoted
from loyaltide.operators.zorder import bucket
from loyaltide.plans.staging import stage

BUCKET_BITS = 10


def curve_points(df: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """Per distinct score: positives, negatives, and both with a score at least as high (tp, fp).

    Rows without label or score are left out; a NaN is a score above all others. Labels above 0.5 are positive.
    """
    score, label = quoted(score_col).cast("double"), quoted(label_col).cast("double")
    known = df.select(score.alias("score"), F.when(label > 0.5, 1).otherwise(0).alias("hit")).filter(
        quoted(score_col).isNotNull() & quoted(label_col).isNotNull())
    points = stage(known.groupBy("score").agg(F.sum("hit").alias("positives"), F.sum(1 - F.col("hit")).alias("negatives")),
                   "curve-points")
    shares = [i / 2 ** BUCKET_BITS for i in range(1, 2 ** BUCKET_BITS)]
    edges = points.filter(~F.isnan("score")).agg(F.percentile_approx("score", shares, 5_000)).first()[0] or [0.0] * len(shares)
    placed = points.withColumn("bucket", bucket(F.col("score"), edges, BUCKET_BITS))
    higher = Window.orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    # At most 2**BUCKET_BITS rows.
    totals = placed.groupBy("bucket").agg(F.sum("positives").alias("p"), F.sum("negatives").alias("n")).select(
        "bucket", *[F.coalesce(F.sum(c).over(higher), F.lit(0)).alias(f"{c}_above") for c in ("p", "n")])
    inside = Window.partitionBy("bucket").orderBy(F.col("score").desc())
    return placed.join(F.broadcast(totals), "bucket").select(
        "score", "positives", "negatives", (F.col("p_above") + F.sum("positives").over(inside)).alias("tp"),
        (F.col("n_above") + F.sum("negatives").over(inside)).alias("fp"))


def areas(df: DataFrame, score_col: str = "score", label_col: str = "label") -> DataFrame:
    """One row: auc_roc, ties counting half, and auc_pr by trapezoids from the first point's precision on; null without
    both kinds of labels."""
    points = curve_points(df, score_col, label_col)
    tp, fp, p, n = (F.col(c).cast("double") for c in ("tp", "fp", "positives", "negatives"))
    positives, negatives = F.sum(p), F.sum(n)
    ranked = F.sum(n * (tp - p / 2))  # positives above each negative

    def precision(hits: Column, misses: Column) -> Column:
        return hits / (hits + misses)

    first = (tp == p) & (fp == n)
    before = F.when(first, precision(tp, fp)).otherwise(precision(tp - p, F.greatest(fp - n, F.lit(0.0))))
    # Up to the first point with a positive, recall is 0 and adds no area.
    strip = F.when(p > 0, p * (precision(tp, fp) + F.coalesce(before, F.lit(0.0))) / 2).otherwise(0.0)
    both = (positives > 0) & (negatives > 0)
    return points.agg(F.when(both, ranked / (positives * negatives)).alias("auc_roc"),
                      F.when(both, F.sum(strip) / positives).alias("auc_pr"))
