"""The operators chained into the batch flows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyaltide.functions.columns import CHURN_DAYS
from loyaltide.operators import clean, drift, features
from loyaltide.plans.staging import stage
from loyaltide.sources.metrics import append_metrics, as_metrics

KEYS = ("order_id", "customer_unique_id")


def transform_pipeline(wide: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Latest row per order, nulls filled, outliers capped, date parts and delay added.

    Nulls are filled before the delay is computed, so a missing delivery leaves the
    delay null. The medians and the bounds each need the rows before them, so the
    deduplicated rows are staged: the joins behind ``wide`` run once.
    """
    latest = stage(clean.dedup_latest(wide), "latest-orders")
    return (
        latest
        .transform(clean.null_fill, keys=KEYS, accuracy=accuracy)
        .transform(clean.winsorize, accuracy=accuracy)
        .transform(clean.date_parts)
        .transform(clean.delivery_delay)
    )


def user_features(orders: DataFrame, reference_date: str | None = None, threshold_days: int = CHURN_DAYS,
                  accuracy: int | None = None) -> DataFrame:
    """The feature store: one row per customer with features, label and value flags.

    ``orders`` is the transformed order table. The customer rows are staged, since
    the spend quartile has to be known before any row can be flagged.
    """
    grouped = stage(features.feature_groups(orders, reference_date), "customer-features")
    return grouped.transform(features.churn_label, threshold_days).transform(features.value_flags, accuracy)


def drift_cycle(reference: DataFrame, current: DataFrame, train: Callable[[DataFrame], DataFrame],
                label_col: str = "churn_label", metrics_path: str | None = None, run_id: str = "drift-cycle",
                **decision) -> DataFrame:
    """Drift report, decision and, if so decided, a training on the current rows.

    Returns the decision row with the training metrics by name, null if there was
    no training. Report, decision and metrics are recorded under ``metrics_path`` if given.
    """
    report = stage(drift.drift_report(reference, current, label_col=label_col), "drift-report")
    verdict = stage(
        drift.retrain_decision(report, drift.drift_label(reference, current, label_col), **decision),
        "retrain-decision")
    records = [as_metrics(report, "drift", run_id, F.col("feature")), as_metrics(verdict, "retrain", run_id)]
    retrain, found = verdict.first()["retrain"], F.lit(None)
    if retrain:
        metrics = stage(train(current), "retrain-metrics")
        records.append(as_metrics(metrics, "train", run_id))
        pairs = [part for c in metrics.columns for part in (F.lit(c), F.col(c).try_cast("double"))]
        found = metrics.select(F.create_map(*pairs)).scalar()
    if metrics_path:
        for record in records:
            append_metrics(record, metrics_path)
    return verdict.withColumn("metrics", found.cast("map<string,double>"))
