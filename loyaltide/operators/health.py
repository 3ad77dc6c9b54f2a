"""Health of tables and predictions, and row counts across stages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loyaltide.functions.columns import rows_where, safe_ratio
from loyaltide.operators.profile import null_counts

# Alert thresholds.
MAX_NULL_RATE = 0.05
MIN_ROWS = 100
MAX_ROW_DROP = 0.20
MAX_CHURN_RATE = 0.60
MIN_CHURN_RATE = 0.01


def _alert(condition: Column, column: str | None, kind: str, value: Column) -> Column:
    return F.when(condition, F.struct(
        F.lit(column).cast("string").alias("column"), F.lit(kind).alias("anomaly"),
        value.cast("double").alias("value")))


def table_health(df: DataFrame, stage: str, critical: Sequence[str] = (),
                 previous_rows: Column | int | None = None) -> DataFrame:
    """One row per anomaly of a table: few rows, row drop, null rate, null in a critical column.

    Checks of the table as a whole have a null ``column``. A healthy table gives
    no rows. All checks come from one pass over the table.
    """
    before = previous_rows if isinstance(previous_rows, Column) else F.lit(previous_rows).cast("bigint")
    rows = F.col("rows")
    drop = safe_ratio(before - rows, before)
    alerts = [_alert(rows < MIN_ROWS, None, "few rows", rows), _alert(drop > MAX_ROW_DROP, None, "row drop", drop)]
    for c in df.columns:
        rate = safe_ratio(F.col("nulls")[c], rows, 0.0)
        alerts.append(_alert(rate > MAX_NULL_RATE, c, "null rate", rate))
        if c in critical:
            alerts.append(_alert(rate > 0, c, "critical null", rate))
    return null_counts(df).select(F.explode(F.array_compact(F.array(*alerts))).alias("alert")).select(
        F.lit(stage).alias("stage"), "alert.*")


def prediction_health(df: DataFrame, batch_id: str = "batch_0", prediction_col: str = "prediction",
                      score_col: str = "churn_probability", tier_col: str = "risk_tier") -> DataFrame:
    """One row for a batch of predictions, none for an empty batch."""
    score = F.avg(score_col) if score_col in df.columns else F.lit(0.0)
    tiers = ("HIGH", "MEDIUM", "LOW", "SAFE")
    in_tier = [
        (rows_where(F.col(tier_col) == t) if tier_col in df.columns else F.lit(None).cast("bigint")).alias(
            f"tier_{t.lower()}") for t in tiers
    ]
    rate = F.col("positives") / F.col("total_predictions")
    return (
        df.agg(
            F.count(F.lit(1)).alias("total_predictions"),
            rows_where(F.col(prediction_col) == 1).alias("positives"),
            F.coalesce(score, F.lit(0.0)).alias("avg_score"), *in_tier)
        .filter(F.col("total_predictions") > 0)
        .select(
            F.lit(batch_id).alias("batch_id"), "total_predictions",
            F.round(rate, 4).alias("churn_rate"), F.round("avg_score", 4).alias("avg_churn_prob"),
            *[f"tier_{t.lower()}" for t in tiers],
            F.when(rate > MAX_CHURN_RATE, "churn rate too high")
            .when(rate < MIN_CHURN_RATE, "churn rate too low").alias("anomaly"))
    )


def row_lineage(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each stage in the given order, with the change from the stage before."""
    counts = reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(i).alias("step"), F.lit(name).alias("stage"), "rows")
        for i, (name, df) in enumerate(stages.items())
    ])
    in_order = Window.orderBy("step")  # one row per stage
    before = F.lag("rows").over(in_order)
    change = F.when(before > 0, (F.col("rows") - before) * 100 / before).when(before == 0, 0.0)
    return counts.select("step", "stage", "rows", change.alias("change_pct"))


def health_check(tables: Mapping[str, DataFrame], critical: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Anomalies of all tables. Each is compared in size with the one before it."""
    found, previous = [], None
    for name, df in tables.items():
        found.append(table_health(df, name, (critical or {}).get(name, ()), previous))
        previous = df.agg(F.count(F.lit(1))).scalar()
    return reduce(DataFrame.unionByName, found)
