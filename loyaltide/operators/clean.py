"""Row-level cleaning: latest row per key, null filling, winsorizing, derived dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loyaltide.functions.columns import as_list, numeric_columns, quoted, string_columns
from loyaltide.functions.quantiles import quantile_struct

# Columns to winsorize and the neutral review score.
WINSORIZED = ("total_payment_value", "total_price", "total_freight", "avg_item_price", "num_items",
              "avg_installments")
WINSOR_LIMITS = (0.01, 0.99)
NEUTRAL_REVIEW = 3


def dedup_latest(df: DataFrame, key: str | Sequence[str] = "order_id",
                 time_col: str = "order_purchase_timestamp",
                 tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """The latest row per key. Ties go by ``tie_breakers``, by default all other columns.

    Filtering on the row number lets Spark trim each map task to one row per key
    before the shuffle, so a key that holds many rows does not reach one task whole.
    """
    keys = as_list(key)
    ties = tie_breakers if tie_breakers is not None else [
        c for c in df.columns if c not in keys and c != time_col]
    latest = Window.partitionBy(*keys).orderBy(F.col(time_col).desc(), *ties)
    return df.withColumn("_rn", F.row_number().over(latest)).filter(F.col("_rn") == 1).drop("_rn")


def null_fill(df: DataFrame, keys: Sequence[str] = (), accuracy: int | None = None) -> DataFrame:
    """Numeric nulls become the column median, review scores 3, strings ``'unknown'``.

    The median of a whole-number column is cut to a whole number, that of a
    decimal column keeps its digits; a column without values is filled with 0. Timestamps, arrays and ``keys`` stay.
    """
    types = dict(df.dtypes)
    filled = {c: F.coalesce(quoted(c), F.lit("unknown")) for c in string_columns(df, keys)}
    numeric = numeric_columns(df, keys)
    if "review_score" in numeric:
        filled["review_score"] = F.coalesce("review_score", F.lit(NEUTRAL_REVIEW).cast(types["review_score"]))
    by_median = [c for c in numeric if c != "review_score"]
    if by_median:
        medians = quantile_struct(df, by_median, [0.5], accuracy)
        for c in by_median:
            filled[c] = F.coalesce(quoted(c), medians[c][0].cast(types[c]), F.lit(0).cast(types[c]))
    return df.withColumns(filled)


def winsorize(df: DataFrame, columns: Sequence[str] = WINSORIZED, limits: Sequence[float] = WINSOR_LIMITS,
              accuracy: int | None = None) -> DataFrame:
    """Pull values beyond the two quantiles back to them; nulls stay null."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    types = dict(df.dtypes)
    bounds = quantile_struct(df, present, list(limits), accuracy)

    def capped(c):
        low, high = bounds[c][0].cast(types[c]), bounds[c][1].cast(types[c])
        return F.when(quoted(c) < low, low).when(quoted(c) > high, high).otherwise(quoted(c))

    return df.withColumns({c: capped(c) for c in present})


def date_parts(df: DataFrame, column: str = "order_purchase_timestamp", prefix: str = "purchase") -> DataFrame:
    """Year, month, day of week (1 is Sunday) and hour of a timestamp column."""
    if column not in df.columns:
        return df
    return df.withColumns({
        f"{prefix}_year": F.year(column),
        f"{prefix}_month": F.month(column),
        f"{prefix}_dow": F.dayofweek(column),
        f"{prefix}_hour": F.hour(column),
    })


def delivery_delay(df: DataFrame, delivered: str = "order_delivered_customer_date",
                   estimated: str = "order_estimated_delivery_date") -> DataFrame:
    """Days between estimate and delivery, positive if late."""
    if delivered not in df.columns or estimated not in df.columns:
        return df
    return df.withColumn("delivery_delay_days", F.datediff(delivered, estimated))
