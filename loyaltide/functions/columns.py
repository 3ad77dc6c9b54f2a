"""Column expressions and column lists shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Risk tiers by lower bound of the churn probability.
RISK_TIERS = (("HIGH", 0.75), ("MEDIUM", 0.50), ("LOW", 0.25))
LOWEST_TIER = "SAFE"

# Fixed value: days without an order after which a customer counts as churned.
CHURN_DAYS = 180


LONG_DIGITS = 18  # decimal digits that a long holds


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns of whole or floating point numbers, and decimals of up to 18 digits, which are ranked as longs.

    Longer decimals are left out: neither a double nor a long holds their digits.
    """
    wanted = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)

    def numeric(kind: T.DataType) -> bool:
        return isinstance(kind, wanted) or isinstance(kind, T.DecimalType) and kind.precision <= LONG_DIGITS

    return [f.name for f in df.schema if numeric(f.dataType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def as_list(value: str | Sequence[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def quoted(name: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def finite_double(name: str) -> Column:
    """The column as double, with NaN as null so that it takes no quantile rank."""
    value = quoted(name).cast("double")
    return F.when(~F.isnan(value), value).alias(name)


def safe_ratio(numerator: Column, denominator: Column, default: float | None = None) -> Column:
    """Division that gives ``default`` unless the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(default).cast("double"))


def churn_flag(recency_days: Column, threshold_days: int = CHURN_DAYS) -> Column:
    return F.when(recency_days > threshold_days, 1).otherwise(0)


def tier_of(score: Column) -> Column:
    """The risk tier of a score; one that is missing, null or NaN, reaches no bound and has the lowest tier."""
    score = F.nullif(score.cast("double"), F.lit(float("nan")))
    (first, bound), *rest = RISK_TIERS
    tier = F.when(score >= bound, first)
    for name, bound in rest:
        tier = tier.when(score >= bound, name)
    return tier.otherwise(LOWEST_TIER)


def rows_where(condition: Column) -> Column:
    """Number of rows for which the condition holds, 0 for none."""
    return F.count_if(F.coalesce(condition, F.lit(False)))


def total(columns: Sequence[Column]) -> Column:
    result = F.lit(0)
    for column in columns:
        result = result + column
    return result
