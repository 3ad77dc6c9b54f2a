"""Customer features as of many cut dates, without leakage: nothing after a cut enters its features.

All cuts are answered in one pass. An order falls between two cuts; orders of a
customer between the same two cuts are combined, in the map tasks, into totals
that add up (counts, sums, squares, ends, the first order and the last two). A
window over a customer's few combined rows, at most one more than there are
cuts, adds them up from the beginning: what a row holds is what was known at the
cuts up to the customer's next row. Labels come from after the cut: the time to
the customer's next order, if it was observed for long enough.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loyaltide.functions.columns import CHURN_DAYS, safe_ratio
from loyaltide.operators.features import CUSTOMER, PURCHASED, SPEND

# Names of the features and what they are made of.
AVERAGED = {
    "avg_order_value": SPEND, "avg_review_score": "review_score", "avg_payment_types": "num_payment_types",
    "avg_installments": "avg_installments", "avg_freight_ratio": "freight_ratio", "weekend_purchase_ratio": "weekend",
    "avg_purchase_hour": "purchase_hour", "avg_categories_per_order": "num_categories",
    "avg_delivery_delay": "delivery_delay_days", "avg_items_per_order": "num_items",
}
SUMMED = {"monetary": SPEND, "total_freight": "total_freight", "total_category_count": "category_count",
          "total_items_purchased": "num_items"}
LEAST = {"min_review_score": "review_score"}
GREATEST = {"max_delivery_delay": "delivery_delay_days"}
DEVIATION = {"std_review_score": "review_score"}
OF_FIRST = ("primary_payment_type", "customer_state")


def _measures(orders: DataFrame) -> dict[str, Column]:
    own = {c: F.col(c) for c in {*AVERAGED.values(), *SUMMED.values(), *LEAST.values(), *GREATEST.values()}
           if c in orders.columns}
    return own | {
        "freight_ratio": safe_ratio(F.col("total_freight"), F.col(SPEND), 0.0),
        "weekend": F.when(F.col("purchase_dow").isin(1, 7), 1).otherwise(0),
        "category_count": F.size("categories"),
    }


def _combined(measures: Mapping[str, Column]) -> dict[str, Column]:
    """Aggregates of the orders between two cuts, which add up over time."""
    out = {"orders": F.count("order_id"), "first_at": F.min("at"), "last_at": F.max("at")}
    for name in sorted({*AVERAGED.values(), *SUMMED.values()}):
        out |= {f"sum_{name}": F.sum(measures[name].cast("double")), f"n_{name}": F.count(measures[name])}
    out |= {f"sq_{name}": F.sum(F.pow(measures[name], 2)) for name in DEVIATION.values()}
    out |= {f"min_{name}": F.min(measures[name]) for name in LEAST.values()}
    out |= {f"max_{name}": F.max(measures[name]) for name in GREATEST.values()}
    return out


def _last_two(orders: DataFrame) -> DataFrame:
    """Spend of the last two orders of a customer before each cut, in order of time; map tasks keep two rows each."""
    ranked = Window.partitionBy(CUSTOMER, "cut").orderBy(F.col("at").desc(), F.col("order_id").desc())
    kept = orders.select(CUSTOMER, "cut", "at", "order_id", SPEND).withColumn("_rn", F.row_number().over(ranked)) \
        .filter("_rn <= 2")
    return kept.groupBy(CUSTOMER, "cut").agg(F.array_sort(F.collect_list(F.struct("at", "order_id", SPEND))).alias("last"))


def _first(orders: DataFrame) -> DataFrame:
    ranked = Window.partitionBy(CUSTOMER, "cut").orderBy("at", "order_id")
    return orders.select(CUSTOMER, "cut", "at", "order_id", *OF_FIRST).withColumn("_rn", F.row_number().over(ranked)) \
        .filter("_rn = 1").drop("_rn", "at", "order_id")


def _next_cut(at: Column, cuts: Sequence[dt.datetime]) -> Column:
    """The number of the first cut after a time; a cut's own moment is not before it."""
    number = F.lit(len(cuts))
    for i in reversed(range(len(cuts))):
        number = F.when(at < _moment(cuts[i]), i).otherwise(number)
    return number


def _moment(cut: dt.datetime) -> Column:
    """By its text, so that no time zone shifts it."""
    return F.lit(cut.isoformat(sep=" ")).cast("timestamp_ntz")


def features_as_of(orders: DataFrame, cuts: Sequence[str | dt.datetime], horizon_days: int = CHURN_DAYS) -> DataFrame:
    """One row per cut and customer with an order before it: ``as_of``, features of the orders before, and the label.

    ``orders`` is the transformed order table. ``churn_label`` is 1 if no order
    follows within ``horizon_days`` from the cut on, and null if the table ends
    before that, which the latest order of all tells. An order counts with all
    its columns from its purchase on, reviews and delivery included. Rows without
    customer or time are left out.
    """
    cuts = sorted({dt.datetime.fromisoformat(c) if isinstance(c, str) else c for c in cuts})
    if not cuts:
        raise ValueError("give at least one cut")
    at = F.col(PURCHASED).cast("timestamp_ntz")
    known = orders.filter(F.col(CUSTOMER).isNotNull() & at.isNotNull()).withColumn("at", at) \
        .withColumn("cut", _next_cut(F.col("at"), cuts))
    end = known.agg(F.max("at")).scalar()
    measures = _measures(orders)
    combined = known.groupBy(CUSTOMER, "cut").agg(*[v.alias(k) for k, v in _combined(measures).items()])
    pieces = combined.join(_last_two(known), [CUSTOMER, "cut"]).join(_first(known), [CUSTOMER, "cut"])

    by_time = Window.partitionBy(CUSTOMER).orderBy("cut")
    so_far = by_time.rowsBetween(Window.unboundedPreceding, 0)
    running = {c: F.sum(c).over(so_far) for c in combined.columns if c.startswith(("sum_", "n_", "sq_")) or c == "orders"}
    running |= {c: F.min(c).over(so_far) for c in combined.columns if c.startswith("min_") or c == "first_at"}
    running |= {c: F.max(c).over(so_far) for c in combined.columns if c.startswith("max_") or c == "last_at"}
    # Every piece has an order, so a customer's last two are in the last two pieces.
    running["last"] = F.slice(F.concat(F.coalesce(F.lag("last").over(by_time), F.filter("last", lambda x: F.lit(False))),
                                       F.col("last")), -2, 2)
    running |= {c: F.first(c).over(so_far) for c in OF_FIRST}
    following = {"next_at": F.lead("first_at").over(by_time), "next_cut": F.lead("cut", 1, len(cuts)).over(by_time)}
    added = pieces.select(CUSTOMER, "cut", *[v.alias(k) for k, v in (running | following).items()])

    # A piece is what is known at its cut, and at those that follow before the customer's next piece.
    spread = added.filter(F.col("cut") < len(cuts)).withColumn(
        "cut", F.explode(F.sequence("cut", F.greatest(F.col("next_cut") - 1, F.col("cut")))))
    spread = spread.withColumn("as_of", F.element_at(F.array(*map(_moment, cuts)), F.col("cut") + 1))
    return spread.select("as_of", CUSTOMER, *_features(), _label(end, horizon_days).alias("churn_label"))


def _features() -> list[Column]:
    def average(name: str) -> Column:
        return safe_ratio(F.col(f"sum_{name}"), F.col(f"n_{name}"))

    def deviation(name: str) -> Column:
        n, s, sq = F.col(f"n_{name}"), F.col(f"sum_{name}"), F.col(f"sq_{name}")
        return F.when(n > 1, F.sqrt(F.greatest(sq - s * s / n, F.lit(0.0)) / (n - 1))).otherwise(0.0)

    def summed(feature: str, name: str) -> Column:
        value = F.when(F.col(f"n_{name}") > 0, F.col(f"sum_{name}"))
        if feature == "total_category_count":
            return F.coalesce(value, F.lit(0)).cast("int")
        return value.cast("bigint") if feature == "total_items_purchased" else value

    last = F.aggregate(F.transform("last", lambda x: F.coalesce(x[SPEND], F.lit(0.0))), F.lit(0.0), lambda a, x: a + x)
    counted = F.size(F.filter("last", lambda x: x[SPEND].isNotNull()))
    overall = average(SPEND)
    return [
        F.datediff("as_of", "last_at").alias("recency_days"), F.col("orders").alias("frequency"),
        *[average(v).alias(k) for k, v in AVERAGED.items()], *[summed(k, v).alias(k) for k, v in SUMMED.items()],
        *[F.col(f"min_{v}").alias(k) for k, v in LEAST.items()], *[F.col(f"max_{v}").alias(k) for k, v in GREATEST.items()],
        *[deviation(v).alias(k) for k, v in DEVIATION.items()], *map(F.col, OF_FIRST),
        F.coalesce(safe_ratio(safe_ratio(last, counted) - overall, overall, 0.0), F.lit(0.0)).alias("spend_trend"),
    ]


def _label(end: Column, horizon_days: int) -> Column:
    horizon = F.col("as_of") + F.expr(f"INTERVAL {int(horizon_days)} DAYS")
    # Only an order after the cut counts: next_at belongs to the next piece, which may lie behind several cuts.
    returned = F.coalesce(F.col("next_at") < horizon, F.lit(False))
    return F.when(returned, 0).when(end >= horizon, 1)
