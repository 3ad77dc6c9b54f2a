import datetime as dt

import pytest
from pyspark.sql import functions as F

from loyaltide.operators import asof, features

SCHEMA = ("order_id long, customer_unique_id string, order_purchase_timestamp timestamp_ntz, total_payment_value double, "
          "review_score int, num_payment_types long, avg_installments double, purchase_dow int, purchase_hour int, "
          "total_freight double, num_categories int, categories array<string>, delivery_delay_days int, num_items long, "
          "primary_payment_type string, customer_state string")
CUTS = ["2020-02-01", "2020-03-01", "2020-09-01"]


def order(i, customer, day, spend=10.0, **other):
    row = dict(order_id=i, customer_unique_id=customer, order_purchase_timestamp=dt.datetime.fromisoformat(day),
               total_payment_value=spend, review_score=i % 5 + 1, num_payment_types=1, avg_installments=1.0, purchase_dow=2,
               purchase_hour=3, total_freight=1.0, num_categories=1, categories=["c"], delivery_delay_days=i, num_items=2,
               primary_payment_type=f"t{i}", customer_state=f"s{i}")
    return tuple((row | other).values())


def frame(spark, *orders):
    return spark.createDataFrame(orders, SCHEMA)


ORDERS = [order(1, "a", "2020-01-05", 10.0), order(2, "a", "2020-01-20", 30.0), order(3, "a", "2020-02-10", 20.0),
          order(4, "b", "2020-02-29 23:59:59", 5.0), order(5, "b", "2020-03-01", 7.0), order(6, "c", "2020-12-01", 1.0),
          order(7, None, "2020-01-01"), order(8, "d", "2020-01-31", None, review_score=None)]


def found(df):
    return {(str(r.as_of)[:10], r.customer_unique_id): r for r in df.collect()}


def test_only_orders_before_the_cut_count(spark):
    got = found(asof.features_as_of(frame(spark, *ORDERS), CUTS))
    assert set(got) == {("2020-02-01", "a"), ("2020-02-01", "d"), ("2020-03-01", "a"), ("2020-03-01", "b"), ("2020-03-01", "d"),
                        ("2020-09-01", "a"), ("2020-09-01", "b"), ("2020-09-01", "d")}
    first, second, third = (got[c, "a"] for c in CUTS)
    assert (first.frequency, first.monetary, first.recency_days, first.spend_trend) == (2, 40.0, 12, 0.0)
    assert (second.frequency, second.monetary, second.recency_days) == (3, 60.0, 20)
    assert second.spend_trend == pytest.approx((25 - 20) / 20) and third.recency_days == 204
    assert {r.primary_payment_type for r in (first, second, third)} == {"t1"}
    # A cut's own moment is after it.
    assert got["2020-03-01", "b"].frequency == 1 and got["2020-09-01", "b"].frequency == 2


def test_labels_come_from_after_the_cut(spark):
    got = found(asof.features_as_of(frame(spark, *ORDERS), CUTS))
    assert got["2020-02-01", "a"].churn_label == 0  # ordered ten days later
    assert got["2020-03-01", "a"].churn_label == 1  # 180 days on, nothing
    assert got["2020-03-01", "b"].churn_label == 0  # at the cut itself
    assert got["2020-09-01", "a"].churn_label is None  # the table ends in December
    assert found(asof.features_as_of(frame(spark, *ORDERS), CUTS, horizon_days=30))["2020-09-01", "a"].churn_label == 1


def test_later_orders_change_no_feature(spark):
    later = [order(20 + i, c, d, 99.0) for i, (c, d) in enumerate([("a", "2020-09-02"), ("b", "2020-09-01"), ("e", "2021-01-01")])]
    before = found(asof.features_as_of(frame(spark, *ORDERS), CUTS).drop("churn_label"))
    after = found(asof.features_as_of(frame(spark, *ORDERS, *later), CUTS).drop("churn_label"))
    assert before == after


def test_each_cut_equals_the_features_of_the_orders_before_it(spark):
    orders = [order(i, f"c{i % 13}", f"20{10 + i % 9}-0{i % 8 + 1}-1{i % 10} 0{i % 7}:00:00", float(i * 37 % 101),
                    review_score=None if i % 6 == 0 else i % 5 + 1, categories=None if i % 4 == 0 else ["x"] * (i % 3))
              for i in range(300)]
    df = frame(spark, *orders)
    cuts = ["2012-05-05", "2014-01-01", "2017-03-03 04:00:00"]
    got = found(asof.features_as_of(df, cuts))
    for cut in cuts:
        plain = features.feature_groups(df.filter(F.col("order_purchase_timestamp") < F.lit(cut).cast("timestamp_ntz")), cut)
        rows = {r.customer_unique_id: r.asDict() for r in plain.collect()}
        assert {c for d, c in got if d == cut[:10]} == set(rows)
        for customer, row in rows.items():
            mine = got[cut[:10], customer].asDict()
            for name, value in row.items():
                assert mine[name] == (pytest.approx(value, abs=1e-9) if isinstance(value, float) else value), name


def test_no_orders_and_no_cuts(spark):
    assert asof.features_as_of(frame(spark), CUTS).count() == 0
    assert asof.features_as_of(frame(spark, *ORDERS), ["2000-01-01"]).count() == 0
    with pytest.raises(ValueError):
        asof.features_as_of(frame(spark), [])


def test_orders_are_shuffled_three_times_whatever_the_number_of_cuts(spark, plan):
    def shuffles(cuts):
        return plan(asof.features_as_of(frame(spark, *ORDERS), cuts)).split("== Physical")[-1].count("Exchange hashpartitioning")
    assert shuffles(CUTS) == shuffles([f"20{y:02d}-01-01" for y in range(30)])
