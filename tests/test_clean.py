import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from loyaltide.operators import clean, drift, profile
from loyaltide.plans.pipelines import transform_pipeline

DAY = dt.datetime(2024, 1, 1)


def test_null_fill_by_type(spark, rows):
    df = spark.createDataFrame(
        [(1, 1, 1.0, None, "a", None), (2, 2, None, None, None, None), (None, None, 4.0, None, "b", 5)],
        "key int, n int, x double, none double, s string, review_score int")
    filled = clean.null_fill(df, keys=["key"])
    assert rows(filled) == [
        (1, 1, 1.0, 0.0, "a", 3), (2, 2, 1.0, 0.0, "unknown", 3), (None, 1, 4.0, 0.0, "b", 5)]
    assert filled.dtypes == df.dtypes


def test_null_fill_cuts_the_median_of_whole_numbers(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "n int")
    assert clean.null_fill(df).filter("n is null").isEmpty()
    assert dict(clean.null_fill(df).dtypes) == {"n": "int"}


def test_winsorize_keeps_nulls_and_pulls_in_extremes(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("num_items")).union(
        spark.createDataFrame([(None,), (1e9,)], "num_items double"))
    capped = clean.winsorize(df)
    assert capped.filter("num_items is null").count() == 1
    low, high = capped.agg(F.min("num_items"), F.max("num_items")).first()
    assert (low, high) == (11.0, 991.0)


def test_winsorize_without_the_columns_changes_nothing(spark):
    df = spark.range(3)
    assert clean.winsorize(df) is df


def test_dedup_ties_do_not_depend_on_partitions(spark, rows):
    data = [(k, DAY, v) for k in range(5) for v in range(10)]
    df = spark.createDataFrame(data, "order_id int, order_purchase_timestamp timestamp, v int")
    expected = [(k, DAY, 0) for k in range(5)]
    assert rows(clean.dedup_latest(df.repartition(1))) == rows(clean.dedup_latest(df.repartition(9))) == expected


def test_dedup_trims_hot_keys_before_the_shuffle(spark, plan):
    df = spark.range(10).select(
        (F.col("id") % 2).alias("order_id"), F.timestamp_seconds("id").alias("order_purchase_timestamp"), "id")
    text = plan(clean.dedup_latest(df))
    assert "row_number(), 1, Partial" in text


def test_delay_and_dates(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 3, 10, 23), dt.datetime(2024, 3, 9, 1), dt.datetime(2024, 3, 3, 15)),
         (None, dt.datetime(2024, 3, 9, 1), dt.datetime(2024, 3, 3, 15))],
        "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp, "
        "order_purchase_timestamp timestamp")
    got = clean.date_parts(clean.delivery_delay(df)).select(
        "delivery_delay_days", "purchase_year", "purchase_month", "purchase_dow", "purchase_hour").collect()
    assert [tuple(r) for r in got] == [(1, 2024, 3, 1, 15), (None, 2024, 3, 1, 15)]  # a Sunday


def test_operators_leave_tables_without_their_columns_alone(spark):
    df = spark.range(2)
    assert clean.date_parts(df).columns == clean.delivery_delay(df).columns == ["id"]


def test_pipeline_does_not_depend_on_partitions(tables, rows):
    wide = tables.wide
    columns = ["order_id", "total_price", "num_items", "delivery_delay_days", "avg_installments"]
    one = transform_pipeline(wide.repartition(1)).select(*columns)
    many = transform_pipeline(wide.repartition(13)).select(*columns)
    assert rows(one) == rows(many)


def test_decimals_keep_their_digits(spark):
    """17 digits, which a double would round, and a column with a dot in its name."""
    values = ["123456789012345.61", "123456789012345.62", "123456789012345.63", None]
    df = spark.createDataFrame([(Decimal(v) if v else None, None if v else 1.5, v) for v in values],
                               "`a.b` decimal(18,2), x double, s string")
    assert [r[0] for r in clean.null_fill(df).collect()] == [Decimal(v or values[1]) for v in values]
    capped = clean.winsorize(df, ["a.b"], (0.5, 0.5)).collect()
    assert [r[0] for r in capped] == [Decimal(values[1])] * 3 + [None]
    assert clean.null_fill(df).dtypes == df.dtypes and clean.null_fill(df, accuracy=100).dtypes == df.dtypes
    summary = {r.feature: r for r in profile.numeric_summary(df).collect()}
    assert set(summary) == {"a.b", "x"} and summary["a.b"].nulls == 1
    wide = spark.createDataFrame([(Decimal(1),)], "d decimal(38,2)")
    assert clean.null_fill(wide).collect() == wide.collect()  # longer than a long: left as it is


def test_decimals_and_drift(spark):
    rows = [(Decimal(i) / 100,) for i in range(400)]
    old = spark.createDataFrame(rows, "d decimal(10,2)")
    new = spark.createDataFrame([(v + 2,) for v, in rows], "d decimal(10,2)")
    report = drift.drift_report(old, new).collect()
    assert [(r.feature, r.status) for r in report] == [("d", "DRIFT")]
    assert drift.drift_psi(old, old, ["d"]).first().psi == 0
