from pyspark.sql import functions as F

from loyaltide.operators import health, profile
from loyaltide.sources.schemas import table


def test_conformance_reports_missing_and_uncastable(spark, rows):
    df = spark.createDataFrame([(1, "7"), (2, "x"), (3, None)], "a int, b string")
    got = profile.schema_conformance(df, table(a="int", b="int", c="double"))
    assert rows(got) == [
        ("a", "int", "int", True, True, 0), ("b", "int", "string", True, False, 1),
        ("c", "double", None, False, False, None)]


def test_null_profile_of_an_empty_table(spark, rows):
    df = spark.createDataFrame([], "a int, b string")
    assert rows(profile.null_profile(df)) == [("a", 0, 0, 0.0), ("b", 0, 0, 0.0)]


def test_balance_and_weights(spark, rows):
    df = spark.createDataFrame([(0,)] * 12 + [(1,)] * 2, "churn_label int")
    assert rows(profile.class_balance(df)) == [(0, 12, 85.71, 6.0, True), (1, 2, 14.29, 6.0, True)]
    weighted = profile.sample_weights(df, profile.class_weights(df)).distinct()
    assert rows(weighted) == [(0, 14 / 24), (1, 3.5)]
    one_class = df.filter("churn_label = 0")
    assert rows(profile.class_balance(one_class)) == [(0, 12, 100.0, None, False)]


def test_correlation_skips_incomplete_rows(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, 4.0, 1.0), (3.0, 6.0, 3.0), (100.0, -5.0, None)], "a double, b double, c double")
    pairs = {(r.feature_a, r.feature_b): round(r["corr"], 6) for r in profile.correlation_pairs(df, ["a", "b", "c"]).collect()}
    assert pairs[("a", "b")] == 1.0
    matrix = profile.correlation_matrix(df, ["a", "b", "c"]).first()[0].toArray()
    assert round(matrix[0][2], 6) == pairs[("a", "c")]


def test_size_profile_limits(spark):
    small = profile.table_size_profile(spark.range(10), "t").first()
    assert (small.broadcastable, small.recommended_partitions) == (True, 1)
    wide = profile.table_size_profile(spark.range(10), "t", row_bytes=100 * 2**20).first()
    assert (wide.broadcastable, wide.recommended_partitions) == (False, 8)
    empty = profile.table_size_profile(spark.range(0), "t", row_bytes=None).first()
    assert (empty.rows, empty.estimated_mb, empty.recommended_partitions) == (0, 0.0, 1)


def test_health_of_small_shrunken_and_holed_tables(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 1)], "a int, b int")
    found = {(r.column, r.anomaly): r.value for r in health.table_health(df, "s", ["b"], 10).collect()}
    assert found == {(None, "few rows"): 3.0, (None, "row drop"): 0.7, ("b", "null rate"): 1 / 3,
                     ("b", "critical null"): 1 / 3}
    big = spark.range(200)
    assert health.table_health(big, "s", ["id"], 0).isEmpty()
    assert [r.anomaly for r in health.table_health(big.limit(0), "s", ["id"], 0).collect()] == ["few rows"]


def test_predictions_out_of_range_and_empty(spark):
    def verdict(positives, n=100):
        df = spark.range(n).select((F.col("id") < positives).cast("double").alias("prediction"))
        row = health.prediction_health(df).first()
        return row and row["anomaly"]

    assert [verdict(61), verdict(60), verdict(1), verdict(0)] == [
        "churn rate too high", None, None, "churn rate too low"]
    assert verdict(0, 0) is None
    assert health.prediction_health(spark.range(0).withColumn("prediction", F.lit(1.0))).isEmpty()


def test_lineage_after_an_empty_stage(spark):
    got = health.row_lineage({"a": spark.range(10), "b": spark.range(5), "c": spark.range(0), "d": spark.range(3)})
    assert [(r.stage, r.change_pct) for r in got.orderBy("step").collect()] == [
        ("a", None), ("b", -50.0), ("c", -100.0), ("d", 0.0)]


def test_wide_tables_are_correlated_as_narrow_ones(spark, monkeypatch):
    df = spark.range(300).select(*[(F.rand(i) + (F.col("id") / 300 if i % 3 else F.lit(0))).alias(f"c{i:02d}") for i in range(12)],
                                 F.lit(1.0).alias("flat"), F.when(F.col("id") != 7, 2.0 * F.col("id")).alias("a.b"))
    narrow = profile.correlation_pairs(df, df.columns, None).collect()
    monkeypatch.setattr(profile, "WIDE", 3)
    wide = profile.correlation_pairs(df, df.columns, None).collect()
    assert [(r.feature_a, r.feature_b) for r in wide] == [(r.feature_a, r.feature_b) for r in narrow]
    for a, b in zip(narrow, wide):
        assert (a.corr is None) == (b.corr is None) and (a.corr is None or abs(a.corr - b.corr) < 1e-9)
    assert [tuple(r)[:2] for r in profile.correlation_pairs(df, df.columns, 5).collect()] == [tuple(r)[:2] for r in wide[:5]]
    assert profile.correlation_pairs(df.limit(0), df.columns).count() == 0


def test_a_thousand_columns(spark):
    df = spark.range(60).select(*[F.rand(i).alias(f"c{i}") for i in range(999)], (F.rand(5) * 2 + 1).alias("twin"))
    best = profile.correlation_pairs(df, df.columns, 3).first()
    assert (best.feature_a, best.feature_b) == ("c5", "twin") and abs(best.corr - 1) < 1e-9


def test_nan_is_a_null_in_every_figure(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    row = profile.numeric_summary(df, ["x"]).first()
    assert (row["min"], row["max"], row["mean"], row.p50, row.nulls) == (1.0, 2.0, 1.5, 1.0, 2)
