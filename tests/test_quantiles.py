"""Exact quantiles against a sorted list, with brackets narrow enough to matter."""

import math
import random

import pytest
from pyspark.sql import functions as F

import loyaltide.functions.quantiles as quantiles
from loyaltide.functions.quantiles import column_quantiles

PS = [0.01, 0.25, 0.5, 0.55, 0.75, 0.99]


def brute(values, ps):
    known = sorted(v for v in values if v is not None and not math.isnan(v))
    if not known:
        return None
    # Integer arithmetic: p has two decimals.
    return [known[max(-(-round(p * 100) * len(known) // 100), 1) - 1] for p in ps]


def exact(df, columns, ps=PS):
    return {r.feature: r.quantiles for r in column_quantiles(df, columns, ps).collect()}


@pytest.mark.parametrize("accuracy", [50, 1000, 10_000])
@pytest.mark.parametrize("parts", [1, 7])
def test_same_as_sorting(spark, monkeypatch, accuracy, parts):
    monkeypatch.setattr(quantiles, "BRACKET_ACCURACY", accuracy)
    rng = random.Random(accuracy + parts)
    n = 20_000
    data = [
        (rng.gauss(0, 100), float(rng.randint(0, 9)), 7.0 if i % 3 == 0 else rng.random(), i if i % 5 else None)
        for i in range(n)
    ]
    df = spark.createDataFrame(data, "a double, b double, hot double, gaps long").repartition(parts)
    found = exact(df, df.columns)
    for i, c in enumerate(df.columns):
        assert found[c] == brute([row[i] for row in data], PS), c


def test_nulls_nan_and_empty_columns(spark):
    df = spark.createDataFrame(
        [(1.0, None, 5), (float("nan"), None, 5), (None, None, 5), (3.0, None, 5)], "a double, none double, const int")
    assert exact(df, ["a", "none", "const"], [0.5, 1.0]) == {"a": [1.0, 3.0], "none": None, "const": [5.0, 5.0]}
    assert exact(df.limit(0), ["a"], [0.5]) == {"a": None}


def test_order_of_probabilities_is_kept(spark):
    df = spark.range(100).withColumn("v", F.col("id").cast("double"))
    assert exact(df, ["v"], [0.9, 0.1, 0.5]) == {"v": [89.0, 9.0, 49.0]}


def test_whole_ranks_are_not_moved_by_float_error(spark):
    """0.55 of 1500 rows is row 825, although 0.55 * 1500 is not 825 in binary."""
    df = spark.range(1, 1501).withColumn("v", F.col("id").cast("double"))
    assert exact(df, ["v"], [0.55]) == {"v": [825.0]}


def test_sketch_is_close(spark):
    df = spark.range(50_000).withColumn("v", F.col("id").cast("double"))
    found = {r.feature: r.quantiles for r in column_quantiles(df, ["v"], [0.5], accuracy=1000).collect()}
    assert abs(found["v"][0] - 25_000) <= 50


def test_long_values_beyond_double_precision_stay_exact(spark, rows):
    from loyaltide.operators.clean import null_fill, winsorize

    big = 2 ** 53 + 1
    df = spark.createDataFrame([(big,)] * 5 + [(None,)], "v long")
    assert rows(winsorize(df, ["v"])) == [(big,)] * 5 + [(None,)]
    assert rows(null_fill(df)) == [(big,)] * 6
    spread = spark.createDataFrame([(big + i,) for i in range(101)] + [(None,)], "v long")
    assert null_fill(spread).where(f"v = {big + 50}").count() == 2
    capped = winsorize(spread, ["v"]).agg({"v": "min"}).first()[0], winsorize(spread, ["v"]).agg({"v": "max"}).first()[0]
    assert capped == (big + 1, big + 99)


def test_two_scans_and_small_rankings(spark, monkeypatch, plan):
    """The input is read for the sketch and for the counts only, and one task ranks a part of a bracket."""
    monkeypatch.setattr(quantiles, "BRACKET_ACCURACY", 200)
    plans, counts = [], []

    def watched(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        counts.append(quantiles_stage(df, label))
        return counts[-1]

    quantiles_stage = quantiles.stage
    monkeypatch.setattr(quantiles, "stage", watched)
    table = quantiles_stage(spark.range(200_000).select(F.hash("id").alias("v")), "test-input")
    found = column_quantiles(table, ["v"], [0.5])
    ordered = sorted(r.v for r in table.collect())
    assert found.first()["quantiles"] == [ordered[99_999]]
    assert plans[0].split("Initial Plan")[0].count("FileScan parquet") == 2
    candidates = counts[0].filter("candidate IS NOT NULL").count()
    edges = counts[0].filter("candidate IS NOT NULL").groupBy("feature", "slot").agg(F.percentile_approx(
        "candidate.number", [i / quantiles.RANK_BUCKETS for i in range(1, quantiles.RANK_BUCKETS)], 200).alias("edges"))
    placed = quantiles.with_bucket(
        counts[0].join(edges, ["feature", "slot"]), F.col("candidate.number"), quantiles.RANK_BUCKETS)
    largest = placed.groupBy("feature", "slot", "bucket").count().agg({"count": "max"}).first()[0]
    assert candidates > 1_000 and largest < candidates / 50
