import bisect
import random

import pytest
from pyspark.sql import functions as F

from loyaltide.operators import drift
from loyaltide.plans.pipelines import drift_cycle
from loyaltide.plans.staging import scratch_path
from loyaltide.sources.metrics import read_metrics


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def score(df):
    return df.first()[1]


def test_constant_column_does_not_drift(spark):
    assert score(drift.drift_psi(numbers(spark, 5.0, 5.0, 5.0), numbers(spark, 9.0, 1.0), ["x"])) == 0.0


def test_empty_bins_count_with_the_smallest_share(spark):
    reference = numbers(spark, *map(float, range(100)))
    assert score(drift.drift_psi(reference, numbers(spark, *[1e6] * 10), ["x"])) > 10
    assert score(drift.drift_psi(reference, reference, ["x"])) == 0.0


def test_nulls_weigh_on_the_shares_and_may_have_a_bin(spark):
    reference = numbers(spark, *map(float, range(100)))
    half_null = numbers(spark, *map(float, range(100)), *[None] * 100)
    without, with_bin = (score(drift.drift_psi(reference, half_null, ["x"], count_nulls=n)) for n in (False, True))
    assert without == pytest.approx(0.5 * 0.6931471805599453, abs=1e-5)
    assert with_bin > without


def test_nan_lies_above_all_numbers(spark):
    reference = numbers(spark, *map(float, range(100)))
    with_nan = numbers(spark, *map(float, range(90)), *[float("nan")] * 10)
    assert score(drift.drift_psi(reference, with_nan, ["x"])) == 0.0
    assert score(drift.drift_ks(reference, with_nan, ["x"])) == pytest.approx(0.1, abs=1e-6)


def test_all_null_and_empty_tables(spark):
    nothing, some = numbers(spark, None, None), numbers(spark, 1.0, 2.0, 3.0)
    assert score(drift.drift_psi(nothing, some, ["x"])) == 0.0
    assert score(drift.drift_psi(some.limit(0), some, ["x"])) == 0.0
    assert score(drift.drift_quantile_gap(nothing, some, ["x"])) == 0.0
    assert [r.ks for r in drift.drift_ks(nothing, some, ["x"]).collect()] == [None]


@pytest.mark.parametrize("buckets", [4, 64, 1024])
def test_ks_is_the_largest_gap_of_the_two_cdfs(spark, monkeypatch, buckets):
    monkeypatch.setattr(drift, "KS_BUCKETS", buckets)
    rng = random.Random(buckets)
    a = [round(rng.gauss(0, 1), 1) for _ in range(3000)] + [0.5] * 1500
    b = [round(rng.gauss(0.4, 1.5), 1) for _ in range(2000)]
    sa, sb = sorted(a), sorted(b)
    expected = max(abs(bisect.bisect_right(sa, v) / len(sa) - bisect.bisect_right(sb, v) / len(sb)) for v in a + b)
    for parts in (1, 6):
        found = score(drift.drift_ks(
            numbers(spark, *a).repartition(parts), numbers(spark, *b).repartition(parts), ["x"]))
        assert found == pytest.approx(expected, abs=1e-6)


def test_null_categories_match_each_other(spark):
    df = spark.createDataFrame([(None,), ("a",), (None,), ("b",)], "c string")
    assert score(drift.drift_categorical(df, df, ["c"])) == 0.0
    other = spark.createDataFrame([("a",), ("z",)], "c string")
    assert score(drift.drift_categorical(df, other, ["c"])) == 0.75


def test_label_drift_of_an_empty_side_is_null(spark):
    df = spark.createDataFrame([(1,), (0,), (None,), (1,)], "churn_label int")
    assert tuple(drift.drift_label(df, df).first()) == (0.5, 0.5, 0.0)
    assert drift.drift_label(df, df.limit(0)).first()["label_drift"] is None


def test_mean_shift_needs_a_reference_mean(spark):
    zero, five = numbers(spark, 0.0), numbers(spark, 5.0)
    assert drift.drift_mean_shift(zero, five, ["x"]).first()["drifted"] is False
    fallen = drift.drift_mean_shift(five, zero, ["x"]).first()
    assert (fallen["shift"], fallen["drifted"]) == (1.0, True)


def report(spark, drifted, features):
    return spark.createDataFrame([("DRIFT" if i < drifted else "SAFE",) for i in range(features)], "status string")


@pytest.mark.parametrize("drifted, features, shift, age, reason", [
    (3, 100, 0.9, 99, "drifted features"), (2, 10, 0.9, 99, "drift rate"), (1, 10, -0.05, 99, "label drift"),
    (1, 10, 0.01, 30, "model age"), (1, 10, 0.01, 29, "none"), (0, 0, None, None, "none")])
def test_first_reason_to_retrain_wins(spark, drifted, features, shift, age, reason):
    label = spark.createDataFrame([(shift,)], "label_drift double")
    trained = spark.range(1).select(F.lit("2024-01-01").cast("date").alias("recorded_at"))
    as_of = F.date_add(F.lit("2024-01-01").cast("date"), F.lit(age)) if age is not None else None
    verdict = drift.retrain_decision(
        report(spark, drifted, features), label, trained if age is not None else None, as_of).first()
    assert (verdict["reason"], verdict["retrain"]) == (reason, reason != "none")


def test_jobs_do_not_grow_with_the_bins(spark):
    reference, current = numbers(spark, *map(float, range(500))), numbers(spark, *map(float, range(250, 900)))

    def jobs(bins):
        group = f"psi-{bins}"
        spark.sparkContext.setJobGroup(group, group)
        drift.drift_psi(reference, current, ["x"], bins).collect()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(5) == jobs(20)


def test_hash_split_keeps_keys_together_and_all_rows(spark):
    df = spark.range(2000).withColumn("k", F.col("id") % 300)
    one, two = drift.hash_split(df, "k")
    assert one.count() + two.count() == 2000
    assert one.select("k").intersect(two.select("k")).isEmpty()


def test_report_covers_numbers_and_strings(spark):
    df = spark.createDataFrame([(1.0, "a", 1), (2.0, "b", 0)], "x double, c string, churn_label int")
    found = {r.feature: (r.method, r.status) for r in drift.drift_report(df, df).collect()}
    assert found == {"x": ("psi", "SAFE"), "c": ("cat", "SAFE")}


def test_report_needs_a_shared_column(spark):
    with pytest.raises(ValueError):
        drift.drift_report(spark.createDataFrame([(1.0,)], "a double"), spark.createDataFrame([(1.0,)], "b double"))


def test_cycle_records_what_it_decides(spark):
    path = scratch_path(spark, "cycle")
    reference = spark.range(1000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 2).alias("churn_label"))
    shifted = reference.withColumn("x", F.col("x") + 5000)
    trainings = []

    def train(rows):
        trainings.append(rows.count())
        return spark.createDataFrame([(0.8,)], "auc_roc double")

    calm = drift_cycle(reference, reference, train, metrics_path=path, run_id="calm").first()
    assert (calm["retrain"], trainings) == (False, [])
    alarmed = drift_cycle(reference, shifted, train, metrics_path=path, run_id="alarmed").first()
    assert (alarmed["reason"], alarmed["metrics"]["auc_roc"], trainings) == ("drift rate", 0.8, [1000])
    kinds = read_metrics(spark, path).select("run_id", "kind").distinct().collect()
    assert {tuple(k) for k in kinds} == {
        ("calm", "drift"), ("calm", "retrain"), ("alarmed", "drift"), ("alarmed", "retrain"), ("alarmed", "train")}
    # The recorded training is what the next decision takes the model's age from.
    aged = drift_cycle(reference, reference, train, trained=read_metrics(spark, path, "train"),
                       as_of=F.date_add(F.current_date(), 31)).first()
    assert aged["reason"] == "model age"


def test_ks_keeps_a_column_without_values(spark):
    one, other = spark.createDataFrame([(1.0, None)], "a double, b double"), spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert {r.feature: r.ks for r in drift.drift_ks(one, other, ["a", "b"]).collect()} == {"a": 0.0, "b": None}


def test_retrain_thresholds_are_arguments(spark):
    report = spark.createDataFrame([("a", "DRIFT"), ("b", "OK")], "feature string, status string")
    assert drift.retrain_decision(report, max_rate=0.4).first()["reason"] == "drift rate"
    assert not drift.retrain_decision(report, max_rate=0.6).first()["retrain"]
