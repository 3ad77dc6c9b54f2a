import pytest
from pyspark.sql import functions as F

from loyaltide.operators import drift, sketches
from loyaltide.plans.staging import stage


def table(spark, n=20_000):
    return spark.range(n).select(
        (F.col("id") % 20).cast("int").alias("day"), F.randn(1).alias("x"),
        (F.randn(2) + F.when(F.col("id") % 20 >= 10, 0.4).otherwise(0.0)).alias("shifted"), F.lit(3.0).alias("same"),
        F.when(F.col("id") % 3 > 0, F.rand(3)).alias("holes"), F.lit(None).cast("double").alias("none"),
        F.lit(float("nan")).alias("nan"))


COLUMNS = ["x", "shifted", "same", "holes", "none", "nan"]


def test_index_from_sketches_is_near_the_exact_one(spark):
    df = stage(table(spark), "sketch-rows")
    stored = stage(sketches.day_sketches(df, F.col("day"), COLUMNS), "sketches")
    assert stored.count() == 20 * len(COLUMNS)
    got = {r.feature: r.psi for r in sketches.sketched_psi(stored, F.col("day") < 10, F.col("day") >= 10).collect()}
    exact = {r.feature: r.psi for r in drift.drift_psi(df.filter("day < 10"), df.filter("day >= 10"), COLUMNS[:5]).collect()}
    assert set(got) == set(COLUMNS) and got["shifted"] > 0.1 and got["same"] == got["none"] == got["nan"] == 0
    for name, value in exact.items():
        assert got[name] == pytest.approx(value, abs=0.005)


def test_a_report_reads_no_row_of_the_past(spark, plan):
    df = stage(table(spark, 2_000), "sketch-rows")
    stored = stage(sketches.day_sketches(df, F.col("day"), ["x"]), "sketches")
    text = plan(sketches.sketched_psi(stored, F.col("day") < 10, F.col("day") >= 10))
    assert "sketch-rows" not in text and "/sketches-" in text


def test_merged_ranks_are_within_the_bound(spark):
    df = spark.range(50_000).select((F.col("id") % 30).alias("day"), ((F.col("id") * 7919) % 50_000).cast("double").alias("x"))
    merged = sketches.merged(sketches.day_sketches(df, F.col("day"), ["x"], 512))
    points = F.array(*[F.lit(p / 20) for p in range(1, 20)])
    found = merged.select(F.kll_sketch_get_quantile_double("sketch", points)).first()[0]
    assert max(abs(v / 50_000 - p / 20) for v, p in zip(found, range(1, 20))) <= sketches.rank_error(512)


def test_days_add_up_in_any_order(spark):
    df = table(spark, 4_000)
    stored = sketches.day_sketches(df, F.col("day"), ["holes"])
    row = sketches.merged(stored).first()
    assert (row["rows"], row.filled) == (4_000, df.filter("holes IS NOT NULL").count())
    assert sketches.merged(stored.filter("day > 99")).count() == 0
