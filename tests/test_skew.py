import pytest
from pyspark.sql import functions as F

from loyaltide.operators import skew


def hot_table(spark, n=9000):
    """A third of the rows share one key; a few have none."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 500)
    return spark.range(n).withColumn("k", key)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, rows, how):
    large = hot_table(spark)
    small = spark.range(0, 500, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v")).union(
        spark.createDataFrame([(0, -1), (None, -2)], "k long, v long"))
    salted = skew.salted_join(large, small, "k", how)
    plain = large.join(small, "k", how)
    assert sorted(salted.columns) == sorted(plain.columns)
    assert rows(salted.select("id", "k", "v")) == rows(plain.select("id", "k", "v"))


def test_salted_join_refuses_outer_sides(spark):
    with pytest.raises(ValueError):
        skew.salted_join(spark.range(1), spark.range(1), "id", "full")


def test_hot_keys_are_few_and_the_heaviest(spark):
    assert [r.k for r in skew.hot_keys(hot_table(spark), "k", 0.1).collect()] == [0]
    assert skew.hot_keys(hot_table(spark), "k", 0.01).count() <= 100


def test_salt_spreads_a_hot_key_and_is_the_same_again(spark):
    salted = skew.add_salt(hot_table(spark), "k", 8, ["id"])
    loads = [r["count"] for r in salted.filter("k = 0").groupBy("k_salted").count().collect()]
    assert len(loads) == 8 and max(loads) < 2 * min(loads)
    again = skew.add_salt(hot_table(spark).repartition(5), "k", 8, ["id"])
    assert salted.exceptAll(again).isEmpty()


def test_salted_aggregate_with_nulls(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None)], "k string, v double")
    got = skew.salted_aggregate(df, "k", "v").select(
        "k", "row_count", "sum_value", "avg_value", "min_value", "max_value")
    assert rows(got) == [("a", 3, 4.0, 2.0, 1.0, 3.0), ("b", 1, None, None, None, None)]


def test_skew_report_severity(spark):
    even = skew.key_skew(spark.range(100).withColumn("k", F.col("id") % 10), "k").first()
    assert (even.skew_ratio, even.is_skewed, even.severity) == (1.0, False, "none")
    worst = skew.key_skew_multi(hot_table(spark), ["k", "id"]).collect()
    assert [(r["column"], r.severity) for r in worst] == [("k", "critical"), ("id", "none")]


def test_broadcast_only_below_the_limit(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        sides = spark.range(1000), spark.range(100)
        assert "BroadcastHashJoin" in plan(skew.broadcast_join(*sides, "id"))
        assert "SortMergeJoin" in plan(skew.broadcast_join(*sides, "id", max_mb=0.0001))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_keys_are_spread_in_a_left_join(spark):
    large = spark.range(30_000).selectExpr("id", "CASE WHEN id % 3 < 2 THEN NULL ELSE id % 50 END AS k")
    small = spark.range(50).selectExpr("id AS k", "id * 2 AS v")
    before = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew.salted_join(large, small, "k", "left", buckets=64, row_key=["id"])
        per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[1])
    assert sum(per_task) == 30_000 and max(per_task) < 2 * 30_000 / len(per_task)


def test_pieces_follow_a_keys_share(spark):
    """With keys of 30, 10 and 3 percent no task gets more than twice the mean."""
    n = 40_000
    key = F.when(F.col("id") % 100 < 30, 0).when(F.col("id") % 100 < 40, 1).when(F.col("id") % 100 < 43, 2).otherwise(F.col("id") + 10)
    large = spark.range(n).select("id", key.alias("k"))
    small = spark.createDataFrame([(i, f"v{i}") for i in range(3)], "k long, v string")
    counts = {r.k: r._rows for r in skew.hot_keys(large, "k", 0.01).collect()}
    assert counts == {0: 12_000, 1: 4_000, 2: 1_200}
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold",
                                             "spark.sql.adaptive.enabled")}
    for k, v in zip(before, ("16", "-1", "false")):
        spark.conf.set(k, v)
    try:
        joined = skew.salted_join(large, small, "k", "left", row_key=["id"], min_share=0.01)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        plain = large.join(small, "k", "left").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == n and max(sizes) <= 2 * n / 16 < plain


def test_no_count_of_all_keys_before_the_join(spark, plan):
    large = spark.range(1_000).select("id", (F.col("id") % 7).alias("k"))
    text = plan(skew.hot_keys(large, "k", 0.1)).split("== Physical Plan ==")[-1]
    shuffled = [line for line in text.splitlines() if "Exchange hashpartitioning(k" in line]
    assert len(shuffled) == 1 and "LeftSemi" in text  # of the named keys alone
