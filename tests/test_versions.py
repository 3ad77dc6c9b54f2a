import datetime as dt

import pytest
from pyspark.sql import functions as F

from loyaltide.plans.staging import scratch_path
from loyaltide.sources import files, versions

SCHEMA = "customer_unique_id string, churn_label int, customer_state string"


@pytest.fixture
def path(spark):
    return scratch_path(spark, "versioned")


def customers(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


BY = ["customer_state"]


def test_upsert_keeps_null_keys_and_replaces_matches(spark, path, rows):
    versions.upsert(customers(spark, ("a", 0, "01"), ("b", 0, "1"), (None, 0, "01")), path, partition_by=BY)
    versions.upsert(customers(spark, ("a", 1, "Z"), ("c", 1, "1"), (None, 1, "Z")), path, partition_by=BY)
    now = versions.read_table(spark, path).select("customer_unique_id", "churn_label", "customer_state")
    assert rows(now) == [("a", 1, "Z"), ("b", 0, "1"), ("c", 1, "1"), (None, 0, "01"), (None, 1, "Z")]


def test_changes_leave_files_of_other_partitions_alone(spark, path, rows):
    def stored(state):
        return {f for f in versions.read_table(spark, path).inputFiles() if f"customer_state={state}/" in f}

    versions.write_table(customers(spark, ("a", 0, "X"), ("b", 0, "Y"), ("c", 0, "a b"), ("d", 0, None)), path,
                         partition_by=BY)
    kept, other = stored("Y"), stored("X")
    versions.upsert(customers(spark, ("a", 1, "Z")), path, partition_by=BY)
    versions.delete_customer(spark, path, "c", BY)
    versions.update_churn_label(spark, path, "d", 5, BY)
    assert stored("Y") == kept and other and not stored("X") and not stored("a%20b")
    now = versions.read_table(spark, path).select("customer_unique_id", "churn_label", "customer_state")
    assert rows(now) == [("a", 1, "Z"), ("b", 0, "Y"), ("d", 5, None)]
    with pytest.raises(ValueError):
        versions.update_where(spark, path, F.lit(True), {"customer_state": "Q"}, BY)


def test_unknown_update_columns_raise(spark, path):
    versions.write_table(customers(spark, ("a", 0, "X")), path)
    with pytest.raises(ValueError):
        versions.upsert(customers(spark, ("a", 1, "X")).withColumn("new", F.lit(1)), path)


def test_upsert_refuses_updates_that_share_a_key(spark, path):
    with pytest.raises(ValueError):
        versions.upsert(customers(spark, ("a", 0, "X"), ("a", 1, "X")), path)
    assert not versions.exists(spark, path)


def test_daily_predictions_replace_only_the_same_day(spark, path, rows):
    def made(day, probability):
        return spark.createDataFrame(
            [("a", dt.datetime(2024, 1, day, 12), probability, "LOW")],
            "customer_unique_id string, processed_at timestamp, churn_probability double, risk_tier string")

    for day, probability in ((1, 0.1), (2, 0.2), (2, 0.3)):
        versions.upsert_predictions(made(day, probability), path)
    now = versions.read_table(spark, path)
    assert rows(now.select("churn_probability")) == [(0.1,), (0.3,)]
    versions.delete_old_predictions(spark, path, 1, F.lit("2024-01-03").cast("date"))
    assert rows(versions.read_table(spark, path).select("churn_probability")) == [(0.3,)]


def test_delete_and_update_leave_rows_with_null_conditions(spark, path, rows):
    versions.write_table(customers(spark, ("a", 1, "X"), ("b", None, "X"), (None, 1, "X")), path)
    versions.delete_customer(spark, path, "a")
    assert versions.read_table(spark, path).count() == 2
    versions.update_churn_label(spark, path, "b", 0)
    assert rows(versions.read_table(spark, path)) == [("b", 0, "X"), (None, 1, "X")]
    assert dict(versions.read_table(spark, path).dtypes)["churn_label"] == "int"


def test_append_of_another_type_raises(spark, path):
    versions.write_table(spark.range(3), path)
    with pytest.raises(ValueError):
        versions.write_table(spark.range(3).select(F.col("id").cast("string")), path, "append")
    versions.write_table(spark.range(3).withColumn("new", F.lit(1)), path, "append")
    assert versions.read_table(spark, path, merge_schema=True).filter("new is null").count() == 3


def test_snapshots_are_read_by_number(spark, path, rows):
    versions.write_snapshot(spark.range(1), path, 20240101)
    versions.write_snapshot(spark.range(2), path, 20240201)
    versions.write_snapshot(spark.range(3), path, 20240201)
    assert [versions.read_snapshot(spark, path, at).count() for at in (20240101, 20240131, 20240201, None)] == [1, 1, 3, 3]
    assert versions.read_snapshot(spark, path, 20231231).count() == 0


def test_diff_counts_changes_to_and_from_null(spark, rows):
    before = customers(spark, ("a", 1, "X"), ("b", None, "X"), ("c", None, "X"), ("d", 1, "X"))
    after = customers(spark, ("a", 0, "X"), ("b", 1, "X"), ("c", None, "X"), ("e", 1, "X"))
    assert rows(versions.changed(before, after)) == [("a", 1, 0), ("b", None, 1)]
    everything = versions.changed(before, after, added_and_removed=True)
    assert rows(everything) == [("a", 1, 0), ("b", None, 1), ("d", 1, None), ("e", None, 1)]


def test_clustering_splits_a_hot_value_and_keeps_rows(spark):
    df = spark.range(6000).withColumn("k", F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id")))
    done = versions.clustered(df, ["k"])
    assert done.count() == 6000
    spread = done.filter("k = 0").select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread > 1 or done.rdd.getNumPartitions() == 1


def test_named_tables_and_migration(spark, path):
    source = scratch_path(spark, "plain")
    files.write_parquet(customers(spark, ("a", 1, "X")), source)
    assert [versions.migrate(spark, source, f"{path}/user_features", BY) for _ in range(2)] == [True, False]
    predictions = spark.range(2).withColumn("risk_tier", F.lit("LOW"))
    for _ in range(2):
        versions.write_named(predictions, path, "predictions")
    stats = versions.file_stats(versions.read_table(spark, f"{path}/predictions")).first()
    assert stats.rows == 4 and stats.bytes > 0


def test_a_partitioned_table_is_not_flattened(spark, path):
    versions.write_table(customers(spark, ("a", 0, "X"), ("b", 0, "Y")), path, partition_by=BY)
    for rewrite in (versions.compact, lambda s, p: versions.cluster_by(s, p, ["churn_label"]),
                    lambda s, p: versions.z_order(s, p, ["churn_label"])):
        with pytest.raises(ValueError, match="partitioned"):
            rewrite(spark, path)
    assert set(versions.read_table(spark, path).columns) >= set(BY)


def test_a_change_reads_only_the_touched_partitions(spark, path, plan, monkeypatch):
    versions.write_table(customers(spark, *[(f"c{i}", 0, f"S{i % 5}") for i in range(50)]), path, partition_by=BY)
    spots = spark.createDataFrame([("S1",), (None,)], "customer_state string")
    read = versions._matching(versions.read_table(spark, path), spots, BY)
    assert "PartitionFilters: [((customer_state" in plan(read) and "= S1) OR isnull(customer_state" in plan(read)
    assert {r.customer_state for r in read.collect()} == {"S1"}
    monkeypatch.setattr(versions, "LISTED", 1)  # too many to name: joined
    read = versions._matching(versions.read_table(spark, path), spots, BY)
    assert {r.customer_state for r in read.collect()} == {"S1"}


def test_a_failed_rewrite_says_where_the_rows_are(spark, path, monkeypatch):
    versions.write_table(customers(spark, ("a", 0, "X")), path)

    def broken(*args, **kwargs):
        raise OSError("disk full")

    monkeypatch.setattr(versions, "write_table", broken)
    with pytest.raises(RuntimeError, match="staged under .*changed-table"):
        versions.delete_customer(spark, path, "a")
