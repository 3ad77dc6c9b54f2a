import pytest

from loyaltide.plans.staging import scratch_path
from loyaltide.sources import versions
from loyaltide.streaming import merge

SCHEMA = "user string, at long, tier string"


@pytest.fixture
def path(spark):
    return scratch_path(spark, "merged")


def batch(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def stored(spark, path, rows):
    return rows(versions.read_table(spark, path).select("user", "at", "tier"))


def test_a_batch_that_runs_again_changes_nothing(spark, path, rows):
    first = batch(spark, ("a", 1, "X"), ("a", 3, "Y"), ("b", 1, "X"), (None, 9, "Z"))
    assert merge.merge_batch(first, 0, path, "user", "at")
    assert stored(spark, path, rows) == [("a", 3, "Y"), ("b", 1, "X")]
    assert merge.merge_batch(batch(spark, ("a", 5, "Z")), 1, path, "user", "at")
    assert not merge.merge_batch(first, 0, path, "user", "at")
    assert stored(spark, path, rows) == [("a", 5, "Z"), ("b", 1, "X")]
    ledger = merge.merged_batches(spark, f"{path}_batches")
    assert rows(ledger) == [("stream", 0, 2), ("stream", 1, 1)]


def test_a_batch_stored_but_not_entered_is_merged_again_to_the_same_end(spark, path, rows):
    merge.merge_batch(batch(spark, ("a", 1, "X"), ("b", 2, "X")), 0, path, "user", "at", stream="s")
    now = stored(spark, path, rows)
    assert merge.merge_batch(batch(spark, ("a", 1, "X"), ("b", 2, "X")), 0, path, "user", "at", stream="again")
    assert stored(spark, path, rows) == now


def test_late_rows_do_not_replace_newer_ones(spark, path, rows):
    merge.merge_batch(batch(spark, ("a", 10, "X")), 0, path, "user", "at")
    merge.merge_batch(batch(spark, ("a", 4, "late"), ("c", 4, "new")), 1, path, "user", "at")
    assert stored(spark, path, rows) == [("a", 10, "X"), ("c", 4, "new")]


def test_a_key_moves_between_partitions(spark, path, rows):
    merge.merge_batch(batch(spark, ("a", 1, "X"), ("b", 1, "Y")), 0, path, "user", "at", ["tier"])
    merge.merge_batch(batch(spark, ("a", 2, "Y")), 1, path, "user", "at", ["tier"])
    assert stored(spark, path, rows) == [("a", 2, "Y"), ("b", 1, "Y")]


def test_any_split_into_batches_ends_alike(spark, path, rows):
    events = [(f"u{i % 7}", (i * 37) % 101, f"t{i % 3}") for i in range(60)]
    whole = scratch_path(spark, "whole")
    merge.merge_batch(batch(spark, *events), 0, whole, "user", ["at", "tier"])
    for n, at in enumerate(range(0, 60, 20)):
        merge.merge_batch(batch(spark, *events[at:at + 20]), n, path, "user", ["at", "tier"])
    assert stored(spark, path, rows) == stored(spark, whole, rows)
