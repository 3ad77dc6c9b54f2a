import re

import pytest
from pyspark.sql import functions as F

from loyaltide.plans.staging import scratch_path
from loyaltide.sources import digests

SCHEMA = "k long, v string, other double, part string"
BY = ["part"]


@pytest.fixture
def path(spark):
    return scratch_path(spark, "digested")


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


ROWS = [(i, f"v{i}", float(i), f"p{i % 5}") for i in range(200)] + [(900, None, None, None), (901, "x", None, None)]


def changed(spark, path, **more):
    found = digests.changed_between(spark, path, 1, 2, "k", "v", BY, **more)
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_equal_copies_differ_nowhere_whatever_their_order(spark, path):
    digests.write_copy(table(spark, ROWS), path, 1, "k", BY)
    digests.write_copy(table(spark, ROWS[::-1]).repartition(7), path, 2, "k", BY)
    assert digests.differing(spark, path, 1, 2, BY).isEmpty()
    assert changed(spark, path) == []


def test_changes_are_found_and_other_partitions_are_not_opened(spark, path, plan):
    after = [(k, "new" if k == 11 else v, o, p) for k, v, o, p in ROWS if k != 31] + [(1_000, "added", 1.0, "p1")]
    digests.write_copy(table(spark, ROWS), path, 1, "k", BY)
    digests.write_copy(table(spark, after), path, 2, "k", BY)
    spots = digests.differing(spark, path, 1, 2, BY)
    assert {r.part for r in spots.collect()} == {"p1"} and spots.count() == 3
    assert changed(spark, path) == [(11, "v11", "new")]
    assert changed(spark, path, added_and_removed=True) == [(1_000, None, "added"), (11, "v11", "new"), (31, "v31", None)]
    read = digests.rows_at(digests.read_copy(spark, path, 2), spots, ["k"], BY)
    opened = [f for f in re.findall(r"PartitionFilters: \[(.*?)\], ", plan(read)) if "part#" in f]
    assert opened and all(re.search(r"part#\d+ = p1", f) for f in opened)


def test_a_null_partition_and_a_null_that_moves(spark, path):
    """(null, x) and (x, null) are different rows, though the hash function passes over nulls."""
    before = [(1, "x", None, None), (2, "y", 1.0, "p")]
    digests.write_copy(table(spark, before), path, 1, "k", BY)
    digests.write_copy(table(spark, [(1, None, None, None), (2, "y", 1.0, "p")]), path, 2, "k", BY)
    assert changed(spark, path) == [(1, "x", None)]
    swapped = spark.createDataFrame([("x", None), (None, "x")], "a string, b string")
    hashes = swapped.select(digests.row_hash(["a", "b"], 1)).collect()
    assert hashes[0] != hashes[1]


def test_repeated_rows_count(spark, path):
    digests.write_copy(table(spark, ROWS), path, 1, "k", BY)
    digests.write_copy(table(spark, ROWS + ROWS[3:5]), path, 2, "k", BY)
    assert {r.part for r in digests.differing(spark, path, 1, 2, BY).collect()} == {"p3", "p4"}


def test_a_row_that_moves_to_another_partition(spark, path):
    moved = [(k, "moved" if k == 7 else v, o, "p0" if k == 7 else p) for k, v, o, p in ROWS]
    digests.write_copy(table(spark, ROWS), path, 1, "k", BY)
    digests.write_copy(table(spark, moved), path, 2, "k", BY)
    assert changed(spark, path) == [(7, "v7", "moved")]


def test_without_partitions_and_when_all_is_gone(spark, path):
    digests.write_copy(table(spark, ROWS), path, 1, "k")
    digests.write_copy(table(spark, ROWS[:50]), path, 2, "k")
    found = digests.changed_between(spark, path, 1, 2, "k", "v", added_and_removed=True)
    assert found.count() == len(ROWS) - 50
    many = digests.differing(spark, path, 1, 2)
    assert many.count() <= digests.RANGES and digests.digests(table(spark, []), "k").count() == 0


def test_sums_do_not_overflow(spark):
    df = spark.range(100_000).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    row = digests.digests(df, "k").first()
    one = df.select(digests.row_hash(["k", "v"], 1)).first()[0]
    assert row.rows == 100_000 and int(row.sum_1) == one * 100_000
