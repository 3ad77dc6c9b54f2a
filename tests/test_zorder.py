import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from loyaltide.operators import zorder
from loyaltide.plans.staging import scratch_path
from loyaltide.sources import versions


def files_with(table, condition):
    """Files whose least and greatest values leave room for the condition, given as (column, value)."""
    column, value = condition
    ranges = table.groupBy("_metadata.file_path").agg(F.min(column).alias("low"), F.max(column).alias("high"))
    return ranges.filter((F.col("low") <= F.lit(value)) & (F.col("high") >= F.lit(value))).count()


def test_a_filter_on_either_column_skips_files(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(10_000), rng.randrange(10_000), f"n{i % 100:03d}") for i in range(20_000)]
    df = spark.createDataFrame(rows, "a int, b int, name string")
    curve, sort = (scratch_path(spark, n) for n in ("curve", "sort"))
    versions.write_table(df, curve)
    versions.z_order(spark, curve, ["a", "b"], files=64)
    zorder_files = versions.read_table(spark, curve)
    df.repartitionByRange(64, "a", "b").sortWithinPartitions("a", "b").write.parquet(sort)
    sorted_files = spark.read.parquet(sort)
    for column in ("a", "b"):
        assert max(files_with(zorder_files, (column, v)) for v in (500, 5_000, 9_300)) <= 24
    assert min(files_with(sorted_files, ("b", v)) for v in (500, 5_000, 9_300)) >= 60
    assert sorted(map(tuple, zorder_files.collect())) == sorted(rows)


def test_buckets_are_found_by_bisection(spark):
    edges = sorted(random.Random(2).sample(range(1_000), 15))
    df = spark.createDataFrame([(v,) for v in [*map(float, range(0, 1_000, 7)), *map(float, edges), None]], "v double")
    got = df.select("v", zorder.bucket(F.col("v"), list(map(float, edges)), 4).alias("n")).collect()
    assert all(r.n == (0 if r.v is None else sum(e <= r.v for e in edges)) for r in got)


def test_bits_are_interleaved(spark):
    df = spark.createDataFrame([(0b101, 0b011, 0b110)], "a int, b int, c int")
    place = zorder.curve_place([F.col(c) for c in "abc"], 3)
    assert df.select(place).first()[0] == 0b101_011_110


def test_any_kind_of_column_and_hot_values(spark):
    day = dt.datetime(2020, 1, 1)
    rows = [(None if i % 9 == 0 else "same" if i % 3 else f"é{i}", day + dt.timedelta(hours=i), i % 2 == 0,
             float("nan") if i % 5 == 0 else i / 3) for i in range(600)]
    df = spark.createDataFrame(rows, "`a.b` string, t timestamp_ntz, flag boolean, x double")
    ordered = zorder.z_ordered(df, ["a.b", "t", "flag", "x"], files=5)
    assert ordered.columns == df.columns and ordered.exceptAll(df).isEmpty() and ordered.count() == 600
    assert zorder.z_ordered(df.limit(0), ["t"], files=5).count() == 0
    with pytest.raises(ValueError, match="ordered by m"):
        zorder.z_ordered(df.withColumn("m", F.create_map("t", "x")), ["m"])
    with pytest.raises(ValueError, match="62 bits"):
        zorder.z_ordered(df, ["t"] * 9)


def test_text_is_placed_in_its_order(spark):
    words = ["", "a", "ab", "abc", "b", "zz", "é"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    places = [r[0] for r in df.select(zorder.place_on_line(df.schema["w"])).collect()]
    assert places == sorted(places) and len(set(places)) == len(words)
