import random

from pyspark.sql import functions as F

from loyaltide.operators import rollups
from loyaltide.plans.staging import stage


def test_numbers_are_dense_and_stay_the_same(spark):
    ids = spark.createDataFrame([(f"u{i % 700}",) for i in range(2_000)] + [(None,)], "u string")
    first = {r.id: r.number for r in rollups.numbered_ids(ids, "u").collect()}
    assert sorted(first.values()) == list(range(1, 701))
    assert first == {r.id: r.number for r in rollups.numbered_ids(ids.repartition(13), "u", 1024).collect()}


def test_counts_at_every_level(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(6), rng.choice("XYZ"), rng.randrange(90_000) if i % 50 else None) for i in range(20_000)]
    df = spark.createDataFrame(rows, "day int, state string, user long")
    table = stage(rollups.distinct_bitmaps(df, ["day", "state"], "user", rollups.numbered_ids(df, "user")), "bitmaps")
    assert table.select("stretch").distinct().count() == 1  # numbers are dense, though ids are not
    for by in (["day", "state"], ["day"], ["state"], []):
        wanted = df.groupBy(*by).agg(F.count_distinct("user").alias("n")).collect()
        got = rollups.distinct_counts(table, by, "n").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, wanted))
    weeks = table.withColumn("half", F.col("day") >= 3)
    assert {r.half: r.n for r in rollups.distinct_counts(weeks, ["half"], "n").collect()} == {
        half: len({u for d, _, u in rows if (d >= 3) == half and u is not None}) for half in (False, True)}


def test_many_stretches_and_an_empty_table(spark):
    df = spark.range(100_000).select(F.col("id"), (F.col("id") % 2).alias("part"))
    table = rollups.distinct_bitmaps(df, ["part"], "id", rollups.numbered_ids(df, "id"))
    assert {r.part: r.n for r in rollups.distinct_counts(table, ["part"], "n").collect()} == {0: 50_000, 1: 50_000}
    assert rollups.distinct_counts(table, [], "n").first().n == 100_000
    none = rollups.distinct_bitmaps(df.limit(0), ["part"], "id", rollups.numbered_ids(df.limit(0), "id"))
    assert rollups.distinct_counts(none, [], "n").first().n == 0
