"""Kept copies with digests, so that two copies are compared by row only where they differ.

A digest is taken per partition and range of keys: the number of rows and two
sums of row hashes, which do not depend on the rows' order. It is computed when
the copy is written and stored beside it, as a small table. To compare two
copies, their digests are joined; rows are read only of partitions and ranges
whose digests differ.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loyaltide.functions.columns import as_list, quoted
from loyaltide.plans.staging import stage
from loyaltide.sources import versions

RANGES = 64  # ranges of keys in a partition
LISTED = 1_000  # partitions that are named in a filter; more are joined
FIGURES = ("rows", "sum_1", "sum_2")
WHOLE = "decimal(38,0)"


def row_hash(columns: Sequence[str], seed: int) -> Column:
    """A hash of all values in which a null is a value: by itself, the hash function passes over nulls."""
    values = [v for c in sorted(columns) for v in (quoted(c), quoted(c).isNull())]
    return F.xxhash64(F.lit(seed), *values)


def key_range(keys: Sequence[str], ranges: int = RANGES) -> Column:
    return F.pmod(F.xxhash64(*map(quoted, keys)), F.lit(ranges)).cast("int")


def digests(df: DataFrame, keys: str | Sequence[str], partition_by: Sequence[str] = (), ranges: int = RANGES) -> DataFrame:
    """Columns of the partition, key_range, rows, sum_1, sum_2; every row is combined in the map tasks."""
    kept = [quoted(c).cast("string").alias(c) for c in partition_by]
    rows = df.select(*kept, key_range(as_list(keys), ranges).alias("key_range"),
                     *[row_hash(df.columns, i).cast(WHOLE).alias(f"sum_{i}") for i in (1, 2)])
    return rows.groupBy(*partition_by, "key_range").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("sum_1").alias("sum_1"), F.sum("sum_2").alias("sum_2"))


def write_copy(df: DataFrame, path: str, number: int, keys: str | Sequence[str], partition_by: Sequence[str] = ()) -> None:
    """Keep the rows as copy ``number`` under ``path/rows``, and their digests under ``path/digests``.

    The digests are taken from what was written, and written last: a copy without them is not complete.
    """
    spark = df.sparkSession
    df.hint("rebalance", *partition_by).withColumn(versions.SNAPSHOT, F.lit(number)).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(versions.SNAPSHOT, *partition_by).parquet(f"{path}/rows")
    found = digests(read_copy(spark, path, number), keys, partition_by)
    versions.write_snapshot(found, f"{path}/digests", number)


def read_copy(spark: SparkSession, path: str, number: int) -> DataFrame:
    rows = versions.read_table(spark, f"{path}/rows")
    return rows.filter(F.col(versions.SNAPSHOT) == str(number)).drop(versions.SNAPSHOT)


def differing(spark: SparkSession, path: str, before: int, after: int, partition_by: Sequence[str] = ()) -> DataFrame:
    """Partitions and key ranges whose rows differ between two copies, from the digests alone."""
    stored = versions.read_table(spark, f"{path}/digests")
    sides = [stored.filter(F.col(versions.SNAPSHOT) == str(n)).drop(versions.SNAPSHOT) for n in (before, after)]
    spot = [*partition_by, "key_range"]
    a = sides[0].withColumnsRenamed({c: f"a_{c}" for c in sides[0].columns})
    same = reduce(Column.__and__, [F.col(f"a_{c}").eqNullSafe(quoted(c)) for c in spot])
    joined = a.join(sides[1], same, "full")
    unlike = ~reduce(Column.__and__, [F.col(f"a_{c}").eqNullSafe(quoted(c)) for c in FIGURES])
    # One of the two sides may lack the spot: its partition may be null, but its key range never is.
    there = F.col("a_key_range").isNotNull()
    return joined.filter(unlike).select(*[F.when(there, F.col(f"a_{c}")).otherwise(quoted(c)).alias(c) for c in spot])


def rows_at(rows: DataFrame, spots: DataFrame, keys: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """``rows`` of the partitions and key ranges in ``spots``; other partitions' files are not opened."""
    rows = rows.withColumn("__range", key_range(keys))
    named = spots.select(*partition_by).distinct().limit(LISTED + 1).collect() if partition_by else []
    if named and len(named) <= LISTED:
        for i, column in enumerate(partition_by):
            values = {r[i] for r in named}
            wanted = quoted(column).isin(*[v for v in values if v is not None])
            rows = rows.filter(wanted | quoted(column).isNull() if None in values else wanted)
    renamed = spots.withColumnsRenamed({c: f"__{c}" for c in spots.columns})
    same = reduce(Column.__and__, [quoted(c).eqNullSafe(F.col(f"__{c}")) for c in partition_by],
                  F.col("__range") == F.col("__key_range"))
    return rows.join(renamed, same, "left_semi").drop("__range")


def changed_between(spark: SparkSession, path: str, before: int, after: int, key: str, column: str,
                    partition_by: Sequence[str] = (), added_and_removed: bool = False) -> DataFrame:
    """What ``versions.changed`` finds between two kept copies, reading rows only where their digests differ.

    A row that moved to another partition makes both partitions differ, so it is found too.
    """
    spots = stage(differing(spark, path, before, after, partition_by), "differing")
    sides = [rows_at(read_copy(spark, path, n), spots, [key], partition_by) for n in (before, after)]
    return versions.changed(*sides, key=key, column=column, added_and_removed=added_and_removed)
