"""Distinct counts that roll up: stored once at the finest level, united at any coarser one.

Ids are numbered densely, without one task for all: a hash deals them over
buckets, each bucket numbers its own from the total of the buckets before it. A
group's ids are then bits of bitmaps of 32,768 bits, one for each stretch of
numbers that the group touches. Groups are united by OR of their bitmaps, so a
month's customers come from its days' rows, and no row of the input is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loyaltide.functions.columns import quoted
from loyaltide.plans.staging import stage

NUMBER_BUCKETS = 1024


def numbered_ids(df: DataFrame, id_col: str, buckets: int = NUMBER_BUCKETS) -> DataFrame:
    """id and number, from 1 on without gaps, of every distinct id that is not null; the same at every run."""
    ids = df.select(quoted(id_col).alias("id")).filter("id IS NOT NULL").distinct()
    ids = stage(ids.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")), "distinct-ids")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One row per bucket.
    offsets = ids.groupBy("bucket").count().select("bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("bucket").orderBy("id")
    return ids.join(F.broadcast(offsets), "bucket").select(
        "id", (F.col("offset") + F.row_number().over(inside)).cast("bigint").alias("number"))


def distinct_bitmaps(df: DataFrame, by: Sequence[str], id_col: str, numbers: DataFrame) -> DataFrame:
    """The columns ``by``, stretch and bits: the ids of every group, to be stored. ``numbers`` comes from numbered_ids."""
    pairs = df.select(*map(quoted, by), quoted(id_col).alias("id")).join(numbers, "id")
    return pairs.groupBy(*map(quoted, by), F.bitmap_bucket_number("number").alias("stretch")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def united(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser groups: ``by`` are columns of ``bitmaps``, or derived from them."""
    return bitmaps.groupBy(*map(quoted, by), "stretch").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bitmaps: DataFrame, by: Sequence[str] = (), name: str = "distinct") -> DataFrame:
    """Number of distinct ids per group."""
    return united(bitmaps, by).groupBy(*map(quoted, by)).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name))
