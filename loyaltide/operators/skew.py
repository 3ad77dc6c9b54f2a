"""Key skew: finding it, aggregating and joining in spite of it."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyaltide.functions.columns import as_list, quoted
from loyaltide.operators.profile import BROADCAST_LIMIT_MB
from loyaltide.plans.staging import stage

# Largest to mean rows per key from which a key counts as skewed or critical.
SKEWED = 3.0
CRITICAL = 5.0
BUCKETS = 10
PIECES = 8  # of a hot key, for each mean task that its rows would fill

# Rows brought to a task by key: they fit its memory, in a few groupings and sorted, whatever the session's number of partitions.
TASK_ROWS = 500_000


def _severity(ratio: Column) -> Column:
    return F.when(ratio >= CRITICAL, "critical").when(ratio >= SKEWED, "moderate").otherwise("none")


def _row_stats(rows: str = "rows") -> list[Column]:
    return [
        F.max(rows).alias("max_rows"),
        F.avg(rows).alias("avg_rows"),
        F.min(rows).alias("min_rows"),
        F.stddev(rows).alias("std_rows"),
        F.count(F.lit(1)).alias("num_keys"),
    ]


def key_skew(df: DataFrame, column: str, top_n: int = 10) -> DataFrame:
    """The heaviest keys, each with the skew figures of the whole column."""
    counted = df.groupBy(F.col(column).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    stats = counted.agg(F.struct(*_row_stats()).alias("stats")).scalar()
    ratio = F.col("stats.max_rows") / F.col("stats.avg_rows")
    return (
        counted.orderBy(F.col("rows").desc(), "key").limit(top_n)
        .withColumn("stats", stats)
        .select(
            F.lit(column).alias("column"), "key", "rows", "stats.*",
            ratio.alias("skew_ratio"), (ratio >= SKEWED).alias("is_skewed"), _severity(ratio).alias("severity"))
    )


def key_skew_multi(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Skew figures of several columns from one pass over the table, worst first."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "key")
    counted = long.groupBy("column", "key").agg(F.count(F.lit(1)).alias("rows"))
    ratio = F.col("max_rows") / F.col("avg_rows")
    return (
        counted.groupBy("column").agg(*_row_stats())
        .withColumn("skew_ratio", ratio)
        .withColumns({"is_skewed": F.col("skew_ratio") >= SKEWED, "severity": _severity(F.col("skew_ratio"))})
        .orderBy(F.col("skew_ratio").desc(), "column")
    )


def salt_of(row_key: Sequence[str], buckets: int) -> Column:
    """Bucket of a row from a hash of its own columns: the same again if a task is retried."""
    return F.pmod(F.xxhash64(*row_key), F.lit(buckets)).cast("int")


def add_salt(df: DataFrame, key: str, buckets: int = BUCKETS, row_key: Sequence[str] | None = None,
             salt_col: str = "_salt") -> DataFrame:
    """Adds the salt and ``<key>_salted``, the key with its salt appended."""
    salted = df.withColumn(salt_col, salt_of(row_key or df.columns, buckets))
    return salted.withColumn(
        f"{key}_salted", F.concat(F.col(key).cast("string"), F.lit("_"), F.col(salt_col).cast("string")))


def salted_aggregate(df: DataFrame, key: str, value: str, buckets: int = BUCKETS,
                     row_key: Sequence[str] | None = None) -> DataFrame:
    """Rows, sum, mean, min and max of a value per key, in two phases by (key, salt) and key."""
    partial = df.groupBy(key, salt_of(row_key or df.columns, buckets).alias("_salt")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(value).alias("filled"), F.sum(value).alias("sum"),
        F.min(value).alias("min"), F.max(value).alias("max"))
    return partial.groupBy(key).agg(
        F.sum("rows").alias("row_count"), F.sum("sum").alias("sum_value"),
        F.when(F.sum("filled") > 0, F.sum("sum") / F.sum("filled")).alias("avg_value"),
        F.min("min").alias("min_value"), F.max("max").alias("max_value"))


def hot_keys(df: DataFrame, key: str | Sequence[str], min_share: float = 0.001) -> DataFrame:
    """Keys that hold at least ``min_share`` of the rows, so ``1 / min_share`` keys at most, with ``_rows``.

    A mergeable summary of frequent items, of fixed size, names every key that
    may be one; only these are counted, and with map-side sums. Its bound: a key
    with more than 7 rows in as many as the summary has counters is never missed.
    """
    keys = as_list(key)
    tracked = 1 << math.ceil(math.log2(8 / min_share))
    hashed = F.xxhash64(*map(quoted, keys))
    named = df.select(hashed.alias("_hash")).agg(
        F.struct(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(_hash, {tracked // 2}, {tracked})").alias("top")).alias("s"))
    # A row of fixed size; its items are the candidates.
    found = stage(named.select("s.rows", F.col("s.top.item").alias("items")), "frequent-keys")
    candidates = found.select(F.explode("items").alias("_hash"))
    counted = df.select(*map(quoted, keys), hashed.alias("_hash")).join(F.broadcast(candidates), "_hash", "left_semi") \
        .groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.filter(F.col("_rows") >= F.lit(min_share) * found.agg(F.max("rows")).scalar())


def by_key(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The rows of a key brought together; ``rows`` is about how many there are.

    The session's number of partitions stays, and with it Spark's freedom to
    merge small ones, unless tasks would get more than ``TASK_ROWS`` rows.
    """
    conf = df.sparkSession.conf
    usual = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions")
    wanted = math.ceil(rows / TASK_ROWS)
    return df.repartition(wanted, quoted(key)) if wanted > int(usual) else df.repartition(quoted(key))


def per_key(df: DataFrame, key: str, combine: Callable[[DataFrame], DataFrame], hot: Sequence, rows: int) -> DataFrame:
    """``combine``, which groups by key, with the rows of a key brought together first, once for all its groupings.

    For keys of few rows: combining them before the shuffle would shrink
    nothing, and map tasks would fill memory with about a group a row, and spill.
    Rows of the ``hot`` keys are combined by all tasks, as Spark does it by itself.
    """
    if not hot:
        return combine(by_key(df, key, rows))
    known = [k for k in hot if k is not None]
    is_hot = F.coalesce(quoted(key).isin(known), F.lit(None in hot))
    return combine(by_key(df.filter(~is_hot), key, rows)).unionByName(combine(df.filter(is_hot)))


def salts_needed(rows: Column, all_rows: Column, partitions: int) -> Column:
    """Pieces for a key: each is an eighth of a mean task, so that a task's pieces seldom add up to much more."""
    return F.greatest(F.ceil(rows * F.lit(PIECES * partitions) / all_rows), F.lit(1)).cast("int")


def salted_join(large: DataFrame, small: DataFrame, key: str, how: str = "inner", buckets: int | None = None,
                row_key: Sequence[str] | None = None, min_share: float = 0.001) -> DataFrame:
    """Equi-join that spreads the hot keys of ``large``, each over as many tasks as its share of the rows needs.

    Only hot keys are salted, and only their rows of ``small`` are repeated per
    piece; all other rows move as in a plain join. The hot keys number at most
    ``1 / min_share``, which bounds what is broadcast, and their pieces at most
    that and eight times the shuffle partitions; ``buckets`` sets one number of
    pieces for all. A right or full join would repeat the unmatched rows of
    ``small``, so those are refused.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"salted_join supports inner and left, not {how}")
    known = large.filter(quoted(key).isNotNull())
    partitions = int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = stage(hot_keys(known, key, min_share), "hot-keys")
    all_rows = large.agg(F.count(F.lit(1))).scalar()
    pieces = F.lit(buckets) if buckets else salts_needed(F.col("_rows"), all_rows, partitions)
    hot = found.select(quoted(key), pieces.alias("_pieces"))

    def marked(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(hot), key, "left")

    # Null keys match nothing, so their rows may lie anywhere.
    spread = F.when(quoted(key).isNull(), PIECES * partitions).otherwise(F.coalesce("_pieces", F.lit(1)))
    salted = marked(large).withColumn("_salt", F.pmod(F.xxhash64(*(row_key or large.columns)), spread).cast("int"))
    repeated = marked(small).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)))
    return salted.drop("_pieces").join(repeated.drop("_pieces"), [key, "_salt"], how).drop("_salt")


def broadcast_join(df: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "left",
                   max_mb: float = BROADCAST_LIMIT_MB) -> DataFrame:
    """Join with a lookup that is broadcast if the optimizer's estimate of its size is below ``max_mb``.

    The estimate comes from file sizes and costs no job; beyond it the join is
    planned as any other, and may still turn into a broadcast at run time.
    """
    estimated = int(str(lookup._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.join(F.broadcast(lookup) if estimated < max_mb * 1e6 else lookup, on, how)
