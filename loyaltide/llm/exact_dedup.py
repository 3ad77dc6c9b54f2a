"""Exact duplicates, with frequent texts split off before the shuffle.

Rows are compared by the SHA-256 of their normalised text. A Misra-Gries
summary, merged over all tasks, names every digest that may be frequent. Their
true counts and winners are then computed exactly, with partial sums in the map
tasks; the winners, at most ``tracked`` rows, are broadcast, and rows of
frequent digests are settled where they are. Only the rest is shuffled.

Defined cases: null text counts as empty; an empty table gives no rows; of rows
that share text and id one stays; null ids lose against any other; extra
columns are ignored by ``duplicates`` and kept by ``without_duplicates``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyaltide.llm.common import ROW, numbered, plain_columns, quoted, text_of, without_rows
from loyaltide.plans.staging import stage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def settled(rows: DataFrame, tracked: int = 4096) -> DataFrame:
    """``rows`` (ROW, id, digest) with the winner of each digest: columns keep_id, keep_row, group_size.

    ``rows`` is read several times, so it should be stored. ``tracked`` bounds
    the summary and so what is broadcast: any digest with more than about
    ``rows / tracked`` rows is settled without a shuffle.
    """
    winner = (F.max(F.struct("id", ROW)).alias("best"), F.count(F.lit(1)).alias("group_size"))
    # Spark's frequent-items summary is a mergeable Misra-Gries table of `tracked` counters.
    frequent = rows.select(F.xxhash64("digest").alias("key")) \
        .agg(F.expr(f"approx_top_k(key, {tracked // 2}, {tracked})").alias("top")) \
        .select(F.explode("top.item").alias("key"))
    verified = rows.withColumn("key", F.xxhash64("digest")).join(F.broadcast(frequent), "key") \
        .groupBy("digest").agg(*winner)
    # The summary has at most tracked / 2 items, whatever the input: its verified winners are safe to broadcast.
    winners = stage(verified.where("group_size > 1"), "frequent")
    common = rows.join(F.broadcast(winners), "digest")
    rest = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    return common.unionByName(rest.join(rest.groupBy("digest").agg(*winner), "digest")) \
        .select(ROW, "id", "digest", F.col("best.id").alias("keep_id"), F.col(f"best.{ROW}").alias("keep_row"),
                "group_size")


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = 4096) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    digests = numbered(
        docs.select(quoted(id_col).alias("id"),
                    F.unhex(F.sha2(lower_ascii(text_of(text_col)), 256)).alias("digest")), "digests")
    return settled(digests, tracked).select(
        F.col("id").alias(id_col), "keep_id", "group_size", (F.col("keep_row") == F.col(ROW)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       tracked: int = 4096) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    plain, at = plain_columns(docs)
    rows = numbered(plain, "rows")
    digests = stage(
        rows.select(ROW, F.col(at(id_col)).alias("id"),
                    F.unhex(F.sha2(lower_ascii(text_of(at(text_col))), 256)).alias("digest")), "digests")
    lost = settled(digests, tracked).where(F.col("keep_row") != F.col(ROW))
    return without_rows(rows, lost).toDF(*docs.columns)
