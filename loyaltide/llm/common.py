"""What several operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loyaltide.plans.staging import stage

ROW = "__row"  # a unique number for each row, added by numbered()


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables, by the path of its folder in whatever store that lies."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(quoted(name).cast("string"), F.lit(""))


def plain_columns(docs: DataFrame) -> tuple[DataFrame, Callable[[str], str]]:
    """``docs`` with columns c0, c1, ... and the new name of each, so that no name of an operator's own can clash."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), lambda name: f"c{docs.columns.index(name)}"


def unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def numbered(docs: DataFrame, label: str) -> DataFrame:
    """A stored copy of ``docs`` with a unique number per row.

    The number is fixed by being written, so a later pass that names rows by it
    stays right if tasks run again. Ids that are null or repeat do no harm then.
    ``docs`` must not have a column of that name; see ``plain_columns``.
    """
    return stage(docs.withColumn(ROW, F.monotonically_increasing_id()), label)


def without_rows(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """``rows`` of ``numbered`` whose number is not in ``dropped``, with the columns of the input."""
    return rows.join(dropped.select(ROW), ROW, "left_anti").drop(ROW)


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python 1,000 rows at a time, unless the session has a number of its own.

    Spark's default of 10,000 rows suits numbers; with whole texts it makes a
    batch, which both sides hold at once, ten times as large as need be.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "1000")


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
           added: tuple[str, str] | None = None, dropped: int = 0) -> DataFrame:
    """``mapInArrow`` with all columns, whatever they are called: inside, column i is ``c<i>``.

    ``added`` names a column behind the others, and the last ``dropped`` columns are not given back.
    """
    small_batches(df.sparkSession)
    names = df.columns[:len(df.columns) - dropped]
    kinds = [f"c{i} {kind}" for i, (_, kind) in enumerate(df.dtypes[:len(names)])]
    if added:
        kinds.append(f"c{len(df.columns)} {added[1]}")
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(run, ", ".join(kinds)).toDF(*names, *([added[0]] if added else []))


def joined_back(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` with the columns of their group; ``groups`` holds each key of ``rows`` once, nulls as a key too.

    Groups with 1/1024 of all rows or more, at most 1,024 of them, are
    broadcast and their rows stay where they are; only rows of smaller groups
    are shuffled. Both tables are read twice, so they should be stored.
    """
    groups = stage(groups.withColumnRenamed(key, "__group"), "groups")
    large = F.col(size) * 1024 >= groups.agg(F.sum(size)).scalar()
    hot = groups.where(large)
    same = rows[key].eqNullSafe(groups["__group"])
    common = rows.join(F.broadcast(hot), same)
    rest = rows.join(F.broadcast(hot.select("__group")), same, "left_anti").join(groups.where(~large), same)
    return common.unionByName(rest).drop("__group")
