"""CSV ingestion and Parquet reads and writes."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loyaltide.functions.columns import rows_where
from loyaltide.plans.staging import scratch_path
from loyaltide.sources import schemas
from loyaltide.sources.records import ingest_csv

MULTI_LINE = ("reviews",)  # tables whose texts customers wrote, line breaks included


def drop_null_keys(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def null_key_report(df: DataFrame, key: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        rows_where(F.col(key).isNull()).alias("null_keys"),
    ).select(F.lit(key).alias("key"), "rows", "null_keys")


def ingest_table(spark: SparkSession, source: str, schema: StructType, key: str | None = None,
                 multi_line: bool = False, path: str | None = None) -> DataFrame:
    """The intact rows of CSV files that have the key; rejected ones stay beside them under ``path``."""
    return ingest_csv(spark, source, schema, path or scratch_path(spark, "ingested"), key, multi_line).good


def ingest_orders(spark: SparkSession, folder: str, target: str | None = None) -> dict[str, DataFrame]:
    """The nine order tables, by name; stored under ``target`` if given."""
    return _ingest(spark, folder, schemas.ORDER_FILES, schemas.ORDER_TABLES, target)


def ingest_clicks(spark: SparkSession, folder: str, target: str | None = None) -> dict[str, DataFrame]:
    """The clickstream tables; the two item-property files become one table."""
    tables = _ingest(spark, folder, schemas.CLICK_FILES, schemas.CLICK_TABLES, target)
    parts = tables.pop("item_props_1"), tables.pop("item_props_2")
    return {**tables, "item_properties": union_parts(*parts)}


def _ingest(spark: SparkSession, folder: str, files: Mapping[str, str], declared: Mapping[str, StructType],
            target: str | None) -> dict[str, DataFrame]:
    return {
        name: ingest_table(spark, f"{folder}/{file}", declared[name], schemas.REQUIRED_KEYS.get(name),
                           name in MULTI_LINE, f"{target}/{name}" if target else None)
        for name, file in files.items()
    }


def union_parts(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of all parts, matched by column name whatever their column order."""
    for other in others:
        first = first.unionByName(other)
    return first


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode).option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_by_state(df: DataFrame, path: str, column: str = "customer_state") -> None:
    """Hive-partitioned write.

    Rows are first brought together by partition value, so that a value is not
    written as one small file per task. ``REBALANCE`` lets the runtime split a
    value that holds many rows over several tasks.
    """
    write_parquet(df.hint("rebalance", column), path, partition_by=[column])


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None,
                 partition_filter: Mapping[str, Any] | None = None, cache: bool = False) -> DataFrame:
    """Read Parquet; a scalar filter means equality, a list means membership.

    A filter on a partition column prunes folders before anything is read. Such
    columns are text, as their folders are named, unless ``schema`` says otherwise.
    """
    reader = spark.read.option("mergeSchema", False)
    with partition_values_as_written(spark):
        df = (reader.schema(schema) if schema else reader).parquet(path)
    for name, wanted in (partition_filter or {}).items():
        values = wanted if isinstance(wanted, (list, tuple, set)) else [wanted]
        df = df.filter(F.col(name).isin(*values))
    return df.cache() if cache else df


@contextmanager
def partition_values_as_written(spark: SparkSession) -> Iterator[None]:
    """While open, reads do not turn partition values into numbers or dates by what they look like."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read_states(spark: SparkSession, path: str, states: Sequence[str] | None = None,
                schema: StructType | None = None) -> DataFrame:
    return read_parquet(spark, path, schema, {"customer_state": list(states)} if states else None)


def partition_inventory(df: DataFrame, column: str) -> DataFrame:
    """Partition values with their number of rows."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
