"""One append-only table for metric, drift, health and retrain records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def as_metrics(df: DataFrame, kind: str, run_id: str, entity: Column | None = None,
               recorded_at: Column | None = None) -> DataFrame:
    """Long-form records ``(kind, run_id, recorded_at, entity, metric, value, detail)``.

    Numeric columns become one record each; the whole row is kept as JSON in
    ``detail``.
    """
    numeric = [n for n, t in df.dtypes if t in ("int", "bigint", "float", "double")]
    records = F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in numeric
    ])
    return df.select(
        F.lit(run_id).alias("run_id"),
        (recorded_at if recorded_at is not None else F.current_timestamp()).alias("recorded_at"),
        (entity if entity is not None else F.lit(None)).cast("string").alias("entity"),
        F.to_json(F.struct(*df.columns)).alias("detail"),
        F.inline(records),
        F.lit(kind).alias("kind"),
    )


def append_metrics(records: DataFrame, path: str) -> None:
    records.write.mode("append").partitionBy("kind").parquet(path)


def read_metrics(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if kind is None else df.filter(F.col("kind") == kind)
