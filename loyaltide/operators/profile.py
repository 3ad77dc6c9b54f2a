"""Table profiles: schema conformance, nulls, summaries, distributions, correlations, sizes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from loyaltide.functions.columns import finite_double, numeric_columns, quoted, rows_where, safe_ratio
from loyaltide.functions.quantiles import column_quantiles

# Assumed row width, largest table worth broadcasting, wanted partition size.
ROW_BYTES = 100
BROADCAST_LIMIT_MB = 100
PARTITION_MB = 128
MB = 1024 * 1024

IMBALANCE_WARNING = 5
TOP_PAIRS = 20
WIDE = 32  # columns up to which every pair is an aggregate of its own


def schema_conformance(df: DataFrame, expected: StructType) -> DataFrame:
    """Per expected column: present, of the declared type, and rows whose value cannot be cast to it."""
    actual = {f.name: f.dataType for f in df.schema}
    failing = [
        rows_where(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name)
        if f.name in actual else F.lit(None).cast("bigint").alias(f.name)
        for f in expected
    ]
    facts = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("expected_type"),
            F.lit(actual[f.name].simpleString() if f.name in actual else None).alias("actual_type"),
            F.lit(f.name in actual).alias("present"),
            F.lit(actual.get(f.name) == f.dataType).alias("type_matches"),
            F.col(f.name).alias("failing_rows"),
        )
        for f in expected
    ]
    return df.agg(*failing).select(F.inline(F.array(*facts)))


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of rows, and of nulls per column as a struct."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.struct(*[rows_where(F.col(c).isNull()).alias(c) for c in df.columns]).alias("nulls"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Rows, nulls and null percentage of every column, in one pass."""
    counted = null_counts(df)
    per_column = [F.struct(F.lit(c).alias("column"), F.col("nulls")[c].alias("null_count")) for c in df.columns]
    return counted.select("rows", F.inline(F.array(*per_column))).select(
        "column", "rows", "null_count",
        safe_ratio(F.col("null_count") * 100.0, F.col("rows"), 0.0).alias("null_pct"),
    )


def table_sample(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by a key, each with the row count of the table."""
    size = df.agg(F.count(F.lit(1))).scalar()
    return df.orderBy(*order_by).limit(n).withColumn("table_rows", size)


def class_balance(df: DataFrame, label_col: str = "churn_label") -> DataFrame:
    """Rows and percentage per class, with the ratio of negatives to positives."""
    counted = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("count"))
    everything = Window.partitionBy()  # over one row per class
    negatives = F.sum(F.when(F.col(label_col) == 0, F.col("count"))).over(everything)
    positives = F.sum(F.when(F.col(label_col) == 1, F.col("count"))).over(everything)
    ratio = safe_ratio(negatives, positives)
    return counted.select(
        label_col, "count",
        F.round(F.col("count") * 100 / F.sum("count").over(everything), 2).alias("pct"),
        ratio.alias("neg_pos_ratio"),
        F.coalesce(ratio > IMBALANCE_WARNING, F.lit(False)).alias("imbalanced"),
    ).orderBy(label_col)


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None, accuracy: int | None = None) -> DataFrame:
    """Min, max, mean, deviation, quartiles and nulls per numeric column, one row each; NaN counts as null."""
    columns = list(columns or numeric_columns(df))
    values = df.select(*[finite_double(c) for c in columns])
    basics = values.agg(*[
        F.struct(
            F.min(quoted(c)).alias("min"), F.max(quoted(c)).alias("max"), F.avg(quoted(c)).alias("mean"),
            F.stddev(quoted(c)).alias("std"), rows_where(quoted(c).isNull()).alias("nulls"),
        ).alias(c) for c in columns
    ]).unpivot([], [quoted(c) for c in columns], "feature", "s")
    quartiles = column_quantiles(df, columns, [0.25, 0.5, 0.75], accuracy)
    # One row per column on both sides.
    return basics.join(F.broadcast(quartiles), "feature").select(
        "feature", "s.min", "s.max", "s.mean", "s.std",
        F.col("quantiles")[0].alias("p25"), F.col("quantiles")[1].alias("p50"), F.col("quantiles")[2].alias("p75"),
        "s.nulls",
    )


def categorical_distribution(df: DataFrame, column: str, top_n: int = 20) -> DataFrame:
    """The most frequent values with their share of all rows.

    The row total is a scalar subquery: a window over all values would bring
    every distinct value to one task.
    """
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    rows = df.agg(F.count(F.lit(1))).scalar()
    return (
        counted.withColumn("pct", F.round(F.col("count") * 100 / rows, 2))
        .orderBy(F.col("count").desc(), column).limit(top_n)
    )


def label_feature_means(df: DataFrame, label_col: str = "churn_label",
                        columns: Sequence[str] | None = None) -> DataFrame:
    columns = columns or numeric_columns(df, [label_col])
    return df.groupBy(label_col).agg(*[F.avg(quoted(c).cast("double")).alias(c) for c in columns]).orderBy(label_col)


def correlation_pairs(df: DataFrame, columns: Sequence[str], top_n: int | None = TOP_PAIRS) -> DataFrame:
    """Pearson correlation of column pairs, strongest first, over rows without nulls.

    All pairs are aggregated in one pass: as single aggregates up to ``WIDE``
    columns, whose plan grows with the pairs; beyond, as one matrix of vector
    products, which tasks add up in blocks of their rows. What reaches the
    driver then has a number for every pair of columns.
    """
    plain = [f"c{i}" for i in range(len(columns))]
    complete = df.select(*[finite_double(c) for c in columns]).toDF(*plain).dropna()
    if len(columns) > WIDE:
        return _wide_pairs(complete, list(columns), top_n)
    pairs = [(a, b) for a in range(len(columns)) for b in range(a + 1, len(columns))]
    # A constant column has no correlation; the function of that name divides by its zero deviation.
    measured = complete.agg(*[
        (F.covar_pop(plain[a], plain[b]) / F.nullif(F.stddev_pop(plain[a]) * F.stddev_pop(plain[b]), F.lit(0.0))).alias(f"p{i}")
        for i, (a, b) in enumerate(pairs)])
    table = measured.select(F.inline(F.array(*[
        F.struct(F.lit(columns[a]).alias("feature_a"), F.lit(columns[b]).alias("feature_b"), F.col(f"p{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ]))).orderBy(F.abs("corr").desc_nulls_last(), "feature_a", "feature_b")
    return table if top_n is None else table.limit(top_n)


def _wide_pairs(complete: DataFrame, columns: list[str], top_n: int | None) -> DataFrame:
    spark, schema = complete.sparkSession, "feature_a string, feature_b string, corr double"
    if complete.isEmpty():
        return spark.createDataFrame([], schema)
    matrix = correlation_matrix(complete, complete.columns).first()[0].toArray()
    a, b = np.triu_indices(len(columns), 1)
    corr = matrix[a, b]
    # Strongest first, those without a value last, then by name: as the pairs of a narrow table.
    names = np.array(columns)
    order = np.lexsort((names[b], names[a], -np.nan_to_num(np.abs(corr), nan=-1.0)))[:top_n]
    rows = [(columns[a[i]], columns[b[i]], None if np.isnan(corr[i]) else float(corr[i])) for i in order]
    return spark.createDataFrame(rows, schema).coalesce(1)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The full matrix as one vector-valued cell, for many columns (one pass over assembled vectors)."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="vector", handleInvalid="skip").transform(df)
    return Correlation.corr(vectors.select("vector"), "vector")


def class_weights(df: DataFrame, label_col: str = "churn_label") -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    everything = Window.partitionBy()  # over one row per class
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("rows")).select(
        label_col, "rows",
        (F.sum("rows").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("rows"))).alias("weight"),
    )


def sample_weights(df: DataFrame, weights: DataFrame, label_col: str = "churn_label") -> DataFrame:
    """Adds each row's class weight.

    The weights, one entry per class, reach the rows as a scalar map: no join, so
    a class that holds most rows moves nowhere.
    """
    lookup = weights.filter(F.col(label_col).isNotNull()).agg(
        F.map_from_entries(F.collect_list(F.struct(label_col, "weight")))).scalar()
    return df.withColumn("sample_weight", F.try_element_at(lookup, F.col(label_col)))


def confusion_matrix(df: DataFrame, label_col: str = "churn_label", prediction_col: str = "prediction") -> DataFrame:
    return df.groupBy(label_col, prediction_col).agg(F.count(F.lit(1)).alias("count")).orderBy(
        label_col, prediction_col)


def table_size_profile(df: DataFrame, table: str, row_bytes: float | None = ROW_BYTES) -> DataFrame:
    """Rows, size, whether a broadcast is advisable and how many partitions fit the size.

    ``row_bytes=None`` measures the rows themselves by the length of their JSON text.
    """
    size = (F.sum(F.length(F.to_json(F.struct(*df.columns)))) if row_bytes is None
            else F.count(F.lit(1)) * float(row_bytes))
    measured = df.agg(F.count(F.lit(1)).alias("rows"), (F.coalesce(size, F.lit(0.0)) / MB).alias("estimated_mb"))
    wanted = F.greatest(F.lit(1.0), F.ceil(F.col("estimated_mb") / PARTITION_MB).cast("double"))
    return measured.select(
        F.lit(table).alias("table_name"), "rows", "estimated_mb",
        (F.col("estimated_mb") < BROADCAST_LIMIT_MB).alias("broadcastable"),
        F.pow(F.lit(2.0), F.ceil(F.log2(wanted)).cast("double")).cast("bigint").alias("recommended_partitions"),
    )
