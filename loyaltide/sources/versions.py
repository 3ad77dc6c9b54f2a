"""Changes to stored tables: merges, deletes and updates as DataFrame operators, and writes of what they touch.

Tables are plain Parquet folders. A change to a partitioned table rewrites only
the partitions that hold rows it touches, the other files stay as they are; a
table without partitions is rewritten whole. One writer at a time is assumed.
Earlier states are kept only where a flow asks for it, as full copies under a
partition column ``snapshot``, and read with a filter on that column.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loyaltide.functions.columns import as_list, quoted
from loyaltide.operators.zorder import z_ordered
from loyaltide.plans.staging import remove_path, stage
from loyaltide.sources.files import partition_values_as_written

TARGET_FILE_BYTES = 128 * 1024 * 1024
SNAPSHOT = "snapshot"
LISTED = 1_000  # touched partitions that are named in a filter; more are joined

# Partition columns of the named tables, and their predictions' key.
TABLE_PARTITIONS = {
    "orders": ("order_status",),
    "customers": ("customer_state",),
    "order_wide": ("customer_state",),
    "transformed": ("customer_state",),
    "user_features": ("customer_state",),
    "predictions": ("risk_tier",),
}
FEATURE_KEY = ("customer_unique_id",)
PREDICTION_KEY = ("customer_unique_id", "prediction_date")
BAD_DELAY_DAYS = -30


# --- changed rows, as plain DataFrame operators -----------------------------

def merged(target: DataFrame, updates: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key is not updated, and all rows of ``updates``.

    A null key matches nothing, as in an SQL merge. Columns of the updates that
    the target lacks raise an error.
    """
    unknown = [c for c in updates.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"the target has no columns {unknown}")
    kept = target.join(updates.select(*as_list(keys)), as_list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(updates.select(*target.columns))


def without(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition does not hold; where it is null the row stays."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def updated(df: DataFrame, condition: Column, values: Mapping[str, Any]) -> DataFrame:
    types = dict(df.dtypes)

    def new_value(name: str, value: Any) -> Column:
        value = value if isinstance(value, Column) else F.lit(value)
        return F.when(condition, value.cast(types[name])).otherwise(F.col(name))

    return df.withColumns({name: new_value(name, value) for name, value in values.items()})


def with_prediction_date(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("prediction_date", F.to_date("processed_at"))


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ranged and sorted by the columns, so that a filter on them skips files.

    A hash of the row ends the range key: rows that share one value of the
    columns may then be split over several tasks.
    """
    return df.repartitionByRange(*columns, F.xxhash64(*df.columns)).sortWithinPartitions(*columns)


def changed(before: DataFrame, after: DataFrame, key: str = "customer_unique_id", column: str = "churn_label",
            names: Sequence[str] = ("before", "after"), added_and_removed: bool = False) -> DataFrame:
    """Keys whose column differs between two tables; a change from or to null counts.

    Rows present on only one side are left out unless asked for.
    """
    a, b = (f"{column}_{name}" for name in names)
    sides = [df.select(key, F.col(column).alias(name), F.lit(True).alias(f"_in_{name}"))
             for df, name in ((before, a), (after, b))]
    joined = sides[0].join(sides[1], key, "full" if added_and_removed else "inner")
    one_sided = F.col(f"_in_{a}").isNull() | F.col(f"_in_{b}").isNull()
    return joined.filter(one_sided | ~F.col(a).eqNullSafe(F.col(b))).select(key, a, b)


def _require_unique(updates: DataFrame, keys: Sequence[str]) -> None:
    known = updates.dropna(subset=list(keys))
    if not known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        raise ValueError(f"several rows to merge share one key {tuple(keys)}")


# --- reads and writes --------------------------------------------------------

def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """A stored table; partition values are text, and with ``merge_schema`` files may differ in columns."""
    with partition_values_as_written(spark):
        return spark.read.option("mergeSchema", merge_schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("parquet").schema("_ int").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Write or append; an append whose column has another type than in the table raises.

    An append may bring new columns, which ``read_table`` shows with ``merge_schema``. A partition's rows are brought together before the write, large ones split at run time.
    """
    if mode == "append" and exists(df.sparkSession, path):
        stored = dict(read_table(df.sparkSession, path, merge_schema=True).dtypes)
        other = [c for c, kind in df.dtypes if c not in partition_by and stored.get(c, kind) != kind]
        if other:
            raise ValueError(f"columns {other} have another type in {path}")
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    writer = rows.write.mode(mode).option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_named(df: DataFrame, root: str, name: str, mode: str | None = None) -> None:
    """Write one of the named tables under its own partition columns; predictions are appended."""
    write_table(df, f"{root}/{name}", mode or ("append" if name == "predictions" else "overwrite"),
                TABLE_PARTITIONS[name])


def migrate(spark: SparkSession, parquet_path: str, path: str, partition_by: Sequence[str] = ()) -> bool:
    """Start a partitioned table from plain Parquet; False if it is there already."""
    if exists(spark, path):
        return False
    write_table(spark.read.parquet(parquet_path), path, "error", partition_by)
    return True


def _pruned(rows: DataFrame, spots: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``rows``, reading only folders that may be among ``spots``: up to ``LISTED`` of them are named in the filter."""
    named = spots.limit(LISTED + 1).collect()
    if len(named) > LISTED:
        return rows
    for column in columns:
        values = {r[column] for r in named}
        wanted = quoted(column).isin(*[v for v in values if v is not None])
        rows = rows.filter(wanted | quoted(column).isNull() if None in values else wanted)
    return rows


def _matching(rows: DataFrame, spots: DataFrame, columns: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows whose partition is, or with ``left_anti`` is not, one of ``spots``; null matches null."""
    if how == "left_semi":
        rows = _pruned(rows, spots, columns)
    same = reduce(Column.__and__, [rows[c].eqNullSafe(spots[c]) for c in columns])
    return rows.join(spots, same, how)


@contextmanager
def _named_if_lost(rows: DataFrame, path: str) -> Iterator[None]:
    """While files at ``path`` are replaced, the staged rows may be the only copy: an error says where they are."""
    try:
        yield
    except Exception as error:
        folders = sorted({f.rsplit("/", 1)[0] for f in rows.inputFiles()})
        raise RuntimeError(f"{path} was left half written; its rows are staged under {folders}") from error


def _replace(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Overwrite a table without partitions by staged rows."""
    with _named_if_lost(rows, path):
        write_table(rows, path)


def _require_flat(spark: SparkSession, path: str) -> None:
    """Raise for a table with partitions, which a rewrite as one range of files would lose."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    inside = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    parts = [s.getPath().getName() for s in inside if s.isDirectory() and "=" in s.getPath().getName()]
    if parts:
        raise ValueError(f"{path} is partitioned ({parts[0]}, ...); rewrite its partitions one by one")


def rewrite(target: DataFrame, path: str, change: Callable[[DataFrame], DataFrame], touched: DataFrame,
            partition_by: Sequence[str] = ()) -> None:
    """Store ``change(rows)`` for the partitions that occur in ``touched``, and leave all other files alone.

    The new rows are staged first, since their folders are both read and
    overwritten. Folders that hold no rows any more are removed last.
    """
    spark = target.sparkSession
    if not partition_by:
        _replace(spark, path, stage(change(target), "changed-table"))
        return
    spots = stage(touched.select(*partition_by).distinct(), "touched-partitions")
    rows = stage(change(_matching(target, spots, partition_by)), "changed-partitions")
    with _named_if_lost(rows, path):
        rows.hint("rebalance", *partition_by).write.mode("overwrite").option("compression", "snappy") \
            .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    stored = read_table(spark, path).select(
        *partition_by, F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder"))
    emptied = _matching(_matching(stored, spots, partition_by), rows.select(*partition_by).distinct(),
                        partition_by, "left_anti")
    # At most one row per folder of the table.
    for row in emptied.select("folder").distinct().collect():
        remove_path(spark, spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row.folder)).toString())


def upsert(updates: DataFrame, path: str, keys: str | Sequence[str] = FEATURE_KEY,
           partition_by: Sequence[str] = ()) -> None:
    """Replace rows that share a key with an update and add the other updates.

    The updates are staged: they are needed several times, and must be the same
    rows each time.
    """
    spark, keys, updates = updates.sparkSession, as_list(keys), stage(updates, "updates")
    _require_unique(updates, keys)
    if not exists(spark, path):
        write_table(updates, path, partition_by=partition_by)
        return
    target = read_table(spark, path)
    types = dict(updates.dtypes)
    target = target.withColumns({c: F.col(c).cast(types[c]) for c in partition_by if c in types})
    touched = updates
    if partition_by:
        replaced = target.join(updates.select(*keys), keys, "left_semi")
        touched = replaced.select(*partition_by).unionByName(updates.select(*partition_by))
    rewrite(target, path, lambda rows: merged(rows, updates, keys), touched, partition_by)


def upsert_predictions(predictions: DataFrame, path: str) -> None:
    """One prediction per customer and day: a later one of the same day replaces it."""
    upsert(with_prediction_date(predictions), path, PREDICTION_KEY, TABLE_PARTITIONS["predictions"])


def delete_where(spark: SparkSession, path: str, condition: Column, partition_by: Sequence[str] = ()) -> None:
    target = read_table(spark, path)
    rewrite(target, path, lambda rows: without(rows, condition), target.filter(condition), partition_by)


def delete_customer(spark: SparkSession, path: str, customer: Any, partition_by: Sequence[str] = ()) -> None:
    delete_where(spark, path, F.col("customer_unique_id") == customer, partition_by)


def delete_old_predictions(spark: SparkSession, path: str, days: int = 30, today: Column | None = None,
                           partition_by: Sequence[str] = ()) -> None:
    today = today if today is not None else F.current_date()
    delete_where(spark, path, F.col("processed_at") < F.date_sub(today, days), partition_by)


def update_where(spark: SparkSession, path: str, condition: Column, values: Mapping[str, Any],
                 partition_by: Sequence[str] = ()) -> None:
    """Set columns where the condition holds; partition columns cannot be set."""
    moved = [c for c in partition_by if c in values]
    if moved:
        raise ValueError(f"partition columns {moved} cannot be updated; upsert the rows")
    target = read_table(spark, path)
    rewrite(target, path, lambda rows: updated(rows, condition, values), target.filter(condition), partition_by)


def update_churn_label(spark: SparkSession, path: str, customer: Any, label: int,
                       partition_by: Sequence[str] = ()) -> None:
    update_where(spark, path, F.col("customer_unique_id") == customer, {"churn_label": label}, partition_by)


def correct_bad_delays(spark: SparkSession, path: str, column: str = "delivery_delay_days",
                       partition_by: Sequence[str] = ()) -> None:
    """Delays of more than a month before the estimate are taken as errors and become 0."""
    update_where(spark, path, F.col(column) < BAD_DELAY_DAYS, {column: 0}, partition_by)


# --- kept copies and files ---------------------------------------------------

def write_snapshot(df: DataFrame, path: str, number: int) -> None:
    """Keep the rows as copy ``number``, which may be a date such as 20240131; written again, it is replaced."""
    df.withColumn(SNAPSHOT, F.lit(number)).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(SNAPSHOT).parquet(path)


def read_snapshot(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """The newest copy, or the newest numbered ``as_of`` or less; columns of other copies only are null."""
    copies = read_table(spark, path, merge_schema=True).withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("long"))
    if as_of is not None:
        copies = copies.filter(F.col(SNAPSHOT) <= as_of)
    newest = copies.agg(F.max(SNAPSHOT)).scalar()
    return copies.filter(F.col(SNAPSHOT) == newest).drop(SNAPSHOT)


def file_stats(table: DataFrame) -> DataFrame:
    """Files, bytes and rows of a table as read from Parquet."""
    files = table.groupBy("_metadata.file_path").agg(
        F.max("_metadata.file_size").alias("file_size"), F.count(F.lit(1)).alias("file_rows"))
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("file_rows"), F.lit(0)).alias("rows"))


def compact(spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES) -> None:
    """Rewrite a table without partitions into files of about the target size; the rows stay the same."""
    _require_flat(spark, path)
    table = read_table(spark, path)
    size = file_stats(table).first()["bytes"]
    rows = stage(table, "compacted")
    with _named_if_lost(rows, path):
        write_table(rows.repartition(max(1, -(-size // target_bytes))), path)


def cluster_by(spark: SparkSession, path: str, columns: Sequence[str]) -> None:
    """Rewrite a table without partitions ranged and sorted by the columns."""
    _require_flat(spark, path)
    rows = stage(read_table(spark, path), "unclustered")
    with _named_if_lost(rows, path):
        write_table(clustered(rows, columns), path)


def z_order(spark: SparkSession, path: str, columns: Sequence[str], files: int | None = None) -> None:
    """Rewrite a table without partitions along a curve through all of the columns, so that a filter on any skips files."""
    _require_flat(spark, path)
    rows = stage(read_table(spark, path), "unordered")
    with _named_if_lost(rows, path):
        write_table(z_ordered(rows, columns, files), path)
