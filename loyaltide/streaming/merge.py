"""A stream merged into a stored table: the newest row of every key, whatever is read twice or late.

Every micro-batch is one upsert. A batch that runs again after a failure changes
nothing: batches are entered into a ledger once they are stored, a batch that is
entered is passed over, and one that was stored but not entered merges the same
rows again. Rows older than the stored one of their key are left out, so a batch
may also come late or twice under another number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loyaltide.functions.columns import as_list, quoted
from loyaltide.plans.staging import stage
from loyaltide.sources import versions
from loyaltide.streaming.score import TRIGGER_INTERVAL, _triggered


def newest(rows: DataFrame, keys: Sequence[str], latest: Sequence[str]) -> DataFrame:
    """One row per key, the one with the greatest ``latest`` columns; combined in the map tasks. Null keys are left out."""
    known = rows.dropna(subset=list(keys))
    order = F.struct(*[quoted(c) for c in latest], F.struct(*[quoted(c) for c in rows.columns]).alias("__row"))
    found = known.groupBy(*map(quoted, keys)).agg(F.max(order).alias("__best"))
    return found.select(*[F.col("__best.__row")[c].alias(c) for c in rows.columns])


def merged_batches(spark: SparkSession, ledger: str) -> DataFrame:
    """The entered batches: stream, batch, rows."""
    if not versions.exists(spark, ledger):
        return spark.createDataFrame([], "stream string, batch bigint, rows bigint")
    return spark.read.schema("stream string, batch bigint, rows bigint").parquet(ledger)


def merge_batch(batch: DataFrame, batch_id: int, path: str, keys: str | Sequence[str], latest: str | Sequence[str],
                partition_by: Sequence[str] = (), stream: str = "stream") -> bool:
    """Merge one micro-batch into the table at ``path``; False if its number is in the ledger."""
    spark, keys, latest, ledger = batch.sparkSession, as_list(keys), as_list(latest), f"{path}_batches"
    entered = merged_batches(spark, ledger).filter((F.col("stream") == stream) & (F.col("batch") == batch_id))
    if not entered.isEmpty():
        return False
    updates = stage(newest(batch, keys, latest), "newest")
    rows = updates.count()
    if versions.exists(spark, path):
        stored = versions.read_table(spark, path).select(*map(quoted, keys), *[quoted(c).alias(f"__{c}") for c in latest])
        newer = F.struct(*[F.col(f"__{c}") for c in latest]) > F.struct(*map(quoted, latest))
        late = updates.join(stored, keys).filter(newer).select(*map(quoted, keys))
        updates = updates.join(late, keys, "left_anti").select(*map(quoted, updates.columns))
    versions.upsert(updates, path, keys, partition_by)
    spark.createDataFrame([(stream, batch_id, rows)], "stream string, batch bigint, rows bigint") \
        .coalesce(1).write.mode("append").parquet(ledger)
    return True


def start_merge(rows: DataFrame, path: str, checkpoint: str, keys: str | Sequence[str], latest: str | Sequence[str],
                partition_by: Sequence[str] = (), stream: str = "stream", interval: str = TRIGGER_INTERVAL,
                available_now: bool = False) -> StreamingQuery:
    """Merge a stream, batch by batch. ``stream`` names it in the ledger: one name for each checkpoint."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, path, keys, latest, partition_by, stream)

    writer = rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return _triggered(writer, available_now, interval).start()
