"""Stored tables: writes, kept copies, merges, deletes, updates and rewrites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.queries_base import rnd, when
from bindings.registry import query
from bindings.tables import Tables
from loyaltide.plans.staging import scratch_path
from loyaltide.sources import digests, files, versions
from loyaltide.streaming import merge

CUT = "2000-01-01"
ORDER_COLUMNS = f"o_orderkey, o_custkey, o_orderstatus, {rnd('o_totalprice')}, {when('o_orderdate')}, o_orderpriority"


def _before(t: Tables) -> DataFrame:
    return t.raw("orders").filter(F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz"))


def _since(t: Tables) -> DataFrame:
    return t.raw("orders").filter(F.col("o_orderdate") >= F.lit(CUT).cast("timestamp_ntz"))


def _table(t: Tables, name: str) -> str:
    return scratch_path(t.spark, name)


def _customers(df: DataFrame) -> DataFrame:
    """A small feature store made of orders: one row per customer, labelled by the last order's status."""
    return df.groupBy(F.col("o_custkey").alias("customer_unique_id")).agg(
        F.count(F.lit(1)).alias("frequency"), F.round(F.sum("o_totalprice"), 2).alias("monetary"),
        F.max(F.when(F.col("o_orderstatus") == "F", 1)).alias("churn_label"))


CUSTOMERS = {
    name: f"""
SELECT o_custkey AS customer_unique_id, count(*) AS frequency, round(sum(o_totalprice), 2) AS monetary,
       max(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS churn_label
FROM orders WHERE {test} GROUP BY 1""" for name, test in (
        ("v_old", f"o_orderdate < TIMESTAMP '{CUT}'"), ("v_new", f"o_orderdate >= TIMESTAMP '{CUT}'"))
}
CUSTOMERS["v_upserted"] = """
SELECT * FROM v_old WHERE customer_unique_id NOT IN (SELECT customer_unique_id FROM v_new)
UNION ALL SELECT * FROM v_new"""


@query(f"SELECT {ORDER_COLUMNS} FROM orders")
def version_write(t: Tables) -> DataFrame:
    """Overwrite with the older orders, then append the newer ones."""
    path = _table(t, "orders")
    versions.write_table(_before(t), path, partition_by=["o_orderstatus"])
    versions.write_table(_since(t), path, "append", ["o_orderstatus"])
    return versions.read_table(t.spark, path).select(*t.raw("orders").columns)


@query("""
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN o_orderpriority END AS o_orderpriority
FROM orders""")
def version_schema_merge(t: Tables) -> DataFrame:
    """The append brings a column that older rows do not have."""
    path = _table(t, "orders-evolving")
    versions.write_table(_before(t).select("o_orderkey"), path)
    versions.write_table(_since(t).select("o_orderkey", "o_orderpriority"), path, "append")
    return versions.read_table(t.spark, path, merge_schema=True)


@query("""
SELECT 'version 0' AS read, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
WHERE o_orderdate < TIMESTAMP '2000-01-01'
UNION ALL SELECT 'at first commit', count(*), round(sum(o_totalprice), 2) FROM orders
WHERE o_orderdate < TIMESTAMP '2000-01-01'
UNION ALL SELECT 'version 1', count(*), round(sum(o_totalprice), 2) FROM orders
UNION ALL SELECT 'current', count(*), round(sum(o_totalprice), 2) FROM orders
WHERE o_orderdate >= TIMESTAMP '2000-01-01'""", digits=2)
def time_travel(t: Tables) -> DataFrame:
    path = _table(t, "orders-copies")
    versions.write_snapshot(_before(t), path, 10)
    versions.write_snapshot(t.raw("orders"), path, 20)
    versions.write_snapshot(_since(t), path, 30)
    reads = {
        "version 0": versions.read_snapshot(t.spark, path, 10),
        "at first commit": versions.read_snapshot(t.spark, path, 19),
        "version 1": versions.read_snapshot(t.spark, path, 20),
        "current": versions.read_snapshot(t.spark, path),
    }
    return files.union_parts(*[
        df.agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total")).withColumn("read", F.lit(name))
        for name, df in reads.items()])


@query("""
SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal, 6) AS s_acctbal, true AS first_time, false AS second_time
FROM supplier""")
def migrate_table(t: Tables) -> DataFrame:
    path = _table(t, "supplier")
    source = f"{t.folder}/supplier.parquet"
    first = versions.migrate(t.spark, source, path, ["s_nationkey"])
    second = versions.migrate(t.spark, source, path, ["s_nationkey"])
    return versions.read_table(t.spark, path).withColumn("s_nationkey", F.col("s_nationkey").cast("int")).withColumns({
        "first_time": F.lit(first), "second_time": F.lit(second)})


@query("SELECT customer_unique_id, frequency, round(monetary, 2) AS monetary, churn_label FROM v_upserted", digits=2,
       views=CUSTOMERS)
def upsert(t: Tables) -> DataFrame:
    path = _table(t, "user-features")
    versions.upsert(_customers(_before(t)), path)
    versions.upsert(_customers(_since(t)), path)
    return versions.read_table(t.spark, path)


DAILY = """
SELECT user_id AS customer_unique_id, CAST(ts AS DATE) AS prediction_date, max(ts) AS processed_at,
       max(value) AS churn_probability, 'LOW' AS risk_tier
FROM events WHERE event_type = '{}' GROUP BY 1, 2"""


@query("""
SELECT customer_unique_id, CAST(prediction_date AS VARCHAR) AS prediction_date,
       round(churn_probability, 6) AS churn_probability, risk_tier,
       strftime(processed_at, '%Y-%m-%d %H:%M:%S') AS processed_at
FROM (SELECT * FROM v_views WHERE (customer_unique_id, prediction_date) NOT IN
        (SELECT (customer_unique_id, prediction_date) FROM v_clicks)
      UNION ALL SELECT * FROM v_clicks)""",
       views={"v_views": DAILY.format("view"), "v_clicks": DAILY.format("click")})
def upsert_daily(t: Tables) -> DataFrame:
    """Predictions made on clicks replace those made on views of the same customer and day."""
    path = _table(t, "predictions")
    for kind in ("view", "click"):
        day = F.to_date("ts")
        made = t.raw("events").filter(F.col("event_type") == kind).groupBy(
            F.col("user_id").alias("customer_unique_id"), day.alias("day")
        ).agg(F.max("ts").alias("processed_at"), F.max("value").alias("churn_probability")).drop("day")
        versions.upsert_predictions(made.withColumn("risk_tier", F.lit("LOW")), path)
    return versions.read_table(t.spark, path)


@query("""
SELECT customer_unique_id, frequency, round(monetary, 2) AS monetary, churn_label FROM v_old
WHERE NOT coalesce(churn_label = 1, false)""", digits=2, views=CUSTOMERS)
def delete_where(t: Tables) -> DataFrame:
    """Customers with a null label stay: the condition does not hold for them."""
    path = _table(t, "user-features")
    versions.write_table(_customers(_before(t)), path)
    versions.delete_where(t.spark, path, F.col("churn_label") == 1)
    return versions.read_table(t.spark, path)


@query(f"""
SELECT event_id AS prediction, {when('ts')} FROM events WHERE ts >= TIMESTAMP '2024-01-16'""".replace(
    "AS ts", "AS processed_at"))
def retention_delete(t: Tables) -> DataFrame:
    path = _table(t, "predictions")
    versions.write_table(
        t.raw("events").select(F.col("event_id").alias("prediction"), F.col("ts").alias("processed_at")), path)
    versions.delete_old_predictions(t.spark, path, 15, F.lit("2024-01-31").cast("date"))
    return versions.read_table(t.spark, path)


@query("""
SELECT customer_unique_id, frequency, round(monetary, 2) AS monetary,
       CASE WHEN customer_unique_id = 7 THEN 0 ELSE churn_label END AS churn_label FROM v_old""", digits=2,
       views=CUSTOMERS)
def update_where(t: Tables) -> DataFrame:
    path = _table(t, "user-features")
    versions.write_table(_customers(_before(t)), path)
    versions.update_churn_label(t.spark, path, 7, 0)
    return versions.read_table(t.spark, path)


@query("""
SELECT order_id, CASE WHEN d < -30 THEN 0 ELSE d END AS delivery_delay_days
FROM (SELECT order_id, delivery_delay_days AS d FROM v_transformed)""")
def update_bulk(t: Tables) -> DataFrame:
    path = _table(t, "transformed")
    by = versions.TABLE_PARTITIONS["transformed"]
    versions.write_table(t.transformed, path, partition_by=by)
    versions.correct_bad_delays(t.spark, path, partition_by=by)
    return versions.read_table(t.spark, path).select("order_id", "delivery_delay_days")


def _changed_twice(t: Tables) -> str:
    """Copy 0 is the older state, copy 1 the state after the merge."""
    path, before = _table(t, "user-features"), _customers(_before(t))
    versions.write_snapshot(before, path, 0)
    versions.write_snapshot(versions.merged(before, _customers(_since(t)), "customer_unique_id"), path, 1)
    return path


@query("""
SELECT '0' AS snapshot, count(*) AS rows FROM v_old UNION ALL SELECT '1', count(*) FROM v_upserted
UNION ALL SELECT '2', count(*) FROM v_new""", views=CUSTOMERS)
def version_history(t: Tables) -> DataFrame:
    """The kept copies with their rows."""
    path = _changed_twice(t)
    versions.write_snapshot(_customers(_since(t)), path, 2)
    return files.partition_inventory(versions.read_table(t.spark, path), "snapshot")


@query("SELECT customer_unique_id, frequency, round(monetary, 2) AS monetary, churn_label FROM v_old", digits=2,
       views=CUSTOMERS)
def version_rollback(t: Tables) -> DataFrame:
    """The rows of an earlier copy become the newest one."""
    path = _changed_twice(t)
    versions.write_snapshot(versions.read_snapshot(t.spark, path, 0), path, 2)
    return versions.read_snapshot(t.spark, path)


def _two_states(t: Tables) -> tuple[DataFrame, DataFrame]:
    path = _changed_twice(t)
    return versions.read_snapshot(t.spark, path, 0), versions.read_snapshot(t.spark, path, 1)


@query("""
SELECT a.customer_unique_id, a.churn_label AS churn_label_v0, b.churn_label AS churn_label_v1
FROM v_old a JOIN v_upserted b ON a.customer_unique_id = b.customer_unique_id
WHERE a.churn_label IS DISTINCT FROM b.churn_label""", views=CUSTOMERS)
def version_diff(t: Tables) -> DataFrame:
    return versions.changed(*_two_states(t), names=("v0", "v1"))


@query("""
SELECT coalesce(a.customer_unique_id, b.customer_unique_id) AS customer_unique_id, a.frequency AS frequency_v0,
       b.frequency AS frequency_v1
FROM v_old a FULL JOIN v_upserted b ON a.customer_unique_id = b.customer_unique_id
WHERE a.frequency IS DISTINCT FROM b.frequency OR a.customer_unique_id IS NULL OR b.customer_unique_id IS NULL""",
       views=CUSTOMERS)
def version_diff_all(t: Tables) -> DataFrame:
    return versions.changed(*_two_states(t), column="frequency", names=("v0", "v1"), added_and_removed=True)


def _many_files(t: Tables) -> str:
    path = _table(t, "orders-small-files")
    versions.write_table(t.raw("orders").repartition(16), path)
    return path


@query(f"SELECT {ORDER_COLUMNS}, CAST(16 AS BIGINT) AS files_before, CAST(1 AS BIGINT) AS files_after FROM orders")
def compact(t: Tables) -> DataFrame:
    path = _many_files(t)
    before = versions.file_stats(versions.read_table(t.spark, path)).first()["files"]
    versions.compact(t.spark, path)
    after = versions.file_stats(versions.read_table(t.spark, path)).first()["files"]
    return versions.read_table(t.spark, path).withColumns({
        "files_before": F.lit(before).cast("bigint"), "files_after": F.lit(after).cast("bigint")})


@query(f"SELECT {ORDER_COLUMNS} FROM orders")
def cluster_by(t: Tables) -> DataFrame:
    path = _many_files(t)
    versions.cluster_by(t.spark, path, ["o_orderstatus", "o_orderdate"])
    return versions.read_table(t.spark, path)


@query(f"SELECT {ORDER_COLUMNS} FROM orders")
def zorder(t: Tables) -> DataFrame:
    """The orders along a curve through customer, date and price."""
    path = _many_files(t)
    versions.z_order(t.spark, path, ["o_custkey", "o_orderdate", "o_totalprice"], files=16)
    return versions.read_table(t.spark, path)


CORRECTED = "o_orderstatus = 'P' AND o_orderkey % 7 = 0"


@query(f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS o_orderpriority_before,
       CASE WHEN {CORRECTED} THEN 'CORRECTED' ELSE o_orderpriority END AS o_orderpriority_after
FROM orders WHERE ({CORRECTED}) OR (o_orderstatus = 'P' AND o_orderkey % 11 = 0)""")
def version_diff_digest(t: Tables) -> DataFrame:
    """Orders of one state are corrected and some added; copies are compared by digests of state and key range."""
    path, by = _table(t, "digested"), ["o_orderstatus"]
    orders = t.raw("orders")
    pending = F.col("o_orderstatus") == "P"
    digests.write_copy(orders.filter(~pending | (F.col("o_orderkey") % 11 != 0)), path, 1, "o_orderkey", by)
    digests.write_copy(versions.updated(orders, F.expr(CORRECTED), {"o_orderpriority": "CORRECTED"}), path, 2, "o_orderkey", by)
    return digests.changed_between(t.spark, path, 1, 2, "o_orderkey", "o_orderpriority", by, added_and_removed=True)


@query("""
SELECT user_id, event_id, event_type, round(value, 6) AS value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def stream_upsert(t: Tables) -> DataFrame:
    """The last event of every user: events land in four parts, are merged as a stream, and the first batch once more."""
    landing, table, checkpoint = (_table(t, n) for n in ("landing", "last-events", "checkpoint"))
    events = t.raw("events").select("user_id", "event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    events.repartition(4, "event_id").write.parquet(landing)
    stream = t.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    merge.start_merge(stream, table, checkpoint, "user_id", ["ts", "event_id"], available_now=True).awaitTermination()
    again = t.spark.read.parquet(landing).filter(F.pmod("event_id", F.lit(4)) == 0)
    if merge.merge_batch(again, 0, table, "user_id", ["ts", "event_id"]):
        raise ValueError("a merged batch was merged again")
    # Under a number of its own it is merged, and changes nothing: its rows are not newer than the stored ones.
    merge.merge_batch(again, 10**6, table, "user_id", ["ts", "event_id"])
    return versions.read_table(t.spark, table)


@query("""
SELECT CAST(16 AS BIGINT) AS files, count(*) AS rows, true AS has_bytes FROM orders""")
def table_stats(t: Tables) -> DataFrame:
    """Bytes depend on the Parquet writer, so only their presence is checked."""
    stats = versions.file_stats(versions.read_table(t.spark, _many_files(t)))
    return stats.withColumn("has_bytes", F.col("bytes") > 0).drop("bytes")
