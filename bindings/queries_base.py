"""Ingestion, cleaning, joins, order-level aggregates and skew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.registry import query
from bindings.tables import SOLD, Tables, WIDE_COLUMNS
from loyaltide.functions.columns import churn_flag
from loyaltide.operators import clean, features, orders, profile, skew
from loyaltide.operators.drift import except_distinct as except_distinct_rows
from loyaltide.plans.staging import scratch_path
from loyaltide.sources import files, metrics, records, schemas
from loyaltide.streaming.score import risk_tier as add_risk_tier

STAMP = "'%Y-%m-%d %H:%M:%S'"


def when(column: str) -> str:
    return f"strftime({column}, {STAMP}) AS {column}"


def rnd(expr: str, alias: str | None = None, digits: int = 6) -> str:
    return f"round({expr}, {digits}) AS {alias or expr}"


# --- sources and sinks -------------------------------------------------------

LINE_SCHEMA = schemas.table(
    order_id="long!", order_item_id="int", price="double", quantity="double", flag="string", shipped="timestamp")


def _lines(t: Tables) -> DataFrame:
    return t.raw("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("order_item_id"),
        F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"),
        F.col("l_returnflag").alias("flag"), F.date_format("l_shipdate", records.TIMESTAMP_FORMAT).alias("shipped"))


@query(f"""
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, {rnd('l_extendedprice', 'price')},
       {rnd('l_quantity', 'quantity')}, l_returnflag AS flag, strftime(l_shipdate, {STAMP}) AS shipped
FROM lineitem""")
def csv_enforced_read(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    _lines(t).write.option("header", True).csv(path)
    return files.ingest_table(t.spark, path, LINE_SCHEMA, "order_id")


@query("""
SELECT l_returnflag = 'R' AS is_corrupt, count(*) AS n, count(DISTINCT l_orderkey) AS orders
FROM lineitem GROUP BY 1""")
def csv_corrupt_quarantine(t: Tables) -> DataFrame:
    """Returned items are written with a price that is no number, and must all be quarantined."""
    path = scratch_path(t.spark, "csv-corrupt")
    damaged = _lines(t).withColumn(
        "price", F.when(F.col("flag") == "R", F.lit("n/a")).otherwise(F.col("price").cast("string")))
    damaged.write.option("header", True).csv(path)
    found = records.ingest_csv(t.spark, path, LINE_SCHEMA, scratch_path(t.spark, "csv-ingested"), "order_id")
    intact = found.good.select(F.lit(False).alias("is_corrupt"), "order_id")
    corrupt = found.corrupt.select(
        F.lit(True).alias("is_corrupt"), F.split("line", ",")[0].cast("long").alias("order_id"))
    return intact.unionByName(corrupt).groupBy("is_corrupt").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("order_id").alias("orders"))


SPLITS = 1_000  # about, beyond which they grow with the texts
TEXT_SCHEMA = schemas.table(doc_id="long!", source="string", text="string")


@query("""
SELECT doc_id, source, length(text) AS n_chars, sha256(text) AS text_sha256, 'good' AS part FROM documents
UNION ALL SELECT NULL, NULL, length(text), sha256(text), 'without key' FROM documents WHERE doc_id % 50 = 0
UNION ALL SELECT NULL, NULL, NULL, sha256('x' || doc_id || ',' || source || ',bad'), 'corrupt' FROM documents WHERE doc_id % 50 = 1""")
def csv_many_splits(t: Tables) -> DataFrame:
    """Whole texts with their line breaks and quotes, as files that are read in many splits."""
    path, size = scratch_path(t.spark, "csv-texts"), "spark.sql.files.maxPartitionBytes"
    docs = t.raw("documents").select("doc_id", "source", "text")
    keyless = docs.filter("doc_id % 50 = 0").withColumn("doc_id", F.lit(None).cast("long"))
    bad = docs.filter("doc_id % 50 = 1").select(F.concat(F.lit("x"), "doc_id").alias("doc_id"), "source", F.lit("bad").alias("text"))
    written = docs.unionByName(keyless).withColumn("doc_id", F.col("doc_id").cast("string")).unionByName(bad)
    written.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False,
                                      ignoreTrailingWhiteSpace=False).csv(path)
    before, all_bytes = t.spark.conf.get(size), docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    t.spark.conf.set(size, str(max(128 << 10, all_bytes // SPLITS)))  # of this write alone, which ends inside
    try:
        found = records.ingest_csv(t.spark, path, TEXT_SCHEMA, scratch_path(t.spark, "texts"), "doc_id", multi_line=True)
    finally:
        t.spark.conf.set(size, before)

    def part(df, name, text):
        return df.select(df["doc_id"] if "doc_id" in df.columns else F.lit(None).cast("long").alias("doc_id"),
                         df["source"] if name == "good" else F.lit(None).cast("string").alias("source"),
                         (F.lit(None) if name == "corrupt" else F.length(text)).cast("long").alias("n_chars"),
                         F.sha2(text, 256).alias("text_sha256"), F.lit(name).alias("part"))

    return part(found.good, "good", "text").unionByName(part(found.without_key, "without key", "text")) \
        .unionByName(part(found.corrupt, "corrupt", "line"))


def _orders_with_gaps(t: Tables) -> DataFrame:
    """Orders beside the part of the same number; orders beyond the last part have none."""
    return t.raw("orders").join(t.raw("part"), F.col("o_orderkey") == F.col("p_partkey"), "left").select(
        "o_orderkey", "p_partkey")


@query("""
SELECT o_orderkey, p_partkey FROM orders JOIN part ON o_orderkey = p_partkey""")
def pk_not_null(t: Tables) -> DataFrame:
    return files.drop_null_keys(_orders_with_gaps(t), "p_partkey")


@query("""
SELECT 'p_partkey' AS key, count(*) AS rows, count(*) - count(p_partkey) AS null_keys
FROM orders LEFT JOIN part ON o_orderkey = p_partkey""")
def pk_null_report(t: Tables) -> DataFrame:
    return files.null_key_report(_orders_with_gaps(t), "p_partkey")


@query("""
SELECT property, count(*) AS n, count(DISTINCT itemid) AS items, max(value) AS largest FROM (
  SELECT l_partkey AS itemid, 'returnflag' AS property, l_returnflag AS value FROM lineitem
  UNION ALL SELECT p_partkey, 'brand', p_brand FROM part)
GROUP BY property""")
def union_item_properties(t: Tables) -> DataFrame:
    first = t.raw("lineitem").select(
        F.col("l_partkey").alias("itemid"), F.lit("returnflag").alias("property"), F.col("l_returnflag").alias("value"))
    second = t.raw("part").select(
        F.col("p_brand").alias("value"), F.col("p_partkey").alias("itemid"), F.lit("brand").alias("property"))
    return files.union_parts(first, second).groupBy("property").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("itemid").alias("items"), F.max("value").alias("largest"))


@query(f"""
SELECT order_id, order_item_id, product_id, seller_id, {rnd('price')}, {rnd('freight_value')} FROM v_items""")
def parquet_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "items")
    files.write_parquet(t.items, path)
    return files.read_parquet(t.spark, path)


CUSTOMER_ORDERS = """
SELECT o.order_id, o.order_status, c.customer_unique_id, c.customer_state
FROM v_orders o JOIN v_customers c ON c.customer_id = o.customer_id"""


def _orders_by_state(t: Tables) -> str:
    path = scratch_path(t.spark, "orders-by-state")
    rows = t.orders.join(t.customers, "customer_id").select(
        "order_id", "order_status", "customer_unique_id", "customer_state")
    files.write_by_state(rows, path)
    return path


@query(CUSTOMER_ORDERS)
def partitioned_roundtrip(t: Tables) -> DataFrame:
    return files.read_states(t.spark, _orders_by_state(t))


@query(CUSTOMER_ORDERS + " WHERE customer_state IN ('NATION_3', 'NATION_7') AND order_status = 'F'")
def partition_filter_read(t: Tables) -> DataFrame:
    return files.read_parquet(t.spark, _orders_by_state(t), partition_filter={
        "customer_state": ["NATION_3", "NATION_7"], "order_status": "F"})


@query(f"SELECT customer_state, count(*) AS rows FROM ({CUSTOMER_ORDERS}) GROUP BY 1")
def partition_inventory(t: Tables) -> DataFrame:
    return files.partition_inventory(files.read_states(t.spark, _orders_by_state(t)), "customer_state")


@query(f"""
WITH per_status AS (
  SELECT o_orderstatus, count(*) AS orders, sum(o_totalprice) AS revenue FROM orders GROUP BY 1)
SELECT 'order_status' AS kind, 'run_1' AS run_id, o_orderstatus AS entity, metric, round(value, 2) AS value
FROM (SELECT o_orderstatus, 'orders' AS metric, CAST(orders AS DOUBLE) AS value FROM per_status
      UNION ALL SELECT o_orderstatus, 'revenue', revenue FROM per_status)""", digits=2)
def metrics_append(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "run-metrics")
    per_status = t.raw("orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("revenue"))
    metrics.append_metrics(metrics.as_metrics(per_status, "order_status", "run_1", F.col("o_orderstatus")), path)
    return metrics.read_metrics(t.spark, path, "order_status").select("kind", "run_id", "entity", "metric", "value")


@query("""
SELECT lpad(CAST(o_orderkey % 12 AS VARCHAR), 3, '0') AS customer_state, count(*) AS orders
FROM orders WHERE o_orderkey % 12 IN (1, 10) GROUP BY 1""")
def partition_text_keys(t: Tables) -> DataFrame:
    """Partition values with leading zeros, written, filtered and read back as text."""
    path = scratch_path(t.spark, "text-keys")
    key = F.lpad((F.col("o_orderkey") % 12).cast("string"), 3, "0")
    files.write_by_state(t.raw("orders").select("o_orderkey", key.alias("customer_state")), path)
    return files.read_states(t.spark, path, ["001", "010", "1"]).groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("orders"))


# --- profiles of raw tables --------------------------------------------------

@query("""
SELECT * FROM (
  SELECT 'event_id' AS "column", 'bigint' AS expected_type, 'bigint' AS actual_type, true AS present,
         true AS type_matches, CAST(0 AS BIGINT) AS failing_rows
  UNION ALL SELECT 'value', 'int', 'double', true, false,
         count(*) FILTER (WHERE value IS NOT NULL AND TRY_CAST(value AS INTEGER) IS NULL) FROM events
  UNION ALL SELECT 'event_type', 'double', 'string', true, false,
         count(*) FILTER (WHERE event_type IS NOT NULL AND TRY_CAST(event_type AS DOUBLE) IS NULL) FROM events
  UNION ALL SELECT 'session', 'string', NULL, false, false, NULL)""")
def schema_conformance(t: Tables) -> DataFrame:
    return profile.schema_conformance(
        t.raw("events"), schemas.table(event_id="long", value="int", event_type="double", session="string"))


NULLS_SQL = " UNION ALL ".join(f"""
SELECT '{name}' AS "column", count(*) AS rows, count(*) - count({name}) AS null_count,
       round((count(*) - count({name})) * 100.0 / count(*), 6) AS null_pct
FROM v_wide""" for name in WIDE_COLUMNS)


@query(NULLS_SQL)
def null_profile(t: Tables) -> DataFrame:
    return profile.null_profile(t.wide)


@query(f"""
SELECT o_orderkey, o_custkey, o_orderstatus, {rnd('o_totalprice')}, {when('o_orderdate')}, o_orderpriority,
       (SELECT count(*) FROM orders) AS table_rows
FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def table_sample(t: Tables) -> DataFrame:
    return profile.table_sample(t.raw("orders"), [F.col("o_totalprice").desc(), "o_orderkey"], 20)


SIZE_SQL = " UNION ALL ".join(f"""
SELECT '{name}' AS table_name, count(*) AS rows, round(count(*) * 100.0 / 1048576, 6) AS estimated_mb,
       count(*) * 100.0 / 1048576 < 100 AS broadcastable,
       CAST(pow(2, ceil(log2(greatest(1, ceil(count(*) * 100.0 / 1048576 / 128))))) AS BIGINT) AS recommended_partitions
FROM {name}""" for name in ("customer", "events", "lineitem", "orders", "part"))


@query(SIZE_SQL)
def table_size_profile(t: Tables) -> DataFrame:
    parts = [profile.table_size_profile(t.raw(name), name)
             for name in ("customer", "events", "lineitem", "orders", "part")]
    return files.union_parts(*parts)


# --- row transforms ----------------------------------------------------------

@query("SELECT product_id, product_category_name, category_english FROM v_translated")
def category_translate(t: Tables) -> DataFrame:
    return orders.category_translate(t.products, t.category)


@query(f"""
SELECT order_id, {when('order_purchase_timestamp')}, {when('order_estimated_delivery_date')},
       {when('order_delivered_customer_date')}, customer_unique_id, customer_state, order_status,
       primary_payment_type, review_score, {rnd('total_payment_value')}, num_payment_types, {rnd('avg_installments')},
       num_items, {rnd('total_price')}, {rnd('total_freight')}, {rnd('avg_item_price')}, num_products, num_sellers,
       num_categories, categories
FROM v_filled""")
def null_fill(t: Tables) -> DataFrame:
    return clean.null_fill(t.wide, keys=("order_id", "customer_unique_id"))


@query("""
SELECT l_orderkey, l_linenumber,
       round(least(greatest(l_extendedprice, price[1]), price[2]), 6) AS l_extendedprice,
       round(least(greatest(l_quantity, quantity[1]), quantity[2]), 6) AS l_quantity,
       least(greatest(l_partkey, part[1]), part[2]) AS l_partkey
FROM lineitem, (SELECT quantile_disc(l_extendedprice, [0.01, 0.99]) AS price,
                       quantile_disc(l_quantity, [0.01, 0.99]) AS quantity,
                       quantile_disc(l_partkey, [0.01, 0.99]) AS part FROM lineitem)""")
def winsorize(t: Tables) -> DataFrame:
    rows = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_partkey")
    return clean.winsorize(rows, ["l_extendedprice", "l_quantity", "l_partkey"])


@query("""
SELECT event_id, CAST(year(ts) AS INTEGER) AS ts_year, CAST(month(ts) AS INTEGER) AS ts_month,
       CAST(dayofweek(ts) + 1 AS INTEGER) AS ts_dow, CAST(hour(ts) AS INTEGER) AS ts_hour FROM events""")
def date_parts(t: Tables) -> DataFrame:
    return clean.date_parts(t.raw("events").select("event_id", "ts"), "ts", "ts").drop("ts")


@query("""
SELECT order_id, CAST(date_diff('day', CAST(order_estimated_delivery_date AS DATE),
       CAST(order_delivered_customer_date AS DATE)) AS INTEGER) AS delivery_delay_days FROM v_orders""")
def delivery_delay(t: Tables) -> DataFrame:
    return clean.delivery_delay(t.orders).select("order_id", "delivery_delay_days")


TRANSFORMED_SQL = f"""
SELECT order_id, {when('order_purchase_timestamp')}, {when('order_estimated_delivery_date')},
       {when('order_delivered_customer_date')}, customer_unique_id, customer_state, order_status,
       primary_payment_type, review_score, {rnd('total_payment_value')}, num_payment_types, {rnd('avg_installments')},
       num_items, {rnd('total_price')}, {rnd('total_freight')}, {rnd('avg_item_price')}, num_products, num_sellers,
       num_categories, categories, purchase_year, purchase_month, purchase_dow, purchase_hour, delivery_delay_days
FROM v_transformed"""


@query(TRANSFORMED_SQL)
def transform_orders(t: Tables) -> DataFrame:
    return t.build_transformed()


@query("""
SELECT customer_unique_id, recency_days, CASE WHEN recency_days > 180 THEN 1 ELSE 0 END AS churn_label FROM v_rfm""")
def churn_label(t: Tables) -> DataFrame:
    return features.churn_label(features.rfm(t.transformed)).select(
        "customer_unique_id", "recency_days", "churn_label")


@query("""
SELECT o_custkey, frequency, round(monetary, 2) AS monetary,
       CASE WHEN monetary > quantile_disc(monetary, 0.75) OVER () THEN 1 ELSE 0 END AS high_value_customer,
       CASE WHEN frequency > 1 THEN 1 ELSE 0 END AS is_repeat_buyer
FROM (SELECT o_custkey, count(*) AS frequency, round(sum(o_totalprice), 2) AS monetary FROM orders GROUP BY 1)
""", digits=2)
def value_flags(t: Tables) -> DataFrame:
    spend = t.raw("orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("frequency"), F.round(F.sum("o_totalprice"), 2).alias("monetary"))
    return features.value_flags(spend)


@query("""
SELECT l_orderkey, l_linenumber, round(l_discount * 10, 6) AS churn_probability,
       CASE WHEN l_discount * 10 >= 0.75 THEN 'HIGH' WHEN l_discount * 10 >= 0.50 THEN 'MEDIUM'
            WHEN l_discount * 10 >= 0.25 THEN 'LOW' ELSE 'SAFE' END AS risk_tier
FROM lineitem""")
def risk_tier(t: Tables) -> DataFrame:
    scored = t.raw("lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_discount") * 10).alias("churn_probability"))
    return add_risk_tier(scored).drop("processed_at")


@query("""
SELECT doc_id, quality, round(n * 1.0 / (k * n_i), 6) AS sample_weight
FROM labels JOIN (SELECT quality AS q, count(*) AS n_i FROM labels GROUP BY 1) ON q = quality,
     (SELECT count(*) AS n, count(DISTINCT quality) AS k FROM labels)""")
def sample_weights(t: Tables) -> DataFrame:
    rows = t.raw("labels").select("doc_id", "quality")
    return profile.sample_weights(rows, profile.class_weights(rows, "quality"), "quality")


@query("""
SELECT order_id, categories, num_categories, num_categories AS flattened_size,
       string_split(categories, '|')[1] AS first_category FROM v_order_categories""")
def array_functions(t: Tables) -> DataFrame:
    sets = orders.items_by_category(t.items, t.products, t.category)
    return sets.withColumns({
        "flattened_size": F.size(F.flatten(F.array("categories"))),
        "first_category": F.get("categories", F.lit(0)),
    })


# --- joins -------------------------------------------------------------------

@query(f"""
SELECT order_id, order_status, {when('order_purchase_timestamp')}, {when('order_estimated_delivery_date')},
       {when('order_delivered_customer_date')}, customer_unique_id, customer_state, {rnd('total_payment_value')},
       num_payment_types, {rnd('avg_installments')}, primary_payment_type, num_items, {rnd('total_price')},
       {rnd('total_freight')}, {rnd('avg_item_price')}, num_products, num_sellers, review_score, categories,
       num_categories
FROM v_wide""")
def order_wide(t: Tables) -> DataFrame:
    return t.build_wide()


@query("SELECT order_id, categories, num_categories FROM v_order_categories")
def items_by_category(t: Tables) -> DataFrame:
    return orders.items_by_category(t.items, t.products, t.category)


@query("""
SELECT p_type, p_brand, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2""", digits=2)
def broadcast_join(t: Tables) -> DataFrame:
    part = t.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand")
    joined = skew.broadcast_join(t.raw("lineitem").select("l_partkey", "l_extendedprice"), part, "l_partkey", "inner")
    return joined.groupBy("p_type", "p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("revenue"))


# A key of which one value holds most rows: every event type but 'error' counts as activity.
SKEWED_KEY = "CASE WHEN event_type = 'error' THEN 'user_' || user_id ELSE 'activity' END"


def _skewed_events(t: Tables) -> DataFrame:
    key = F.when(F.col("event_type") == "error", F.concat(F.lit("user_"), F.col("user_id").cast("string")))
    return t.raw("events").select("event_id", key.otherwise("activity").alias("key"), "value")


SKEW_SIDES = {
    "v_skewed": f"SELECT event_id, {SKEWED_KEY} AS key, value FROM events",
    "v_key_names": f"""
SELECT {SKEWED_KEY} AS key, 'group ' || {SKEWED_KEY} AS label
FROM events GROUP BY 1, 2 HAVING max(value) > 20""",
}


def _key_names(t: Tables) -> DataFrame:
    """A label for keys with a large event, so that some keys have none."""
    keys = _skewed_events(t).groupBy("key").agg(F.max("value").alias("largest"))
    return keys.filter(F.col("largest") > 20).select("key", F.concat(F.lit("group "), "key").alias("label"))


@query(f"""
SELECT event_id, key, {rnd('value')}, label FROM v_skewed JOIN v_key_names USING (key)""", views=SKEW_SIDES)
def salted_join(t: Tables) -> DataFrame:
    return skew.salted_join(_skewed_events(t), _key_names(t), "key", "inner", row_key=["event_id"])


@query(f"""
SELECT event_id, key, {rnd('value')}, label FROM v_skewed LEFT JOIN v_key_names USING (key)""", views=SKEW_SIDES)
def salted_left_join(t: Tables) -> DataFrame:
    return skew.salted_join(_skewed_events(t), _key_names(t), "key", "left", row_key=["event_id"])


@query("""
SELECT key, count(*) AS row_count, round(sum(value), 6) AS sum_value, round(avg(value), 6) AS avg_value,
       round(min(value), 6) AS min_value, round(max(value), 6) AS max_value
FROM v_skewed GROUP BY key""", digits=6, views=SKEW_SIDES)
def salted_aggregate(t: Tables) -> DataFrame:
    return skew.salted_aggregate(_skewed_events(t), "key", "value", row_key=["event_id"])


def _skew_sql(column: str, expr: str) -> str:
    return f"""
SELECT '{column}' AS "column", max(n) AS max_rows, avg(n) AS avg_rows, min(n) AS min_rows, stddev_samp(n) AS std_rows,
       count(*) AS num_keys, max(n) / avg(n) AS skew_ratio
FROM (SELECT {expr} AS k, count(*) AS n FROM events GROUP BY 1)"""


SKEW_FIGURES = """max_rows, round(avg_rows, 4) AS avg_rows, min_rows, round(std_rows, 4) AS std_rows, num_keys,
       round(skew_ratio, 4) AS skew_ratio, skew_ratio >= 3 AS is_skewed,
       CASE WHEN skew_ratio >= 5 THEN 'critical' WHEN skew_ratio >= 3 THEN 'moderate' ELSE 'none' END AS severity"""


@query(f"""
SELECT "column", key, rows, {SKEW_FIGURES}
FROM (SELECT {SKEWED_KEY} AS key, count(*) AS rows FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10),
     ({_skew_sql('key', SKEWED_KEY)})""", digits=4)
def key_skew(t: Tables) -> DataFrame:
    return skew.key_skew(_skewed_events(t), "key")


@query(f"""
SELECT "column", {SKEW_FIGURES} FROM ({_skew_sql('event_type', 'event_type')}
UNION ALL {_skew_sql('user_id', 'user_id')} UNION ALL {_skew_sql('value', 'value')})""", digits=4)
def key_skew_multi(t: Tables) -> DataFrame:
    return skew.key_skew_multi(t.raw("events"), ["event_type", "user_id", "value"])


# --- order-level aggregates --------------------------------------------------

@query(f"""
SELECT order_id, {rnd('total_payment_value')}, num_payment_types, {rnd('avg_installments')}, primary_payment_type
FROM v_order_payments""")
def payments_per_order(t: Tables) -> DataFrame:
    return orders.payments_per_order(t.payments)


@query(f"""
SELECT order_id, num_items, {rnd('total_price')}, {rnd('total_freight')}, {rnd('avg_item_price')}, num_products,
       num_sellers FROM v_order_items""")
def items_per_order(t: Tables) -> DataFrame:
    return orders.items_per_order(t.items)


@query("SELECT order_id, review_score FROM v_order_reviews")
def best_review(t: Tables) -> DataFrame:
    return orders.best_review(t.reviews)


@query("""
SELECT visitorid, count(*) FILTER (WHERE event = 'view') AS rr_view_count,
       count(*) FILTER (WHERE event = 'addtocart') AS rr_cart_count,
       count(*) FILTER (WHERE event = 'transaction') AS rr_purchase_count,
       count(DISTINCT itemid) AS rr_unique_items,
       round(CASE WHEN count(*) FILTER (WHERE event = 'view') > 0
             THEN count(*) FILTER (WHERE event = 'transaction') / count(*) FILTER (WHERE event = 'view')
             ELSE 0.0 END, 6) AS rr_view_to_purchase_rate
FROM v_events GROUP BY visitorid""")
def visitor_signals(t: Tables) -> DataFrame:
    return orders.visitor_signals(t.events)


# --- windows and set operations ----------------------------------------------

@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {rnd('l_quantity')}, {rnd('l_extendedprice')},
       {rnd('l_discount')}, {rnd('l_tax')}, l_returnflag, l_linestatus, {when('l_shipdate')}
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey,
             l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
      FROM lineitem) WHERE rn = 1""")
def dedup_latest(t: Tables) -> DataFrame:
    return clean.dedup_latest(t.raw("lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@query("""
SELECT l_partkey AS part, l_suppkey AS supplier FROM lineitem WHERE l_returnflag <> 'R'
EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'""")
def except_distinct(t: Tables) -> DataFrame:
    pairs = t.raw("lineitem").select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"),
                                     "l_returnflag")
    returned = F.col("l_returnflag") == "R"
    return except_distinct_rows(
        pairs.filter(~returned).drop("l_returnflag"), pairs.filter(returned).drop("l_returnflag"))


@query(f"""
SELECT order_status, count(*) AS n, CAST(sum(CASE WHEN age > 180 THEN 1 ELSE 0 END) AS BIGINT) AS late
FROM (SELECT order_status, date_diff('day', CAST(order_purchase_timestamp AS DATE),
             (SELECT CAST(max(order_purchase_timestamp) AS DATE) FROM v_orders)) AS age FROM v_orders)
WHERE order_status IN {SOLD} GROUP BY 1""")
def status_whitelist(t: Tables) -> DataFrame:
    """Sold orders by status, with those older than the churn limit."""
    placed = t.orders
    age = F.datediff(features.reference_time(placed), "order_purchase_timestamp")
    sold = placed.filter(F.col("order_status").isin(*SOLD))
    return sold.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("n"), F.sum(churn_flag(age)).alias("late"))
