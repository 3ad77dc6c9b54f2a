"""The given tables seen as retail tables, once as DataFrames and once as SQL.

Each view exists in both forms: ``VIEWS`` holds the SQL of the oracle and is
written independently of the operators.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loyaltide.operators import orders as order_ops
from loyaltide.plans.pipelines import transform_pipeline, user_features
from loyaltide.plans.staging import scratch_path

# Every column of the order table and of the feature store, and those of them that are numbers.
WIDE_COLUMNS = (
    "order_id", "order_status", "order_purchase_timestamp", "order_estimated_delivery_date", "order_delivered_customer_date",
    "customer_unique_id", "customer_state", "total_payment_value", "num_payment_types", "avg_installments",
    "primary_payment_type", "num_items", "total_price", "total_freight", "avg_item_price", "num_products", "num_sellers",
    "review_score", "categories", "num_categories")
WIDE_NUMERIC = tuple(c for c in WIDE_COLUMNS if c not in (
    "order_status", "customer_state", "primary_payment_type", "categories") and not c.endswith(("_timestamp", "_date")))
FEATURE_COLUMNS = (
    "customer_unique_id", "recency_days", "frequency", "monetary", "avg_order_value", "avg_review_score", "std_review_score",
    "min_review_score", "avg_payment_types", "avg_installments", "primary_payment_type", "total_freight", "avg_freight_ratio",
    "weekend_purchase_ratio", "avg_purchase_hour", "avg_categories_per_order", "total_category_count", "avg_delivery_delay",
    "max_delivery_delay", "avg_items_per_order", "total_items_purchased", "customer_state", "spend_trend", "churn_label",
    "high_value_customer", "is_repeat_buyer")
FEATURE_NUMERIC = tuple(c for c in FEATURE_COLUMNS if c not in ("primary_payment_type", "customer_state", "churn_label"))

# Order states of the given data that stand for a sale, and for a delivered order.
SOLD = ("F", "O")
DELIVERED = "F"
UNTRANSLATED = "PROMO"


def _cents(amount: Column) -> Column:
    """Cut to whole cents: unlike rounding, both engines agree on it."""
    return F.floor(amount * 100) / 100


class Tables:
    """Views over one folder of given tables."""

    # Tables that several queries start from, written once per session and folder.
    _stored: dict[tuple[str, str, str], str] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    @classmethod
    def forget(cls) -> None:
        """Have stored tables built anew, as in a new session."""
        cls._stored.clear()

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _stored_table(self, name: str, build) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        try:
            return self.spark.read.parquet(self._stored[key])
        except (KeyError, AnalysisException):  # not stored yet, or cleaned away since
            self._stored[key] = scratch_path(self.spark, name)
            build().write.parquet(self._stored[key])
            return self.spark.read.parquet(self._stored[key])

    @property
    def orders(self) -> DataFrame:
        delivered = order_ops.per_order(
            self.raw("lineitem").select(F.col("l_orderkey").alias("order_id"), "l_shipdate"),
            lambda shipped: shipped.groupBy("order_id").agg(F.max("l_shipdate").alias("order_delivered_customer_date")))
        placed = self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            (F.col("o_orderdate") + F.expr("INTERVAL 90 DAYS")).alias("order_estimated_delivery_date"))
        return placed.join(delivered, "order_id", "left")

    @property
    def customers(self) -> DataFrame:
        nation = self.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return self.raw("customer").join(nation, "c_nationkey", "left").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_custkey").alias("customer_unique_id"),
            F.col("n_name").alias("customer_state"))

    @property
    def items(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_extendedprice").alias("price"),
            _cents(F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"))

    @property
    def payments(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            F.col("l_returnflag").alias("payment_type"),
            F.col("l_linenumber").alias("payment_installments"),
            _cents(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("payment_value"))

    @property
    def reviews(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            (F.col("l_quantity").cast("int") % 5 + 1).alias("review_score"))

    @property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_name"))

    @property
    def category(self) -> DataFrame:
        return self.raw("part").filter(F.col("p_type") != UNTRANSLATED).select(
            F.col("p_type").alias("product_category_name"),
            F.lower("p_type").alias("product_category_name_english")).distinct()

    @property
    def events(self) -> DataFrame:
        kind = F.col("event_type")
        return self.raw("events").select(
            F.col("ts").alias("event_time"),
            F.col("user_id").alias("visitorid"),
            F.when(kind == "click", "addtocart").when(kind == "purchase", "transaction").otherwise(kind).alias("event"),
            F.get_json_object("props", "$.k").cast("int").alias("itemid"),
            "value")

    def build_wide(self) -> DataFrame:
        return order_ops.order_wide(
            self.orders, self.customers, self.items, self.payments, self.reviews, self.products, self.category,
            statuses=SOLD)

    def build_transformed(self) -> DataFrame:
        return transform_pipeline(self.build_wide())

    def build_features(self) -> DataFrame:
        return user_features(self.transformed)

    @property
    def wide(self) -> DataFrame:
        return self._stored_table("order-wide", self.build_wide)

    @property
    def transformed(self) -> DataFrame:
        return self._stored_table("transformed", self.build_transformed)

    @property
    def features(self) -> DataFrame:
        return self._stored_table("user-features", self.build_features)


VIEWS = {
    "v_delivery": """
SELECT l_orderkey AS order_id, max(l_shipdate) AS order_delivered_customer_date
FROM lineitem GROUP BY l_orderkey""",
    "v_orders": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
       o_orderdate AS order_purchase_timestamp,
       o_orderdate + INTERVAL 90 DAY AS order_estimated_delivery_date,
       order_delivered_customer_date
FROM orders LEFT JOIN v_delivery ON order_id = o_orderkey""",
    "v_customers": """
SELECT c_custkey AS customer_id, c_custkey AS customer_unique_id, n_name AS customer_state
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "v_items": """
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
       l_suppkey AS seller_id, l_extendedprice AS price, floor(l_extendedprice * l_tax * 100) / 100 AS freight_value
FROM lineitem""",
    "v_payments": """
SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential, l_returnflag AS payment_type,
       l_linenumber AS payment_installments, floor(l_extendedprice * (1 - l_discount) * 100) / 100 AS payment_value
FROM lineitem""",
    "v_reviews": """
SELECT l_orderkey AS order_id, CAST(floor(l_quantity) AS INTEGER) % 5 + 1 AS review_score FROM lineitem""",
    "v_products": "SELECT p_partkey AS product_id, p_type AS product_category_name FROM part",
    "v_category": f"""
SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
FROM part WHERE p_type <> '{UNTRANSLATED}'""",
    "v_events": """
SELECT ts AS event_time, user_id AS visitorid,
       CASE event_type WHEN 'click' THEN 'addtocart' WHEN 'purchase' THEN 'transaction' ELSE event_type END AS event,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS itemid, value
FROM events""",
    "v_translated": """
SELECT product_id, p.product_category_name,
       coalesce(product_category_name_english, p.product_category_name) AS category_english
FROM v_products p LEFT JOIN v_category c ON p.product_category_name = c.product_category_name""",
    "v_first_payment": """
SELECT order_id, payment_type FROM (
  SELECT order_id, payment_type,
         row_number() OVER (PARTITION BY order_id ORDER BY payment_sequential, payment_type) AS rn
  FROM v_payments) WHERE rn = 1""",
    "v_order_payments": """
SELECT p.order_id, sum(payment_value) AS total_payment_value,
       count(DISTINCT p.payment_type) AS num_payment_types, avg(payment_installments) AS avg_installments,
       any_value(f.payment_type) AS primary_payment_type
FROM v_payments p JOIN v_first_payment f ON f.order_id = p.order_id GROUP BY p.order_id""",
    "v_order_items": """
SELECT order_id, count(order_item_id) AS num_items, sum(price) AS total_price,
       sum(freight_value) AS total_freight, avg(price) AS avg_item_price,
       count(DISTINCT product_id) AS num_products, count(DISTINCT seller_id) AS num_sellers
FROM v_items GROUP BY order_id""",
    "v_order_reviews": "SELECT order_id, max(review_score) AS review_score FROM v_reviews GROUP BY order_id",
    "v_order_category": """
SELECT DISTINCT order_id, category_english AS category
FROM v_items i LEFT JOIN v_translated t ON t.product_id = i.product_id""",
    "v_order_categories": """
SELECT order_id, string_agg(category, '|' ORDER BY category) AS categories,
       CAST(count(category) AS INTEGER) AS num_categories
FROM v_order_category GROUP BY order_id""",
    "v_wide": f"""
SELECT o.order_id, order_status, order_purchase_timestamp, order_estimated_delivery_date,
       order_delivered_customer_date, customer_unique_id, customer_state,
       total_payment_value, num_payment_types, avg_installments, primary_payment_type,
       num_items, total_price, total_freight, avg_item_price, num_products, num_sellers,
       review_score, categories, num_categories
FROM v_orders o
LEFT JOIN v_customers c ON c.customer_id = o.customer_id
LEFT JOIN v_order_payments p ON p.order_id = o.order_id
LEFT JOIN v_order_items i ON i.order_id = o.order_id
LEFT JOIN v_order_reviews r ON r.order_id = o.order_id
LEFT JOIN v_order_categories g ON g.order_id = o.order_id
WHERE order_status IN {SOLD}""",
    "v_medians": """
SELECT quantile_disc(total_payment_value, 0.5) AS total_payment_value,
       quantile_disc(num_payment_types, 0.5) AS num_payment_types,
       quantile_disc(avg_installments, 0.5) AS avg_installments,
       quantile_disc(num_items, 0.5) AS num_items, quantile_disc(total_price, 0.5) AS total_price,
       quantile_disc(total_freight, 0.5) AS total_freight,
       quantile_disc(avg_item_price, 0.5) AS avg_item_price,
       quantile_disc(num_products, 0.5) AS num_products, quantile_disc(num_sellers, 0.5) AS num_sellers,
       quantile_disc(num_categories, 0.5) AS num_categories
FROM v_wide""",
    "v_filled": """
SELECT order_id, order_purchase_timestamp, order_estimated_delivery_date, order_delivered_customer_date,
       customer_unique_id, categories,
       coalesce(order_status, 'unknown') AS order_status,
       coalesce(customer_state, 'unknown') AS customer_state,
       coalesce(primary_payment_type, 'unknown') AS primary_payment_type,
       coalesce(review_score, 3) AS review_score,
       coalesce(w.total_payment_value, m.total_payment_value) AS total_payment_value,
       coalesce(w.num_payment_types, m.num_payment_types) AS num_payment_types,
       coalesce(w.avg_installments, m.avg_installments) AS avg_installments,
       coalesce(w.num_items, m.num_items) AS num_items,
       coalesce(w.total_price, m.total_price) AS total_price,
       coalesce(w.total_freight, m.total_freight) AS total_freight,
       coalesce(w.avg_item_price, m.avg_item_price) AS avg_item_price,
       coalesce(w.num_products, m.num_products) AS num_products,
       coalesce(w.num_sellers, m.num_sellers) AS num_sellers,
       coalesce(w.num_categories, m.num_categories) AS num_categories
FROM v_wide w, v_medians m""",
    "v_limits": """
SELECT quantile_disc(total_payment_value, [0.01, 0.99]) AS pay, quantile_disc(total_price, [0.01, 0.99]) AS price,
       quantile_disc(total_freight, [0.01, 0.99]) AS freight, quantile_disc(avg_item_price, [0.01, 0.99]) AS item,
       quantile_disc(num_items, [0.01, 0.99]) AS num, quantile_disc(avg_installments, [0.01, 0.99]) AS inst
FROM v_filled""",
    "v_transformed": """
SELECT order_id, order_purchase_timestamp, order_estimated_delivery_date, order_delivered_customer_date,
       customer_unique_id, categories, order_status, customer_state, primary_payment_type, review_score,
       least(greatest(total_payment_value, pay[1]), pay[2]) AS total_payment_value,
       num_payment_types,
       least(greatest(avg_installments, inst[1]), inst[2]) AS avg_installments,
       least(greatest(num_items, num[1]), num[2]) AS num_items,
       least(greatest(total_price, price[1]), price[2]) AS total_price,
       least(greatest(total_freight, freight[1]), freight[2]) AS total_freight,
       least(greatest(avg_item_price, item[1]), item[2]) AS avg_item_price,
       num_products, num_sellers, num_categories,
       CAST(year(order_purchase_timestamp) AS INTEGER) AS purchase_year,
       CAST(month(order_purchase_timestamp) AS INTEGER) AS purchase_month,
       CAST(dayofweek(order_purchase_timestamp) + 1 AS INTEGER) AS purchase_dow,
       CAST(hour(order_purchase_timestamp) AS INTEGER) AS purchase_hour,
       CAST(date_diff('day', CAST(order_estimated_delivery_date AS DATE),
                      CAST(order_delivered_customer_date AS DATE)) AS INTEGER) AS delivery_delay_days
FROM v_filled, v_limits""",
    "v_rfm": """
SELECT customer_unique_id,
       CAST(date_diff('day', CAST(max(order_purchase_timestamp) AS DATE),
            (SELECT CAST(max(order_purchase_timestamp) AS DATE) FROM v_transformed)) AS INTEGER) AS recency_days,
       count(DISTINCT order_id) AS frequency, sum(total_payment_value) AS monetary,
       avg(total_payment_value) AS avg_order_value
FROM v_transformed GROUP BY customer_unique_id""",
    "v_first_order": """
SELECT customer_unique_id, primary_payment_type, customer_state FROM (
  SELECT customer_unique_id, primary_payment_type, customer_state,
         row_number() OVER (PARTITION BY customer_unique_id ORDER BY order_purchase_timestamp, order_id) AS rn
  FROM v_transformed) WHERE rn = 1""",
    "v_behaviour": """
SELECT t.customer_unique_id, avg(review_score) AS avg_review_score, stddev_samp(review_score) AS std_review_score,
       min(review_score) AS min_review_score, avg(num_payment_types) AS avg_payment_types,
       avg(avg_installments) AS avg_installments,
       any_value(f.primary_payment_type) AS primary_payment_type,
       sum(total_freight) AS total_freight,
       avg(CASE WHEN total_payment_value > 0 THEN total_freight / total_payment_value ELSE 0.0 END)
         AS avg_freight_ratio,
       avg(CASE WHEN purchase_dow IN (1, 7) THEN 1 ELSE 0 END) AS weekend_purchase_ratio,
       avg(purchase_hour) AS avg_purchase_hour, avg(num_categories) AS avg_categories_per_order,
       CAST(coalesce(sum(len(string_split(categories, '|'))), 0) AS INTEGER) AS total_category_count,
       avg(delivery_delay_days) AS avg_delivery_delay, max(delivery_delay_days) AS max_delivery_delay,
       avg(num_items) AS avg_items_per_order, CAST(sum(num_items) AS BIGINT) AS total_items_purchased,
       any_value(f.customer_state) AS customer_state
FROM v_transformed t JOIN v_first_order f ON f.customer_unique_id = t.customer_unique_id
GROUP BY t.customer_unique_id""",
    "v_trend": """
SELECT customer_unique_id,
       CASE WHEN avg(total_payment_value) > 0
            THEN (avg(total_payment_value) FILTER (WHERE rn <= 2) - avg(total_payment_value))
                 / avg(total_payment_value) ELSE 0.0 END AS spend_trend
FROM (SELECT *, row_number() OVER (PARTITION BY customer_unique_id
                                   ORDER BY order_purchase_timestamp DESC, order_id DESC) AS rn
      FROM v_transformed)
GROUP BY customer_unique_id""",
    "v_features": """
SELECT r.customer_unique_id, recency_days, frequency, monetary, avg_order_value,
       avg_review_score, coalesce(std_review_score, 0.0) AS std_review_score, min_review_score,
       avg_payment_types, avg_installments, primary_payment_type, total_freight, avg_freight_ratio,
       weekend_purchase_ratio, avg_purchase_hour, avg_categories_per_order, total_category_count,
       avg_delivery_delay, max_delivery_delay, avg_items_per_order, total_items_purchased, customer_state,
       coalesce(spend_trend, 0.0) AS spend_trend,
       CASE WHEN recency_days > 180 THEN 1 ELSE 0 END AS churn_label,
       CASE WHEN monetary > (SELECT quantile_disc(monetary, 0.75) FROM v_rfm) THEN 1 ELSE 0 END
         AS high_value_customer,
       CASE WHEN frequency > 1 THEN 1 ELSE 0 END AS is_repeat_buyer
FROM v_rfm r JOIN v_behaviour b ON b.customer_unique_id = r.customer_unique_id
LEFT JOIN v_trend t ON t.customer_unique_id = r.customer_unique_id""",
}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """The query with the views it names, directly or through another view, as CTEs."""
    known = {**VIEWS, **(extra or {})}
    needed: set[str] = set()

    def collect(text: str) -> None:
        for name in set(re.findall(r"\bv_\w+", text)) & known.keys() - needed:
            needed.add(name)
            collect(known[name])

    collect(body)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({known[name].strip()})" for name in known if name in needed)
    return f"WITH {ctes}\n{body.strip()}" if ctes else body.strip()
