"""Order-level aggregates, the wide order table and clickstream signals."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyaltide.functions.columns import rows_where, safe_ratio
from loyaltide.operators.skew import hot_keys, per_key

# Order states that count as a sale.
SOLD_STATUSES = ("delivered", "shipped", "invoiced", "processing")

# An order is hot if it holds this share of the rows, and no fewer than this number of them.
HOT_SHARE = 0.001
HOT_ROWS = 100_000


def hot_orders(*tables: DataFrame) -> list:
    """Ids of hot orders, at most ``1 / HOT_SHARE`` of them; None stands for rows without an order."""
    ids = reduce(DataFrame.union, [t.select("order_id") for t in tables])
    return [r[0] for r in hot_keys(ids, "order_id", HOT_SHARE).filter(F.col("_rows") >= HOT_ROWS).select("order_id").collect()]


def most_rows(*tables: DataFrame) -> int:
    """Rows of the largest table."""
    counts = reduce(DataFrame.union, [t.agg(F.count(F.lit(1)).alias("rows")) for t in tables])
    return counts.agg(F.max("rows")).first()[0]


def per_order(df: DataFrame, combine: Callable[[DataFrame], DataFrame], hot: Sequence | None = None,
              rows: int | None = None) -> DataFrame:
    """``combine``, which groups by order, with the rows of an order brought together first, as an order has few."""
    hot = hot_orders(df) if hot is None else hot
    return per_key(df, "order_id", combine, hot, most_rows(df) if rows is None else rows)


# Fixed values, in the functions below: names of the output columns.
# ``hot`` names the hot orders, and ``rows`` is the number of rows to deal out, where the caller knows them already.
def payments_per_order(payments: DataFrame, hot: Sequence | None = None, rows: int | None = None) -> DataFrame:
    """Paid total, payment types, mean installments and the type of the first payment.

    Payments are first combined per order and type, over numbers only, which
    Spark does by hashing; the few rows per order that remain name the types.
    """
    return per_order(payments, _combined_payments, hot, rows)


def _combined_payments(payments: DataFrame) -> DataFrame:
    per_type = payments.groupBy("order_id", "payment_type").agg(
        F.sum("payment_value").alias("value"),
        F.sum("payment_installments").alias("installments"),
        F.count("payment_installments").alias("counted"),
        F.min("payment_sequential").alias("payment_sequential"),
    )
    return per_type.groupBy("order_id").agg(
        F.sum("value").alias("total_payment_value"),
        F.count("payment_type").alias("num_payment_types"),
        safe_ratio(F.sum("installments"), F.sum("counted")).alias("avg_installments"),
        F.min(F.struct(F.col("payment_sequential").isNull(), "payment_sequential", "payment_type"))["payment_type"].alias("primary_payment_type"),
    )


def items_per_order(items: DataFrame, hot: Sequence | None = None, rows: int | None = None) -> DataFrame:
    """Item count, value, freight and number of distinct products and sellers.

    Items are first combined per order and product, and per order and seller:
    two distinct counts in one aggregate would triple the rows. An order with
    very many items is counted by all tasks.
    """
    return per_order(items, _combined_items, hot, rows)


def _combined_items(items: DataFrame) -> DataFrame:
    per_product = items.groupBy("order_id", "product_id").agg(
        F.count("order_item_id").alias("items"), F.sum("price").alias("price"), F.count("price").alias("priced"),
        F.sum("freight_value").alias("freight"))
    products = per_product.groupBy("order_id").agg(
        F.sum("items").alias("num_items"),
        F.sum("price").alias("total_price"),
        F.sum("freight").alias("total_freight"),
        safe_ratio(F.sum("price"), F.sum("priced")).alias("avg_item_price"),
        F.count("product_id").alias("num_products"),
    )
    sellers = items.select("order_id", "seller_id").distinct().groupBy("order_id").agg(F.count("seller_id").alias("num_sellers"))
    # Null ids group together on both sides.
    return products.join(sellers.withColumnRenamed("order_id", "_order"), F.col("order_id").eqNullSafe(F.col("_order"))) \
        .drop("_order").select("order_id", "num_items", "total_price", "total_freight", "avg_item_price", "num_products",
                               "num_sellers")


def best_review(reviews: DataFrame, hot: Sequence | None = None, rows: int | None = None) -> DataFrame:
    return per_order(
        reviews, lambda some: some.groupBy("order_id").agg(F.max("review_score").alias("review_score")), hot, rows)


def category_translate(products: DataFrame, category: DataFrame) -> DataFrame:
    """Translated category name per product, or the original where there is none."""
    return products.join(category, "product_category_name", "left").select(
        "product_id",
        "product_category_name",
        F.coalesce("product_category_name_english", "product_category_name").alias("category_english"),
    )


def items_by_category(items: DataFrame, products: DataFrame, category: DataFrame,
                      hot: Sequence | None = None, rows: int | None = None) -> DataFrame:
    """Sorted category set of each order and its size.

    The set holds category names, of which an order has at most as many as the
    lookup; each is kept once per order before the set is built. The joins carry no hint: Spark broadcasts a side that is small enough
    and otherwise sorts, with hot products split at run time.
    """
    named = items.select("order_id", "product_id").join(
        category_translate(products, category).select("product_id", "category_english"), "product_id", "left")
    return per_order(named.select("order_id", "category_english"), _combined_categories,
                     hot_orders(items) if hot is None else hot, most_rows(items) if rows is None else rows)


def _combined_categories(named: DataFrame) -> DataFrame:
    return named.distinct().groupBy("order_id").agg(
        F.sort_array(F.collect_list("category_english")).alias("categories")
    ).withColumn("num_categories", F.size("categories"))


def order_wide(orders: DataFrame, customers: DataFrame, items: DataFrame, payments: DataFrame,
               reviews: DataFrame, products: DataFrame, category: DataFrame,
               statuses: Sequence[str] = SOLD_STATUSES) -> DataFrame:
    """One row per sold order with customer, payment, item, review and category columns.

    Customers are joined first, while the order rows are still narrow. The four
    order-level aggregates come out partitioned by ``order_id``, so the joins
    that follow need no further shuffle of theirs, unless there are hot orders.
    """
    payments, items, reviews = (df.filter(F.col("order_id").isNotNull()) for df in (payments, items, reviews))
    hot, rows = hot_orders(payments, items, reviews), most_rows(payments, items, reviews)
    sold = orders.filter(F.col("order_status").isin(*statuses))
    wide = sold.join(customers, "customer_id", "left").drop("customer_id")
    for side in (
        payments_per_order(payments, hot, rows),
        items_per_order(items, hot, rows),
        best_review(reviews, hot, rows),
        items_by_category(items, products, category, hot, rows),
    ):
        wide = wide.join(side, "order_id", "left")
    return wide


def visitor_signals(events: DataFrame) -> DataFrame:
    """View, cart and purchase counts per visitor and the rate of purchases to views."""
    kinds = {"rr_view_count": "view", "rr_cart_count": "addtocart", "rr_purchase_count": "transaction"}
    counted = events.groupBy("visitorid").agg(
        *[rows_where(F.col("event") == kind).alias(name) for name, kind in kinds.items()],
        F.count_distinct("itemid").alias("rr_unique_items"),
    )
    return counted.withColumn(
        "rr_view_to_purchase_rate",
        safe_ratio(F.col("rr_purchase_count"), F.col("rr_view_count"), 0.0))
