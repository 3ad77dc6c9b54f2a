"""Declared input schemas. The raw files carry exactly these columns."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "long": LongType(),
    "double": DoubleType(),
    "timestamp": TimestampType(),
}


def table(**columns: str) -> StructType:
    """Schema from ``name="type"`` pairs; a trailing ``!`` marks a required column."""
    return StructType([
        StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!"))
        for name, kind in columns.items()
    ])


ORDER_TABLES = {
    "customers": table(
        customer_id="string!", customer_unique_id="string!", customer_zip_code_prefix="string",
        customer_city="string", customer_state="string"),
    "orders": table(
        order_id="string!", customer_id="string!", order_status="string",
        order_purchase_timestamp="timestamp", order_approved_at="timestamp",
        order_delivered_carrier_date="timestamp", order_delivered_customer_date="timestamp",
        order_estimated_delivery_date="timestamp"),
    "order_items": table(
        order_id="string!", order_item_id="int", product_id="string", seller_id="string",
        shipping_limit_date="timestamp", price="double", freight_value="double"),
    "payments": table(
        order_id="string!", payment_sequential="int", payment_type="string",
        payment_installments="int", payment_value="double"),
    "reviews": table(
        review_id="string!", order_id="string!", review_score="int", review_comment_title="string",
        review_comment_message="string", review_creation_date="timestamp",
        review_answer_timestamp="timestamp"),
    "products": table(
        product_id="string!", product_category_name="string", product_name_lenght="int",
        product_description_lenght="int", product_photos_qty="int", product_weight_g="double",
        product_length_cm="double", product_height_cm="double", product_width_cm="double"),
    "sellers": table(
        seller_id="string!", seller_zip_code_prefix="string", seller_city="string",
        seller_state="string"),
    "geo": table(
        geolocation_zip_code_prefix="string", geolocation_lat="double", geolocation_lng="double",
        geolocation_city="string", geolocation_state="string"),
    "category": table(
        product_category_name="string", product_category_name_english="string"),
}

_ITEM_PROPERTIES = table(timestamp="long!", itemid="int!", property="string", value="string")

CLICK_TABLES = {
    "events": table(
        timestamp="long!", visitorid="int!", event="string!", itemid="int", transactionid="string"),
    "category_tree": table(categoryid="int!", parentid="int"),
    "item_props_1": _ITEM_PROPERTIES,
    "item_props_2": _ITEM_PROPERTIES,
}

# Column that must not be null, per table.
REQUIRED_KEYS = {
    "customers": "customer_id",
    "orders": "order_id",
    "order_items": "order_id",
    "payments": "order_id",
    "reviews": "review_id",
    "products": "product_id",
    "sellers": "seller_id",
    "events": "visitorid",
}

# File names of the two raw data sets.
ORDER_FILES = {
    "customers": "olist_customers_dataset.csv",
    "orders": "olist_orders_dataset.csv",
    "order_items": "olist_order_items_dataset.csv",
    "payments": "olist_order_payments_dataset.csv",
    "reviews": "olist_order_reviews_dataset.csv",
    "products": "olist_products_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
    "geo": "olist_geolocation_dataset.csv",
    "category": "product_category_name_translation.csv",
}
CLICK_FILES = {
    "events": "events.csv",
    "category_tree": "category_tree.csv",
    "item_props_1": "item_properties_part1.csv",
    "item_props_2": "item_properties_part2.csv",
}

# Rows of the scoring stream: customer keys, then the model inputs as double.
STREAM_EVENT = table(
    customer_unique_id="string!", event_timestamp="timestamp", event_type="string", item_id="int",
    price="double", customer_state="string", primary_payment_type="string", recency_days="double",
    frequency="double", monetary="double", avg_order_value="double", avg_review_score="double",
    std_review_score="double", min_review_score="double", avg_installments="double",
    total_freight="double", avg_freight_ratio="double", weekend_purchase_ratio="double",
    avg_purchase_hour="double", avg_categories_per_order="double", avg_delivery_delay="double",
    max_delivery_delay="double", avg_items_per_order="double", total_items_purchased="double",
    spend_trend="double", high_value_customer="double", is_repeat_buyer="double")
