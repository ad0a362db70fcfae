"""Fixed schemas: nine raw datasets and the six tables of the star schema.

Ids and zip prefixes are read as strings so that no leading zero is lost, and raw
timestamps are read as strings because cleaning turns bad values into nulls.
"""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
}


def _struct(columns: str) -> T.StructType:
    """From ``name type, name type``; needs no running session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


RAW = {
    "customers": _struct(
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string,"
        " customer_city string, customer_state string"
    ),
    "geolocation": _struct(
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double,"
        " geolocation_city string, geolocation_state string"
    ),
    "orders": _struct(
        "order_id string, customer_id string, order_status string, order_purchase_timestamp string,"
        " order_approved_at string, order_delivered_carrier_date string,"
        " order_delivered_customer_date string, order_estimated_delivery_date string"
    ),
    "order_items": _struct(
        "order_id string, order_item_id int, product_id string, seller_id string,"
        " shipping_limit_date string, price double, freight_value double"
    ),
    "order_payments": _struct(
        "order_id string, payment_sequential int, payment_type string, payment_installments int,"
        " payment_value double"
    ),
    "order_reviews": _struct(
        "review_id string, order_id string, review_score int, review_comment_title string,"
        " review_comment_message string, review_creation_date string, review_answer_timestamp string"
    ),
    "products": _struct(
        "product_id string, product_category_name string, product_name_lenght double,"
        " product_description_lenght double, product_photos_qty double, product_weight_g double,"
        " product_length_cm double, product_height_cm double, product_width_cm double"
    ),
    "sellers": _struct(
        "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"
    ),
    "category_translation": _struct(
        "product_category_name string, product_category_name_english string"
    ),
}

STAR = {
    "dim_dates": _struct(
        "date_key int, full_date date, year int, quarter int, month int, day int,"
        " day_of_week int, day_name string, is_weekend int"
    ),
    "dim_geolocation": _struct(
        "geo_key bigint, zip_code_prefix string, lat double, lng double, city string, state string"
    ),
    "dim_customers": _struct(
        "customer_key bigint, customer_id string, customer_unique_id string, geo_key bigint,"
        " city string, state string"
    ),
    "dim_sellers": _struct(
        "seller_key bigint, seller_id string, geo_key bigint, city string, state string"
    ),
    "dim_products": _struct(
        "product_key bigint, product_id string, category_name_pt string, category_name_en string,"
        " weight_g double, length_cm double, height_cm double, width_cm double, photos_qty double"  # an imputed median may be fractional
    ),
    "fact_orders": _struct(
        "fact_key bigint, order_id string, order_item_id int, date_key int, customer_key bigint,"
        " seller_key bigint, product_key bigint, customer_geo_key bigint, seller_geo_key bigint,"
        " order_status string, price double, freight_value double, order_payment_total double,"
        " payment_type string, review_score int, delivery_days double, estimated_days double,"
        " delivery_delta_days double"
    ),
}

ORDER_TIMESTAMPS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)

# The domains accepted by cleaning.
ORDER_STATUSES = (
    "approved",
    "canceled",
    "created",
    "delivered",
    "invoiced",
    "processing",
    "shipped",
    "unavailable",
)
PAYMENT_TYPES = ("boleto", "credit_card", "debit_card", "not_defined", "voucher")

# Last column of the published fact: the calendar month of date_key, by which its files are stored.
MONTH = "order_month"
