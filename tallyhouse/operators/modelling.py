"""From cleaned datasets to the star schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tallyhouse.functions.columns import date_key, days_between, money_sum
from tallyhouse.operators.groups import latest_per_group
from tallyhouse.operators.ranking import Ranking, asc, rank_all
from tallyhouse.operators.staging import at_once, stage
from tallyhouse.schemas import ORDER_TIMESTAMPS, PAYMENT_TYPES, STAR

DIMENSION_ORDER = ("dim_dates", "dim_geolocation", "dim_customers", "dim_sellers", "dim_products")


def surrogate_key(df: DataFrame, name: str, natural_key: str) -> DataFrame:
    """Dense key from 1 in the order of the natural key, so a rebuild gives the same keys."""
    keyed = rank_all(df, Ranking(order=[asc(natural_key)], row_number=name))
    return keyed.select(name, *df.columns)


# ---- dimensions -----------------------------------------------------------------


def build_dim_dates(orders: DataFrame) -> DataFrame:
    """One row per day that occurs in any of the order timestamps."""
    stamps = [F.to_date(c) for c in ORDER_TIMESTAMPS if c in orders.columns]
    days = orders.select(F.explode(F.array(*stamps)).alias("full_date")).filter("full_date is not null").distinct()
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"),
        "full_date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.day(d).alias("day"),
        F.weekday(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (F.weekday(d) >= 5).cast("int").alias("is_weekend"),
    )


def build_dim_geolocation(geo: DataFrame) -> DataFrame:
    renamed = geo.select(
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.col("geolocation_lat").alias("lat"),
        F.col("geolocation_lng").alias("lng"),
        F.col("geolocation_city").alias("city"),
        F.col("geolocation_state").alias("state"),
    )
    return surrogate_key(renamed, "geo_key", "zip_code_prefix")


def _with_geo_key(df: DataFrame, zip_column: str, dim_geo: DataFrame) -> DataFrame:
    lookup = dim_geo.select(F.col("zip_code_prefix").alias(zip_column), "geo_key")
    return df.join(lookup, zip_column, "left")


def build_dim_customers(customers: DataFrame, dim_geo: DataFrame) -> DataFrame:
    located = _with_geo_key(customers, "customer_zip_code_prefix", dim_geo).select(
        "customer_id",
        "customer_unique_id",
        "geo_key",
        F.col("customer_city").alias("city"),
        F.col("customer_state").alias("state"),
    )
    return surrogate_key(located, "customer_key", "customer_id")


def build_dim_sellers(sellers: DataFrame, dim_geo: DataFrame) -> DataFrame:
    located = _with_geo_key(sellers, "seller_zip_code_prefix", dim_geo).select(
        "seller_id", "geo_key", F.col("seller_city").alias("city"), F.col("seller_state").alias("state")
    )
    return surrogate_key(located, "seller_key", "seller_id")


def build_dim_products(products: DataFrame) -> DataFrame:
    renamed = products.select(
        "product_id",
        F.col("product_category_name").alias("category_name_pt"),
        F.col("product_category_name_english").alias("category_name_en"),
        F.col("product_weight_g").alias("weight_g"),
        F.col("product_length_cm").alias("length_cm"),
        F.col("product_height_cm").alias("height_cm"),
        F.col("product_width_cm").alias("width_cm"),
        F.col("product_photos_qty").alias("photos_qty"),
    )
    return surrogate_key(renamed, "product_key", "product_id")


# ---- fact -------------------------------------------------------------------------


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Total paid and most frequent payment type, ties to the smallest name.

    Cleaned payments have a type of ``PAYMENT_TYPES``, so an order is one row of a sum and a count per
    type, summed in the tasks before the one exchange.
    """
    types = sorted(PAYMENT_TYPES)
    of = {t: f"_n{k}" for k, t in enumerate(types)}
    counted = payments.groupBy("order_id").agg(
        money_sum("payment_value").cast("double").alias("order_payment_total"), *[F.count_if(F.col("payment_type") == t).alias(n) for t, n in of.items()]
    )
    most, dominant = F.greatest(*of.values()), F.lit("not_defined")
    for t in reversed(types):
        dominant = F.when((F.col(of[t]) > 0) & (F.col(of[t]) == most), t).otherwise(dominant)
    return counted.select("order_id", "order_payment_total", dominant.alias("payment_type"))


def latest_review_per_order(reviews: DataFrame) -> DataFrame:
    newest = ["review_creation_date", "review_answer_timestamp", "review_id"]
    return latest_per_group(reviews, ["order_id"], newest, ["review_score"])


def known_orders(orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Orders with their customer's keys and their days."""
    customer = dim_customers.select("customer_id", "customer_key", F.col("geo_key").alias("customer_geo_key"))
    bought, received = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    return orders.join(customer, "customer_id", "left").select(
        "order_id",
        "order_status",
        "customer_key",
        "customer_geo_key",
        date_key(bought).alias("date_key"),
        days_between(received, bought).alias("delivery_days"),
        days_between("order_estimated_delivery_date", bought).alias("estimated_days"),
    )


def order_facts(
    orders: DataFrame, payments: DataFrame, reviews: DataFrame, dim_customers: DataFrame
) -> DataFrame:
    """Everything known per order, one row per order id seen in any of the three sources.

    The full joins keep payments and reviews of orders that cleaning dropped.
    """
    known = known_orders(orders, dim_customers)
    return known.join(payments_per_order(payments), "order_id", "full_outer").join(
        latest_review_per_order(reviews), "order_id", "full_outer"
    )


def build_fact_orders(
    order_items: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    dim_customers: DataFrame,
    dim_sellers: DataFrame,
    dim_products: DataFrame,
) -> DataFrame:
    """One row per order item; keys that do not resolve stay null.

    The items are dealt by order once, and the three left joins by order keep that; payments and
    reviews of orders that cleaning dropped still meet their items. Sellers and products come first: where
    they are too large to broadcast, narrow items are dealt by them and by order again, and the wide rows
    leave with the items of an order next to each other, which compress well.
    """
    seller = dim_sellers.select("seller_id", "seller_key", F.col("geo_key").alias("seller_geo_key"))
    product = dim_products.select("product_id", "product_key")
    fact = (
        order_items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
        .join(seller, "seller_id", "left")
        .join(product, "product_id", "left")
        .drop("seller_id", "product_id")
        .join(known_orders(orders, dim_customers), "order_id", "left")
        .join(payments_per_order(payments), "order_id", "left")
        .join(latest_review_per_order(reviews), "order_id", "left")
        .withColumn("delivery_delta_days", F.col("delivery_days") - F.col("estimated_days"))
    )
    return fact.select([c for c in STAR["fact_orders"].names if c != "fact_key"])


def build_dimensions(clean: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The geography first, as others take its keys; the rest is numbered at once."""
    geo = build_dim_geolocation(clean["geolocation"])
    customers, sellers, products = at_once([
        lambda: build_dim_customers(clean["customers"], geo),
        lambda: build_dim_sellers(clean["sellers"], geo),
        lambda: build_dim_products(clean["products"]),
    ])
    return {"dim_dates": build_dim_dates(clean["orders"]), "dim_geolocation": geo, "dim_customers": customers, "dim_sellers": sellers, "dim_products": products}


def hold_orders(clean: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Stage the cleaned orders: they feed the calendar, the fact and its checks, so their deduplication runs once."""
    return {**clean, "orders": stage(clean["orders"], "orders")}


def build_star(clean: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All six tables; the fact gets its ``fact_key`` when it is written."""
    star = build_dimensions(clean)
    star["fact_orders"] = build_fact_orders(
        clean["order_items"],
        clean["orders"],
        clean["order_payments"],
        clean["order_reviews"],
        star["dim_customers"],
        star["dim_sellers"],
        star["dim_products"],
    )
    return star
