"""The three views every report starts from, and parametrised SQL over them.

Calendar fields come from the integer date key itself. A published snapshot has checked
that every key has its day in ``dim_dates``, so the join would add nothing but a shuffle
or a broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.functions.columns import date_of, money_sum, month_label, month_of, ratio

Star = Mapping[str, DataFrame]
DELIVERED = "delivered"


def delivered(star: Star, dated: bool = False) -> DataFrame:
    fact = star["fact_orders"].filter(F.col("order_status") == DELIVERED)
    return fact.filter(F.col("date_key").isNotNull()) if dated else fact


def monthly_sales(star: Star) -> DataFrame:
    """Per month of delivered items: revenue, distinct orders, average basket."""
    monthly = (
        delivered(star, dated=True)
        .groupBy(month_of("date_key").alias("ym"))
        .agg(money_sum("price").alias("monthly_revenue"), F.countDistinct("order_id").alias("monthly_orders"))
    )
    return monthly.select(
        F.floor(F.col("ym") / 100).cast("int").alias("year"),
        (F.col("ym") % 100).alias("month"),
        month_label("ym").alias("month_label"),
        "monthly_revenue",
        "monthly_orders",
        F.round(ratio(F.col("monthly_revenue"), F.col("monthly_orders")), 2).alias("avg_basket"),
    )


def customer_cohorts(star: Star) -> DataFrame:
    """Per person: first purchase month, distinct orders, spend (delivered and dated).

    An order has one customer key, so orders are counted per key before the person is joined.
    """
    per_key = (
        delivered(star, dated=True)
        .groupBy("customer_key")
        .agg(
            F.min(month_of("date_key")).alias("first_month"),
            F.countDistinct("order_id").alias("orders"),
            money_sum("price").alias("spent"),
        )
    )
    return (
        per_key.join(star["dim_customers"].select("customer_key", "customer_unique_id"), "customer_key")
        .groupBy("customer_unique_id")
        .agg(
            F.min("first_month").alias("first_month"),
            F.sum("orders").alias("total_orders"),
            F.sum("spent").alias("total_spent"),
        )
        .withColumn("first_month_label", month_label("first_month"))
    )


def with_category(star: Star, fact: DataFrame) -> DataFrame:
    """Fact rows with their English, else original, category; ``Unknown`` without a product."""
    category = F.coalesce("category_name_en", "category_name_pt")
    products = star["dim_products"].select("product_key", category.alias("product_category"))
    return fact.join(products, "product_key", "left").fillna("Unknown", ["product_category"])


def orders_enriched(star: Star) -> DataFrame:
    """Every fact row with its calendar, customer and product attributes."""
    fact, day = star["fact_orders"], F.col("full_date")
    customers = star["dim_customers"].select(
        "customer_key", "customer_unique_id", F.col("city").alias("customer_city"), F.col("state").alias("customer_state")
    )
    return (
        with_category(star, fact.withColumn("full_date", date_of("date_key")))
        .join(customers, "customer_key", "left")
        .select(
            "order_id",
            "order_item_id",
            "order_status",
            day.alias("order_date"),
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.date_format(day, "EEEE").alias("day_name"),
            (F.weekday(day) >= 5).cast("int").alias("is_weekend"),
            "customer_unique_id",
            "customer_city",
            "customer_state",
            "product_category",
            "price",
            "freight_value",
            "review_score",
            "delivery_days",
            "delivery_delta_days",
        )
    )


VIEWS = {
    "v_monthly_sales": monthly_sales,
    "v_customer_cohorts": customer_cohorts,
    "v_orders_enriched": orders_enriched,
}


def register_views(star: Star) -> None:
    """Tables and views under their names, for ``query``; safe to repeat."""
    for name, df in star.items():
        df.createOrReplaceTempView(name)
    for name, view in VIEWS.items():
        view(star).createOrReplaceTempView(name)


def query(spark: SparkSession, sql: str, params: Sequence | Mapping | None = None) -> DataFrame:
    """Ad-hoc SQL with bound parameters: ``?`` markers with a list, ``:name`` with a mapping."""
    return spark.sql(sql, args=params)


def query_from_file(spark: SparkSession, path: str, params: Sequence | Mapping | None = None) -> tuple[str, DataFrame]:
    sql = Path(path).read_text(encoding="utf-8")
    return sql, query(spark, sql, params)
