"""Revenue, baskets, categories and products.

Windows without PARTITION BY appear only over months, years or an already limited top-k:
relations with a bound that does not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from tallyhouse.functions.columns import (
    date_of,
    mean_money,
    month_of,
    money_sum,
    money_total,
    percent_change,
    ratio,
)
from tallyhouse.operators.groups import rank_within
from tallyhouse.operators.ranking import desc
from tallyhouse.plans.views import DELIVERED, Star, delivered, monthly_sales, with_category
from tallyhouse.schemas import MONTH


def by_month() -> WindowSpec:
    return W.orderBy("year", "month")


def mean_days(c: str) -> Column:
    """Average of fractional days over whole seconds, so the sum is exact."""
    return ratio(F.sum(F.rint(F.col(c) * 86400).cast("bigint")), F.count(c) * 86400)


def mean_score(c: str) -> Column:
    return ratio(F.sum(c), F.count(c))


# ---- dashboard ----------------------------------------------------------------


def overview_kpis(star: Star) -> DataFrame:
    """Delivered orders and revenue, review average over all items, delivery time of delivered ones."""
    fact = star["fact_orders"]
    done = F.col("order_status") == DELIVERED
    days = fact.withColumn("done_days", F.when(done, F.col("delivery_days")))
    return days.agg(
        F.countDistinct(F.when(done, F.col("order_id"))).alias("total_orders"),
        money_total(F.when(done, F.col("price"))).alias("total_revenue"),
        F.round(mean_score("review_score"), 2).alias("avg_review"),
        F.round(mean_days("done_days"), 1).alias("avg_delivery_days"),
    )


def monthly_revenue(star: Star) -> DataFrame:
    return monthly_sales(star).select("year", "month", "month_label", "monthly_revenue").orderBy("year", "month")


def trends_monthly(star: Star) -> DataFrame:
    before = F.lag("monthly_revenue").over(by_month())
    return (
        monthly_sales(star)
        .select(
            "month_label",
            "monthly_revenue",
            "monthly_orders",
            percent_change(F.col("monthly_revenue"), before).alias("growth_pct"),
            F.sum("monthly_revenue").over(by_month()).alias("running_total"),
        )
        .orderBy("month_label")
    )


def basket_avg(star: Star) -> DataFrame:
    months = monthly_sales(star).orderBy("year", "month")
    return months.select("month_label", "monthly_revenue", "monthly_orders", "avg_basket")


def yearly_revenue(star: Star) -> DataFrame:
    """Orders are the sum of monthly counts, so an order is counted in the month it was bought."""
    annual = (
        monthly_sales(star)
        .groupBy("year")
        .agg(F.sum("monthly_revenue").alias("annual_revenue"), F.sum("monthly_orders").alias("annual_orders"))
        .withColumn("prev_revenue", F.lag("annual_revenue").over(W.orderBy("year")))
    )
    growth = percent_change(F.col("annual_revenue"), F.col("prev_revenue"))
    return annual.withColumn("yoy_growth_pct", growth).orderBy("year")


def top_categories(star: Star, limit: int = 10) -> DataFrame:
    """Best categories by delivered revenue; items without a product count as ``Unknown``."""
    best = (
        with_category(star, delivered(star))
        .groupBy(F.col("product_category").alias("category_name"))
        .agg(
            money_sum("price").alias("total_revenue"),
            F.countDistinct("order_id").alias("nb_orders"),
            F.round(mean_money("price"), 2).alias("avg_price"),
        )
        .orderBy(F.desc("total_revenue"), "category_name")
        .limit(limit)
    )
    place = F.row_number().over(W.orderBy(F.desc("total_revenue"), "category_name"))
    return best.select(place.alias("product_rank"), *best.columns).orderBy("product_rank")


# ---- exercises ------------------------------------------------------------------


def delivered_items_of_year(star: Star, year: int = 2017) -> DataFrame:
    """Items of one year, dearest first."""
    items = within_days(delivered(star), year * 10000 + 101, year * 10000 + 1231)
    return items.select("order_id", date_of("date_key").alias("order_date"), "price").orderBy(
        F.desc("price"), "order_id"
    )


def top_categories_with_product(star: Star, limit: int = 5) -> DataFrame:
    """Inner join: items without a product are left out. Products are summed before the join."""
    per_product = delivered(star).groupBy("product_key").agg(money_sum("price").alias("revenue"))
    category = F.coalesce("category_name_en", "category_name_pt", F.lit("Unknown"))
    return (
        per_product.join(star["dim_products"].select("product_key", category.alias("category")), "product_key")
        .groupBy("category")
        .agg(F.sum("revenue").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "category")
        .limit(limit)
    )


def _by_state(fact: DataFrame, star: Star) -> DataFrame:
    """Revenue and orders per customer state; an order has one customer, so counts add up."""
    per_customer = fact.groupBy("customer_key").agg(
        money_sum("price").alias("revenue"), F.countDistinct("order_id").alias("orders")
    )
    return (
        per_customer.join(star["dim_customers"].select("customer_key", "state"), "customer_key")
        .groupBy("state")
        .agg(F.sum("revenue").alias("total_revenue"), F.sum("orders").alias("nb_orders"))
    )


def revenue_by_state(star: Star) -> DataFrame:
    return _by_state(star["fact_orders"], star).orderBy(F.desc("total_revenue"), "state")


def states_over(star: Star, min_orders: int = 100) -> DataFrame:
    """States with more delivered orders than the minimum."""
    states = _by_state(delivered(star), star).filter(F.col("nb_orders") > min_orders)
    return states.select("state", F.col("nb_orders").alias("nb"))


def revenue_vs_rows_back(star: Star, rows: int = 12) -> DataFrame:
    """Against the month ``rows`` rows earlier (rows, not calendar months)."""
    before = F.lag("monthly_revenue", rows).over(by_month())
    now = F.col("monthly_revenue")
    return (
        monthly_sales(star)
        .select(
            "year",
            "month",
            now.alias("revenue"),
            before.alias("revenue_previous_year"),
            (ratio(now - before, before) * 100).alias("yoy_growth_pct"),
        )
        .orderBy("year", "month")
    )


def running_revenue(star: Star) -> DataFrame:
    upto = by_month().rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        monthly_sales(star)
        .select(
            F.col("month_label").alias("month"),
            "monthly_revenue",
            F.sum("monthly_revenue").over(upto).alias("cumulative_revenue"),
        )
        .orderBy("month")
    )


def month_over_month(star: Star) -> DataFrame:
    before = F.lag("monthly_revenue", 1).over(by_month())
    now = F.col("monthly_revenue")
    return (
        monthly_sales(star)
        .select(
            F.col("month_label").alias("month"),
            now.alias("revenue"),
            before.alias("prev_month"),
            (ratio(now - before, before) * 100).alias("growth_pct"),
        )
        .orderBy("month")
    )


def product_revenue(star: Star) -> DataFrame:
    """Delivered revenue per product of the dimension, summed before the join."""
    per_product = delivered(star).groupBy("product_key").agg(money_sum("price").alias("revenue"))
    category = F.coalesce("category_name_en", "category_name_pt", F.lit("Unknown"))
    products = star["dim_products"].select("product_key", "product_id", category.alias("category"))
    return per_product.join(products, "product_key").select("product_id", "category", "revenue")


def top_products_share(star: Star, limit: int = 10) -> DataFrame:
    """Best products as a share of the revenue of all statuses."""
    total = star["fact_orders"].agg(money_total("price")).scalar()
    best = product_revenue(star).orderBy(F.desc("revenue"), "product_id").limit(limit)
    share = ratio(F.col("revenue") * 100, total).alias("pct_of_total")
    return best.select("product_id", "revenue", share).orderBy(F.desc("revenue"), "product_id")


# ---- course -----------------------------------------------------------------------


def rank_in_category(star: Star) -> DataFrame:
    """All products ranked by revenue inside their category, equal revenue sharing a rank."""
    ranked = rank_within(product_revenue(star), ["category"], desc("revenue"), "rank_in_category")
    return ranked.select("category", "product_id", "revenue", "rank_in_category")


def top_products_per_category(star: Star, k: int = 3) -> DataFrame:
    """``row_number <= k`` lets Spark keep k rows per category and task before the shuffle."""
    place = F.row_number().over(W.partitionBy("category").orderBy(F.desc("revenue"), "product_id"))
    ranked = product_revenue(star).withColumn("rank", place).filter(F.col("rank") <= k)
    return ranked.select("category", "product_id", "revenue", "rank")


def items_and_orders(star: Star) -> DataFrame:
    return star["fact_orders"].agg(
        F.count(F.lit(1)).alias("total_items"), F.countDistinct("order_id").alias("total_orders")
    )


def delivered_item_count(star: Star) -> DataFrame:
    return delivered(star).agg(F.count(F.lit(1)).alias("nb_items"))


def latest_rows(star: Star, columns: list[str] | None = None, limit: int = 1000) -> DataFrame:
    """Newest rows by purchase date; only the asked columns and the sort keys are read."""
    ties = ["order_id", "order_item_id", "product_key", "seller_key", "price"]
    rows = star["fact_orders"].orderBy(F.desc_nulls_last("date_key"), *ties).limit(limit)
    return rows.select(*columns) if columns else rows


def items_with_status_mean(star: Star, limit: int | None = None) -> DataFrame:
    """Each item next to the mean price of its status.

    Cleaning admits a fixed list of statuses, so the averages always fit a broadcast.
    """
    fact = star["fact_orders"]
    mean = ratio(money_total("price"), F.count("price"))
    means = fact.groupBy("order_status").agg(mean.alias("avg_status_value"))
    items = fact.select("order_id", "order_item_id", "order_status", "price")
    if limit is not None:
        items = items.orderBy("order_id", "order_item_id", "price").limit(limit)
    joined = items.join(F.broadcast(means), "order_status", "left")
    return joined.select("order_id", "price", "avg_status_value")


def first_delivered_rows(star: Star, limit: int = 10) -> DataFrame:
    rows = delivered(star).orderBy(F.asc_nulls_first("date_key"), "order_id", "price").limit(limit)
    return rows.select("order_id", "date_key", "price")


def status_revenue(star: Star, status: str = DELIVERED) -> DataFrame:
    chosen = star["fact_orders"].filter(F.col("order_status") == status)
    return chosen.groupBy("order_status").agg(money_total("price").alias("revenue"))


def rows_with_month_total(star: Star) -> DataFrame:
    """Every row with its month's revenue. A window would put a whole month into one task;
    the totals have one row per calendar month and are broadcast instead."""
    rows = star["fact_orders"].filter("date_key is not null").select(
        "order_id", "order_item_id", month_of("date_key").alias("month"), "price"
    )
    totals = rows.groupBy("month").agg(money_sum("price").alias("monthly_total"))
    return rows.join(F.broadcast(totals), "month")


def score_band(score: Column) -> Column:
    """Thresholds and names of the bands, tested from the top."""
    return F.when(score >= 80, "Premium").when(score >= 50, "Standard").otherwise("At Risk")


def items_per_score_band(star: Star) -> DataFrame:
    """Review scores on a 0-100 scale, items and revenue per band."""
    banded = star["fact_orders"].withColumn("segment", score_band(F.col("review_score") * 20))
    return banded.groupBy("segment").agg(F.count(F.lit(1)).alias("nb_items"), money_total("price").alias("revenue"))


def within_days(fact: DataFrame, first_key: int, last_key: int | None = None) -> DataFrame:
    """Rows of a range of days on the integer date key.

    A published fact is stored by month, so its files of other months are not even listed for reading.
    """
    chosen = F.col("date_key") >= first_key
    if last_key is not None:
        chosen = F.col("date_key").between(first_key, last_key)
    if MONTH in fact.columns:
        month = F.col(MONTH)
        chosen = chosen & (month >= first_key // 100 if last_key is None else month.between(first_key // 100, last_key // 100))
    return fact.filter(chosen)


def rows_between_days(star: Star, first_key: int, last_key: int | None = None) -> DataFrame:
    """Rows of one day (both keys equal) or from a day on."""
    return within_days(star["fact_orders"], first_key, last_key)
