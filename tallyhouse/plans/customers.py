"""Segmentation, cohorts, retention and repeat purchases, all per person.

``customer_months`` reduces the fact to at most one row per person and calendar month.
Every cohort report is a grouping of that relation, without joining the fact to itself.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window as W, functions as F

from tallyhouse.functions.columns import (
    date_of,
    mean_money,
    money_sum,
    month_label,
    month_of,
    months_between_keys,
    ratio,
)
from tallyhouse.operators.ranking import asc, desc
from tallyhouse.operators.selection import add_tiles
from tallyhouse.plans.views import Star, delivered


def _persons(star: Star) -> DataFrame:
    return star["dim_customers"].select("customer_key", "customer_unique_id")


def customer_months(star: Star) -> DataFrame:
    """(person, order_month, revenue, first_month) of delivered, dated items.

    The window's groups hold at most one row per calendar month.
    """
    per_key = (
        delivered(star, dated=True)
        .groupBy("customer_key", month_of("date_key").alias("order_month"))
        .agg(money_sum("price").alias("revenue"))
    )
    months = (
        per_key.join(_persons(star), "customer_key")
        .groupBy("customer_unique_id", "order_month")
        .agg(F.sum("revenue").alias("revenue"))
    )
    first = F.min("order_month").over(W.partitionBy("customer_unique_id"))
    return months.withColumn("first_month", first)


# ---- segmentation -----------------------------------------------------------------


def rfm_raw(star: Star, as_of: date | None = None) -> DataFrame:
    """Recency against the newest purchase of any status, distinct orders, spend."""
    newest = star["fact_orders"].agg(F.max("date_key").alias("date_key")).select(date_of("date_key")).scalar() if as_of is None else F.lit(as_of)
    per_key = (
        delivered(star, dated=True)
        .groupBy("customer_key")
        .agg(
            F.max("date_key").alias("last_key"),
            F.countDistinct("order_id").alias("orders"),
            money_sum("price").alias("spent"),
        )
    )
    per_person = (
        per_key.join(_persons(star), "customer_key")
        .groupBy("customer_unique_id")
        .agg(F.max("last_key").alias("last_key"), F.sum("orders").alias("frequency"), F.sum("spent").alias("monetary"))
    )
    return per_person.select(
        "customer_unique_id", F.date_diff(newest, date_of("last_key")).alias("recency"), "frequency", "monetary"
    )


# Names of the segments.
SEGMENTS = ("At Risk", "Champions", "Lost", "Loyal", "New", "Others")
SEGMENTS_AT_RISK = ("At Risk", "Lost")


def rfm_scored(star: Star, as_of: date | None = None) -> DataFrame:
    """Three quintiles, 5 is best, and the segment.

    Fixed values: segment names and their rules, tested in this order.
    """
    axes = {"r_score": desc("recency"), "f_score": asc("frequency"), "m_score": asc("monetary")}
    scored = add_tiles(rfm_raw(star, as_of), axes, 5, "customer_unique_id")
    r, f = F.col("r_score"), F.col("f_score")
    segment = (
        F.when((r >= 4) & (f >= 4), "Champions")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when(f >= 3, "Loyal")
        .when((r <= 2) & (f <= 2), "Lost")
        .when((r >= 4) & (f == 1), "New")
        .otherwise("Others")
    )
    return scored.withColumn("segment", segment)


def rfm_segmentation(star: Star, as_of: date | None = None) -> DataFrame:
    return (
        rfm_scored(star, as_of)
        .groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("nb_customers"),
            F.round(ratio(F.sum("monetary"), F.count("monetary")), 2).alias("avg_monetary"),
            F.round(ratio(F.sum("frequency"), F.count("frequency")), 2).alias("avg_frequency"),
        )
        .orderBy(F.desc("nb_customers"), "segment")
    )


def customer_quintiles(star: Star) -> DataFrame:
    """Spend per person and its fifth, biggest spenders in 1."""
    per_key = delivered(star).groupBy("customer_key").agg(money_sum("price").alias("spent"))
    totals = (
        per_key.join(_persons(star), "customer_key")
        .groupBy(F.col("customer_unique_id").alias("customer_id"))
        .agg(F.sum("spent").alias("total_spent"))
    )
    ranked = add_tiles(totals, {"quintile": desc("total_spent")}, 5, "customer_id")
    return ranked.orderBy(F.desc("total_spent"), "customer_id")


# ---- cohorts ------------------------------------------------------------------------


def _cohort_grid(star: Star, cohorts: int, months: int) -> DataFrame:
    """(cohort, month offset) counts and revenue of the earliest cohorts.

    The grid has at most months x months rows before the earliest cohorts are picked.
    """
    grid = (
        customer_months(star)
        .groupBy(
            F.col("first_month").alias("cohort_month"),
            months_between_keys("order_month", "first_month").alias("months_since_first"),
        )
        .agg(F.count(F.lit(1)).alias("nb_customers"), F.sum("revenue").alias("cohort_revenue"))
    )
    place = F.dense_rank().over(W.orderBy("cohort_month"))
    picked = grid.withColumn("_place", place).filter(F.col("_place") <= cohorts).drop("_place")
    return picked.filter(F.col("months_since_first").between(0, months - 1))


def cohorts_retention(star: Star, cohorts: int = 12, months: int = 12) -> DataFrame:
    grid = _cohort_grid(star, cohorts, months).drop("cohort_revenue")
    return grid.orderBy("cohort_month", "months_since_first")


def ltv_cohorts(star: Star, cohorts: int = 12, months: int = 12) -> DataFrame:
    """Cumulative revenue per cohort, and per customer of its month 0."""
    cohort = W.partitionBy("cohort_month")
    upto = cohort.orderBy("months_since_first").rowsBetween(W.unboundedPreceding, W.currentRow)
    size = F.max(F.when(F.col("months_since_first") == 0, F.col("nb_customers"))).over(cohort)
    return (
        _cohort_grid(star, cohorts, months)
        .withColumn("cumulative_revenue", F.sum("cohort_revenue").over(upto))
        .withColumn("ltv_per_customer", F.round(ratio(F.col("cumulative_revenue"), size), 2))
        .orderBy("cohort_month", "months_since_first")
    )


def new_vs_recurring(star: Star) -> DataFrame:
    """A customer is new in the month of the first order and recurring in any other."""
    first_time = F.col("order_month") == F.col("first_month")
    return (
        customer_months(star)
        .groupBy("order_month")
        .agg(
            F.count_if(first_time).alias("new_customers"),
            F.count_if(~first_time).alias("recurring"),
            F.count(F.lit(1)).alias("total"),
        )
        .select(
            month_label("order_month").alias("month_label"),
            "new_customers",
            "recurring",
            "total",
            F.round(ratio(F.col("new_customers") * 100, F.col("total")), 1).alias("new_pct"),
        )
        .orderBy("month_label")
    )


def new_vs_later(star: Star) -> DataFrame:
    """Same split, with recurring written as a month after the first."""
    months, first = F.col("order_month"), F.col("first_month")
    return (
        customer_months(star)
        .groupBy("order_month")
        .agg(F.count_if(months == first).alias("new_customers"), F.count_if(months > first).alias("recurring_customers"))
        .select(month_label("order_month").alias("month_label"), "new_customers", "recurring_customers")
        .orderBy("month_label")
    )


def first_month_flags(star: Star) -> DataFrame:
    is_first = (F.col("order_month") == F.col("first_month")).cast("int")
    return customer_months(star).select(
        F.col("customer_unique_id").alias("customer_id"), "order_month", is_first.alias("is_first_order")
    )


# ---- repeat purchases --------------------------------------------------------------


def _purchase_span(star: Star) -> DataFrame:
    """First and last delivered day per person."""
    per_key = (
        delivered(star, dated=True)
        .groupBy("customer_key")
        .agg(F.min("date_key").alias("first_key"), F.max("date_key").alias("last_key"))
    )
    return (
        per_key.join(_persons(star), "customer_key")
        .groupBy(F.col("customer_unique_id").alias("customer_id"))
        .agg(F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key"))
    )


def repeat_rate(star: Star) -> DataFrame:
    """Who bought again on a later day: the last day differs from the first."""
    span = _purchase_span(star).agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("last_key") > F.col("first_key")).alias("repeat_customers"),
    )
    rate = F.round(ratio(F.col("repeat_customers") * 100, F.col("total_customers")), 1)
    return span.withColumn("repeat_rate_pct", rate)


def inactive_customers(star: Star, as_of: date, days: int = 180) -> DataFrame:
    quiet = F.date_diff(F.lit(as_of), date_of("last_key"))
    idle = _purchase_span(star).select("customer_id", quiet.alias("days_since_last_order"))
    return idle.filter(F.col("days_since_last_order") > days)


def customers_with_orders(star: Star, minimum: int = 2) -> DataFrame:
    per_key = delivered(star).groupBy("customer_key").agg(F.countDistinct("order_id").alias("orders"))
    return (
        per_key.join(_persons(star), "customer_key")
        .groupBy(F.col("customer_unique_id").alias("customer_id"))
        .agg(F.sum("orders").alias("nb_orders"))
        .filter(F.col("nb_orders") >= minimum)
        .orderBy(F.desc("nb_orders"), "customer_id")
    )


def mean_price_per_customer(star: Star) -> DataFrame:
    """Every customer key, null without items."""
    means = star["fact_orders"].groupBy("customer_key").agg(mean_money("price").alias("avg_order"))
    return _persons(star).join(means, "customer_key", "left").select("customer_unique_id", "avg_order")


def orders_per_customer(star: Star) -> DataFrame:
    """Every customer key, zero without orders."""
    counts = star["fact_orders"].groupBy("customer_key").agg(F.countDistinct("order_id").alias("n"))
    return (
        _persons(star)
        .join(counts, "customer_key", "left")
        .select(F.col("customer_unique_id").alias("customer_id"), F.coalesce("n", F.lit(0)).alias("nb_orders"))
    )


def extreme_customers(star: Star, above: float = 1000, below: float = 100) -> DataFrame:
    """Union of the two branches over one aggregate, read once: a row in both appears twice."""
    totals = star["fact_orders"].groupBy("customer_key").agg(money_sum("price").alias("total"))
    high, low = F.when(F.col("total") > above, "high"), F.when(F.col("total") < below, "low")
    branches = totals.withColumn("branch", F.explode(F.array_compact(F.array(high, low))))
    return branches.select("customer_key", "total")


def next_purchase(star: Star) -> DataFrame:
    """Each item with the date of its customer's next row in date order.

    Rows are numbered inside (customer, day): all but the last are followed by another of the same
    day, the last by the customer's next day. A customer has at most one row per calendar day in
    the window that finds it, and the day table meets the items on the partitioning that numbered them.
    """
    items = star["fact_orders"].filter("customer_key is not null and date_key is not null")
    day = W.partitionBy("customer_key", "date_key").orderBy(
        *[F.desc(c) for c in ("order_id", "order_item_id", "product_key", "seller_key", "price", "delivery_days")]
    )
    items = items.withColumn("_from_end", F.row_number().over(day))
    days = star["fact_orders"].filter("customer_key is not null and date_key is not null").select("customer_key", "date_key").distinct()
    days = days.withColumn("next_day", F.lead("date_key").over(W.partitionBy("customer_key").orderBy("date_key")))
    following = F.when(F.col("_from_end") == 1, F.col("next_day")).otherwise(F.col("date_key"))
    return items.join(days, ["customer_key", "date_key"]).select(
        "customer_key", "order_id", "order_item_id", "date_key", following.alias("next_date_key")
    )
