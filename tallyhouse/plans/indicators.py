"""Headline indicators computed from the report results.

Inputs are the small results of the other plans, at most a few rows per calendar month,
cohort or seller shown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallyhouse.functions.columns import month_label, ratio
from tallyhouse.plans.customers import SEGMENTS_AT_RISK

CURVE = [f"m{i}" for i in range(1, 12)]


def _first_best(label: str, value: str) -> Column:
    """Label of the highest value; ties go to the smallest label."""
    return F.min_by(label, F.struct(-F.col(value), label))


def _mean(c: str, digits: int) -> Column:
    """Average of an already rounded column over its exact decimal sum."""
    return ratio(F.sum(F.col(c).cast(f"decimal(18,{digits})")), F.count(c))


# ---- cohorts -----------------------------------------------------------------------


def retention_matrix(retention: DataFrame, min_size: int = 50) -> DataFrame:
    """Cohorts of at least ``min_size`` customers, months 1 to 11 in percent of month 0."""
    wide = retention.groupBy("cohort_month").pivot("months_since_first", list(range(12))).agg(F.sum("nb_customers"))
    kept = wide.filter(F.col("0") >= min_size)
    curve = [(ratio(F.col(str(i)), F.col("0")) * 100).alias(f"m{i}") for i in range(1, 12)]
    return kept.select("cohort_month", F.col("0").alias("cohort_size"), *curve).orderBy("cohort_month")


def retention_summary(retention: DataFrame, min_size: int = 50) -> DataFrame:
    """Mean retention in month 1, the best cohort and its retention."""
    ordered = retention_matrix(retention, min_size)
    rates = ordered.select("cohort_month", F.col("m1").cast("decimal(28,12)").alias("m1")).filter("m1 is not null")
    return rates.agg(
        ratio(F.sum("m1"), F.count("m1")).alias("mean_month1"),
        _first_best("cohort_month", "m1").alias("best_cohort"),
        F.max("m1").cast("double").alias("best_month1"),
    )


def cohort_sizes(retention: DataFrame, min_size: int = 50) -> DataFrame:
    first = retention.filter((F.col("months_since_first") == 0) & (F.col("nb_customers") >= min_size))
    return first.select("cohort_month", F.col("nb_customers").alias("customers")).orderBy("cohort_month")


# ---- customers ----------------------------------------------------------------------


def acquisition_summary(new_recurring: DataFrame, min_total: int = 50) -> DataFrame:
    months = new_recurring.filter(F.col("total") >= min_total)
    both = F.sum("new_customers") + F.sum("recurring")
    return months.agg(
        F.sum("new_customers").alias("new_customers"),
        F.sum("recurring").alias("recurring"),
        F.coalesce(ratio(F.sum("recurring") * 100, both), F.lit(0.0)).alias("recurring_pct"),
        _first_best("month_label", "new_customers").alias("peak_month"),
        F.max("new_customers").alias("peak_new"),
    )


def ltv_selection(ltv: DataFrame, min_size: int = 500, fallback: int = 6) -> DataFrame:
    """Curves of the cohorts of at least ``min_size`` customers, else of the largest few."""
    start = ltv.filter("months_since_first = 0").select("cohort_month", F.col("nb_customers").alias("size"))
    large = F.col("size") >= min_size
    place = F.row_number().over(W.orderBy(F.desc("size"), "cohort_month"))
    chosen = (
        start.withColumn("any_large", F.max(large).over(W.partitionBy()))
        .withColumn("place", place)
        .filter(large | (~F.col("any_large") & (F.col("place") <= fallback)))
    )
    lines = ltv.join(chosen.select("cohort_month"), "cohort_month", "left_semi")
    return lines.withColumn("cohort_label", month_label("cohort_month")).orderBy("cohort_month", "months_since_first")


def best_ltv(ltv: DataFrame, min_size: int = 500, fallback: int = 6) -> DataFrame:
    """Cohort with the highest last value of its curve."""
    last = (
        ltv_selection(ltv, min_size, fallback)
        .groupBy("cohort_label")
        .agg(F.max_by("ltv_per_customer", "months_since_first").alias("last_ltv"))
    )
    return last.agg(_first_best("cohort_label", "last_ltv").alias("best_cohort"), F.max("last_ltv").alias("best_ltv"))


def segment_summary(rfm: DataFrame) -> DataFrame:
    """Dominant segment and its share, and the head count of segments at risk."""
    at_risk = F.col("segment").isin(*SEGMENTS_AT_RISK)
    return rfm.agg(
        _first_best("segment", "nb_customers").alias("dominant_segment"),
        F.max("nb_customers").alias("dominant_customers"),
        ratio(F.max("nb_customers") * 100, F.sum("nb_customers")).alias("dominant_pct"),
        F.coalesce(F.sum(F.when(at_risk, F.col("nb_customers"))), F.lit(0)).alias("at_risk_customers"),
    )


# ---- sales ---------------------------------------------------------------------------


def trend_summary(trends: DataFrame, min_revenue: float = 10_000, rising_above: float = 5) -> DataFrame:
    """Mean growth capped to +-100, last cumulative revenue, rising or stable."""
    months = trends.filter(F.col("monthly_revenue") >= min_revenue)
    growth = F.col("growth_pct")
    capped = F.when(growth < -100, -100.0).when(growth > 100, 100.0).otherwise(growth)
    one = months.withColumn("capped", capped).agg(
        F.count(F.lit(1)).alias("months"),
        F.max_by("running_total", "month_label").alias("last_total"),
        F.coalesce(_mean("capped", 1), F.lit(0.0)).alias("mean_growth"),
    )
    return one.withColumn("trend", F.when(F.col("mean_growth") > rising_above, "rising").otherwise("stable"))


def basket_summary(basket: DataFrame, min_orders: int = 100) -> DataFrame:
    months = basket.filter(F.col("monthly_orders") >= min_orders)
    return months.agg(
        _mean("avg_basket", 2).alias("mean_basket"),
        _first_best("month_label", "avg_basket").alias("best_month"),
        F.max("avg_basket").alias("best_basket"),
    )


def satisfaction(kpis: DataFrame) -> DataFrame:
    """Thresholds and the three labels."""
    score = F.col("avg_review")
    band = F.when(score >= 4.0, "excellente").when(score >= 3.0, "correcte").otherwise("a ameliorer")
    return kpis.select("total_orders", "total_revenue", "avg_review", "avg_delivery_days", band.alias("satisfaction"))


def month_summary(months: DataFrame) -> DataFrame:
    """Best and last month by revenue."""
    return months.agg(
        _first_best("month_label", "monthly_revenue").alias("best_month"),
        F.max("monthly_revenue").alias("best_revenue"),
        F.max("month_label").alias("last_month"),
        F.max_by("monthly_revenue", "month_label").alias("last_revenue"),
    )


def category_concentration(top: DataFrame) -> DataFrame:
    """Revenue of the first, the first three and all shown categories."""
    place, revenue = F.col("product_rank"), F.col("total_revenue")
    top3 = F.sum(F.when(place <= 3, revenue))
    return top.agg(
        F.min_by("category_name", "product_rank").alias("top_category"),
        F.sum(F.when(place == 1, revenue)).alias("top1_revenue"),
        top3.alias("top3_revenue"),
        F.sum(revenue).alias("top10_revenue"),
        ratio(top3 * 100, F.sum(revenue)).alias("top3_pct"),
    )


def year_summary(years: DataFrame) -> DataFrame:
    """Best year and the latest known growth."""
    known = F.when(F.col("yoy_growth_pct").isNotNull(), F.col("year"))
    return years.agg(
        _first_best("year", "annual_revenue").alias("best_year"),
        F.max("annual_revenue").alias("best_revenue"),
        F.max_by("yoy_growth_pct", known).alias("latest_yoy_pct"),
    )


# ---- sellers -------------------------------------------------------------------------


def pareto_threshold(curve: DataFrame, share: float = 80.0) -> DataFrame:
    """First rank whose cumulative share reaches ``share``, and its part of the sellers given.

    Pass the curve of all sellers for the true share, or the shown top-k for the displayed one.
    """
    one = curve.agg(
        F.min(F.when(F.col("cumulative_pct") >= share, F.col("seller_rank"))).alias("threshold_rank"),
        F.count(F.lit(1)).alias("sellers"),
        F.max("cumulative_pct").alias("last_pct"),
    )
    return one.withColumn("pct_sellers", ratio(F.col("threshold_rank") * 100, F.col("sellers")))


# Axis labels in the order of the score columns.
AXIS_LABELS = ("Revenue", "Volume", "Avis", "Livraison", "Ponctualite")
AXIS_COLUMNS = ("revenue_score", "volume_score", "review_score_ntile", "delivery_score", "ontime_score")


def seller_profile(scoring: DataFrame) -> DataFrame:
    """The best seller with the strongest and weakest axis, the first one on ties."""
    labels, scores = F.array(*[F.lit(x) for x in AXIS_LABELS]), F.array(*AXIS_COLUMNS)

    def axis(value: Column) -> Column:
        return F.element_at(labels, F.array_position(scores, value).cast("int"))

    best = scoring.orderBy("seller_rank", "seller_id").limit(1)
    return best.select(
        "seller_id",
        "total_score",
        axis(F.greatest(*AXIS_COLUMNS)).alias("strongest_axis"),
        axis(F.least(*AXIS_COLUMNS)).alias("weakest_axis"),
    )


def seller_radar(scoring: DataFrame, limit: int = 5) -> DataFrame:
    best = scoring.orderBy("seller_rank", "seller_id").limit(limit)
    return best.select("seller_rank", "seller_city", *AXIS_COLUMNS)


def seller_table(scoring: DataFrame, limit: int = 20) -> DataFrame:
    best = scoring.orderBy("seller_rank", "seller_id").limit(limit)
    return best.select(
        "seller_rank",
        "seller_city",
        "seller_state",
        "total_revenue",
        "nb_orders",
        "avg_review",
        "avg_delivery_days",
        "on_time_pct",
        "total_score",
    )
