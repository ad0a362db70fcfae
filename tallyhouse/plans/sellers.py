"""Seller concentration and scoring. Items are summed per seller key before any join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tallyhouse.functions.columns import money_sum, ratio
from tallyhouse.operators.ranking import Ranking, asc, desc, rank_all
from tallyhouse.operators.selection import add_tiles
from tallyhouse.plans.sales import mean_days, mean_score
from tallyhouse.plans.views import Star, delivered

BEST_FIRST = (desc("total_revenue"), asc("seller_id"))


def seller_revenue(star: Star) -> DataFrame:
    """Sellers with positive delivered revenue."""
    per_key = delivered(star).groupBy("seller_key").agg(money_sum("price").alias("total_revenue"))
    sellers = star["dim_sellers"].select(
        "seller_key", "seller_id", F.col("city").alias("seller_city"), F.col("state").alias("seller_state")
    )
    joined = per_key.filter("total_revenue > 0").join(sellers, "seller_key")
    return joined.select("seller_id", "seller_city", "seller_state", "total_revenue")


def pareto_sellers(star: Star, limit: int = 100) -> DataFrame:
    """The ``limit`` best sellers with cumulative share and 80/20 class.

    Every seller above a row of the top-k is in the top-k itself, so ranks and running sums
    of these rows need only the top-k plus two totals, not a sort of all sellers.
    Fixed values: the 80 percent limit and the two class names.
    """
    sellers = seller_revenue(star)
    totals = sellers.agg(F.struct(F.sum("total_revenue").alias("revenue"), F.count(F.lit(1)).alias("n"))).scalar()
    order = [k.order for k in BEST_FIRST]
    best = sellers.orderBy(*order).limit(limit)
    upto = W.orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = best.withColumns(
        {
            "seller_rank": F.row_number().over(W.orderBy(*order)),
            "cumulative_revenue": F.sum("total_revenue").over(upto),
            "_rank": F.rank().over(W.orderBy(order[0])),
        }
    )
    pct_rank = F.when(totals.getField("n") > 1, ratio(F.col("_rank") - 1, totals.getField("n") - 1)).otherwise(0.0)
    share = F.round(ratio(F.col("cumulative_revenue") * 100, totals.getField("revenue")), 2)
    return (
        ranked.withColumn("cumulative_pct", share)
        .withColumn("pct_rank", F.round(pct_rank, 4))
        .withColumn("pareto_group", F.when(F.col("cumulative_pct") <= 80, "80%").otherwise("20%"))
        .select(
            "seller_rank",
            "seller_id",
            "seller_city",
            "seller_state",
            "total_revenue",
            "cumulative_revenue",
            "cumulative_pct",
            "pct_rank",
            "pareto_group",
        )
        .orderBy("seller_rank")
    )


def pareto_curve(star: Star) -> DataFrame:
    """Rank and cumulative share of every seller."""
    want = Ranking(order=BEST_FIRST, row_number="seller_rank", running={"cumulative_revenue": "total_revenue"})
    ranked = rank_all(seller_revenue(star), want)
    total = ranked.agg(F.sum("total_revenue")).scalar()
    return ranked.withColumn("cumulative_pct", F.round(ratio(F.col("cumulative_revenue") * 100, total), 2))


def seller_metrics(star: Star) -> DataFrame:
    """Five delivered metrics per seller; a missing delay counts as late."""
    on_time = F.avg(F.when(F.col("delivery_delta_days") <= 0, 1.0).otherwise(0.0)) * 100
    per_key = (
        delivered(star)
        .groupBy("seller_key")
        .agg(
            money_sum("price").alias("total_revenue"),
            F.countDistinct("order_id").alias("nb_orders"),
            F.round(mean_score("review_score"), 2).alias("avg_review"),
            F.round(mean_days("delivery_days"), 1).alias("avg_delivery_days"),
            F.round(on_time, 1).alias("on_time_pct"),
        )
    )
    sellers = star["dim_sellers"].select(
        "seller_key", "seller_id", F.col("city").alias("seller_city"), F.col("state").alias("seller_state")
    )
    return per_key.join(sellers, "seller_key").drop("seller_key")


# score column -> metric in the order from the worst seller to the best
AXES = {
    "revenue_score": asc("total_revenue"),
    "volume_score": asc("nb_orders"),
    "review_score_ntile": asc("avg_review"),
    "delivery_score": desc("avg_delivery_days"),
    "ontime_score": asc("on_time_pct"),
}


def scored_sellers(star: Star) -> DataFrame:
    """Quintile per axis, 5 is best. A seller without deliveries sorts last and so scores 5 on delay."""
    scored = add_tiles(seller_metrics(star), AXES, 5, "seller_id")
    return scored.withColumn("total_score", sum((F.col(c) for c in AXES), F.lit(0)))


def seller_scoring(star: Star, limit: int = 50) -> DataFrame:
    """Best sellers by total score. Ranks are taken inside the top-k, which holds all better sellers."""
    best = scored_sellers(star).orderBy(F.desc("total_score"), "seller_id").limit(limit)
    by_score = W.orderBy(F.desc("total_score"))
    return best.select(
        "seller_id",
        "seller_city",
        "seller_state",
        "total_revenue",
        "nb_orders",
        "avg_review",
        "avg_delivery_days",
        "on_time_pct",
        *AXES,
        "total_score",
        F.rank().over(by_score).alias("seller_rank"),
        F.dense_rank().over(by_score).alias("seller_dense_rank"),
    ).orderBy(F.desc("total_score"), "seller_id")


def seller_total_scores(star: Star) -> DataFrame:
    """Score of every seller over unrounded metrics, without location."""
    on_time = F.avg(F.when(F.col("delivery_delta_days") <= 0, 1.0).otherwise(0.0)) * 100
    metrics = (
        delivered(star)
        .groupBy("seller_key")
        .agg(
            money_sum("price").alias("total_revenue"),
            F.countDistinct("order_id").alias("nb_orders"),
            mean_score("review_score").alias("avg_review"),
            mean_days("delivery_days").alias("avg_delivery_days"),
            on_time.alias("on_time_pct"),
        )
        .join(star["dim_sellers"].select("seller_key", "seller_id"), "seller_key")
        .drop("seller_key")
    )
    scored = add_tiles(metrics, AXES, 5, "seller_id")
    total = sum((F.col(c) for c in AXES), F.lit(0))
    return scored.select("seller_id", total.alias("total_score")).orderBy(F.desc("total_score"), "seller_id")


def top_sellers_per_state(star: Star, k: int = 3) -> DataFrame:
    per_key = delivered(star).groupBy("seller_key").agg(money_sum("price").alias("revenue"))
    sellers = star["dim_sellers"].select("seller_key", "seller_id", "state")
    place = F.row_number().over(W.partitionBy("state").orderBy(F.desc("revenue"), "seller_id"))
    return (
        per_key.join(sellers, "seller_key")
        .withColumn("rank_in_state", place)
        .filter(F.col("rank_in_state") <= k)
        .select("state", "seller_id", "revenue", "rank_in_state")
        .orderBy("state", "rank_in_state")
    )


def revenue_share_by_quintile(star: Star) -> DataFrame:
    """Share of revenue per fifth of the sellers, best fifth first."""
    tiles = add_tiles(seller_revenue(star), {"quintile": desc("total_revenue")}, 5, "seller_id")
    per_tile = tiles.groupBy("quintile").agg(F.sum("total_revenue").alias("segment_revenue"))
    everything = F.sum("segment_revenue").over(W.partitionBy())
    return per_tile.withColumn("pct_of_total", ratio(F.col("segment_revenue") * 100, everything)).orderBy("quintile")
