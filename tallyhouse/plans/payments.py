"""Reconciliation of what was paid with what was invoiced, in exact cents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.functions.columns import money, money_sum, ratio
from tallyhouse.plans.views import Star

CENT = 0.01

# Bucket labels with their upper bounds, low to high; the last has none.
BUCKETS = (
    ("< -10", "lt", -10),
    ("-10 a -1", "lt", -1),
    ("-1 a -0.01", "lt", -0.01),
    ("exact (+-0.01)", "le", 0.01),
    ("0.01 a 1", "le", 1),
    ("1 a 10", "le", 10),
    ("10 a 50", "le", 50),
    ("> 50", None, None),
)


def _cents(x: float) -> Column:
    return F.lit(str(x)).cast("decimal(18,2)")


def _gap(delta: Column) -> Column:
    return F.abs(delta) > _cents(CENT)


def order_gaps(star: Star, by: tuple[str, ...] = ()) -> DataFrame:
    """Per order: paid total (repeated on every item, so its maximum) minus price and freight."""
    invoiced = money_sum("price") + money_sum("freight_value")
    paid = money(F.max("order_payment_total"))
    grouped = star["fact_orders"].groupBy("order_id", *by)
    return grouped.agg(invoiced.alias("invoiced_total"), paid.alias("paid_total"), F.count(F.lit(1)).alias("nb_items")).withColumn(
        "delta", F.col("paid_total") - F.col("invoiced_total")
    )


def gap_stats(star: Star) -> DataFrame:
    delta = F.col("delta")
    return (
        order_gaps(star)
        .filter(_gap(delta))
        .agg(
            F.count(F.lit(1)).alias("nb_commandes_avec_ecart"),
            F.round(ratio(F.sum(delta), F.count(delta)), 2).alias("delta_moyen"),
            F.min(delta).alias("delta_min"),
            F.max(delta).alias("delta_max"),
            F.sum(F.abs(delta)).alias("somme_abs_deltas"),
        )
    )


def gap_split(star: Star, unpaid: str | None = None) -> DataFrame:
    """Over, under and exact. Orders without a payment count as exact unless ``unpaid`` names them.

    Fixed values: the three labels.
    """
    delta = F.col("delta")
    label = F.when(delta > _cents(CENT), "surpaye (paid > invoiced)").when(
        delta < _cents(-CENT), "sous-paye (paid < invoiced)"
    )
    if unpaid is not None:
        label = label.when(delta.isNull(), unpaid)
    return (
        order_gaps(star)
        .groupBy(label.otherwise("exact").alias("type_ecart"))
        .agg(
            F.count(F.lit(1)).alias("nb_commandes"),
            F.round(ratio(F.sum(F.abs(delta)), F.count(delta)), 2).alias("ecart_abs_moyen"),
            F.sum(delta).alias("somme_delta"),
        )
    )


def gap_histogram(star: Star, unpaid: str | None = None) -> DataFrame:
    """Eight signed buckets. Orders without a payment fall into the last one unless named."""
    delta = F.col("delta")
    label = None if unpaid is None else F.when(delta.isNull(), unpaid)
    for name, how, bound in BUCKETS:
        if how is None:
            label = label.otherwise(name)
            break
        test = delta < _cents(bound) if how == "lt" else delta <= _cents(bound)
        label = F.when(test, name) if label is None else label.when(test, name)
    buckets = (
        order_gaps(star)
        .groupBy(label.alias("tranche_delta"))
        .agg(F.count(F.lit(1)).alias("nb_commandes"), F.min(delta).alias("_low"))
    )
    return buckets.orderBy("_low").drop("_low")


def gap_by_payment_type(star: Star) -> DataFrame:
    delta = F.col("delta")
    gaps = F.count_if(_gap(delta))
    return (
        order_gaps(star, by=("payment_type",))
        .groupBy("payment_type")
        .agg(
            F.count("order_id").alias("nb_commandes"),
            gaps.alias("nb_avec_ecart"),
            F.round(ratio(gaps * 100, F.count("order_id")), 2).alias("pct_ecart"),
            F.round(ratio(F.sum(F.when(_gap(delta), delta)), gaps), 2).alias("delta_moyen"),
        )
        .orderBy(F.desc("nb_avec_ecart"), "payment_type")
    )


def largest_gaps(star: Star, limit: int = 20) -> DataFrame:
    gaps = order_gaps(star).filter(_gap(F.col("delta"))).drop("nb_items")
    return gaps.orderBy(F.desc(F.abs("delta")), "order_id").limit(limit)


def underpaid_orders(star: Star, payment_type: str = "debit_card") -> DataFrame:
    """Underpaid orders of one payment type with their item count."""
    of_type = {"fact_orders": star["fact_orders"].filter(F.col("payment_type") == payment_type)}
    under = order_gaps(of_type, by=("order_status",)).filter(F.col("delta") < _cents(-CENT))
    return under.select("order_id", "order_status", "nb_items", "delta").orderBy("delta", "order_id")


# ---- from the raw tables ---------------------------------------------------------


def raw_order_gaps(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Per order with items and payments: gap, dominant payment type, highest installment count.

    Payments are reduced to one row per order first, so all reports share one join.
    """
    invoiced = raw["order_items"].groupBy("order_id").agg(
        (money_sum("price") + money_sum("freight_value")).alias("total_invoiced")
    )
    paid = paid_per_order(raw)
    joined = invoiced.join(paid, "order_id")
    return joined.withColumn("delta", F.col("total_paid") - F.col("total_invoiced"))


def paid_per_order(raw: Mapping[str, DataFrame]) -> DataFrame:
    per_type = (
        raw["order_payments"]
        .groupBy("order_id", "payment_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            money_sum("payment_value").alias("value"),
            F.max("payment_installments").alias("installments"),
        )
    )
    return per_type.groupBy("order_id").agg(
        F.sum("value").alias("total_paid"),
        F.min_by("payment_type", F.struct(-F.col("n"), "payment_type")).alias("payment_type"),
        F.max("installments").alias("max_installments"),
    )


def raw_gaps(raw: Mapping[str, DataFrame]) -> DataFrame:
    return raw_order_gaps(raw).select("order_id", "total_invoiced", "total_paid", "delta")


def raw_gap_stats(raw: Mapping[str, DataFrame]) -> DataFrame:
    delta = F.col("delta")
    over, under, gap = delta > _cents(CENT), delta < _cents(-CENT), _gap(delta)
    only = F.when(gap, delta)
    return raw_order_gaps(raw).agg(
        F.count_if(gap).alias("gap_orders"),
        F.round(ratio(F.sum(only), F.count(only)), 2).alias("mean_delta"),
        F.min(only).alias("min_delta"),
        F.max(only).alias("max_delta"),
        F.sum(only).alias("net_delta"),
        F.count_if(over).alias("overpaid_orders"),
        F.sum(F.when(over, delta)).alias("overpaid_sum"),
        F.count_if(under).alias("underpaid_orders"),
        F.sum(F.when(under, delta)).alias("underpaid_sum"),
    )


def dominant_payment_type(raw: Mapping[str, DataFrame]) -> DataFrame:
    return paid_per_order(raw).select("order_id", "payment_type")


def raw_gaps_by_dominant_type(raw: Mapping[str, DataFrame]) -> DataFrame:
    return (
        raw_order_gaps(raw)
        .groupBy("payment_type")
        .agg(F.count(F.lit(1)).alias("orders"), F.count_if(_gap(F.col("delta"))).alias("gap_orders"))
    )


def installments_by_gap(raw: Mapping[str, DataFrame]) -> DataFrame:
    gap, n = _gap(F.col("delta")), F.col("max_installments")
    with_gap, without = F.when(gap, n), F.when(~gap, n)
    return raw_order_gaps(raw).agg(
        F.round(ratio(F.sum(with_gap), F.count(with_gap)), 2).alias("mean_installments_gap"),
        F.round(ratio(F.sum(without), F.count(without)), 2).alias("mean_installments_no_gap"),
    )
