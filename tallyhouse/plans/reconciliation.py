"""Raw data against the warehouse: volumes, distributions, totals, months."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.functions.columns import money, money_sum, money_total, month_label, month_of, ratio
from tallyhouse.plans.integrity import stack
from tallyhouse.plans.profiling import histogram
from tallyhouse.schemas import MONTH

Tables = Mapping[str, DataFrame]

SOURCES = {
    "dim_geolocation": ("geolocation",),
    "dim_customers": ("customers",),
    "dim_sellers": ("sellers",),
    "dim_products": ("products", "category_translation"),
    "dim_dates": ("orders",),
    "fact_orders": ("order_items", "orders", "order_payments", "order_reviews"),
}

# The geographic bounds outside which a coordinate is an outlier.
LAT_BOUNDS = (-35.0, 6.0)
LNG_BOUNDS = (-75.0, -34.0)


def _n() -> Column:
    return F.count(F.lit(1))


def _label(df: DataFrame, name: str, value: str) -> DataFrame:
    return df.select(F.lit(value).alias(name), *df.columns)


def _modelled(df: DataFrame) -> list[str]:
    """Columns without the month by which the fact's files are stored."""
    return [c for c in df.columns if c != MONTH]


def volumes(raw: Tables, star: Tables) -> DataFrame:
    """Rows and columns of the sources of each table, of the table, and their ratio."""
    parts = []
    for target, sources in SOURCES.items():
        rows = stack([raw[s].agg(_n().alias("n")) for s in sources]).agg(F.sum("n").alias("source_rows"))
        one = rows.select(
            F.lit(target).alias("target"),
            F.lit(" + ".join(sources)).alias("sources"),
            "source_rows",
            F.lit(sum(len(raw[s].columns) for s in sources)).alias("source_columns"),
            star[target].agg(_n()).scalar().alias("target_rows"),
            F.lit(len(_modelled(star[target]))).alias("target_columns"),
        )
        parts.append(one)
    return stack(parts).withColumn("ratio", F.round(ratio(F.col("source_rows"), F.col("target_rows")), 1))


def coordinate_outliers(raw: Tables, star: Tables) -> DataFrame:
    """Coordinates inside and outside the bounds, before and after deduplication."""
    before = raw["geolocation"].select(F.col("geolocation_lat").alias("lat"), F.col("geolocation_lng").alias("lng"))
    after = star["dim_geolocation"].select("lat", "lng")
    parts = []
    for side, df in (("raw", before), ("warehouse", after)):
        for c, bounds in (("lat", LAT_BOUNDS), ("lng", LNG_BOUNDS)):
            inside = F.count_if(F.col(c).between(*bounds))
            one = df.agg(inside.alias("inside"), (F.count(c) - inside).alias("outliers"))
            parts.append(_label(_label(one, "coordinate", c), "side", side))
    return stack(parts)


def coordinate_histogram(raw: Tables, star: Tables, bins: int = 80) -> DataFrame:
    """Rows per bin of the in-bounds coordinates, raw against deduplicated."""
    parts = []
    for c, bounds in (("lat", LAT_BOUNDS), ("lng", LNG_BOUNDS)):
        for side, df, column in (("raw", raw["geolocation"], f"geolocation_{c}"), ("warehouse", star["dim_geolocation"], c)):
            counts = histogram(df.filter(F.col(column).between(*bounds)), column, bins)
            parts.append(_label(_label(counts, "coordinate", c), "side", side))
    return stack(parts)


def _payment_grains(raw: Tables, star: Tables) -> dict[str, DataFrame]:
    """Amounts as ``value`` per payment, per raw order and per warehouse order."""
    per_payment = raw["order_payments"].select(money("payment_value").alias("value"))
    per_order = raw["order_payments"].groupBy("order_id").agg(money_sum("payment_value").alias("value"))
    in_fact = star["fact_orders"].groupBy("order_id").agg(money(F.max("order_payment_total")).alias("value"))
    grains = {"payment": per_payment, "raw order": per_order, "warehouse order": in_fact}
    return {name: df.select("value").filter("value is not null") for name, df in grains.items()}


def payment_distributions(raw: Tables, star: Tables, upper: float = 500) -> DataFrame:
    """Rows, total and share above ``upper`` per grain."""
    limit = F.lit(str(upper)).cast("decimal(18,2)")
    parts = []
    for name, df in _payment_grains(raw, star).items():
        one = df.agg(
            _n().alias("rows"),
            F.sum("value").cast("decimal(38,2)").alias("total"),
            ratio(F.count_if(F.col("value") > limit) * 100, _n()).alias("above_pct"),
        )
        parts.append(_label(one, "grain", name))
    return stack(parts)


def payment_histograms(raw: Tables, star: Tables, upper: float = 500, bins: int = 50) -> DataFrame:
    """Amounts up to ``upper`` in equal bins per grain."""
    limit = F.lit(str(upper)).cast("decimal(18,2)")
    grains = _payment_grains(raw, star).items()
    return stack([_label(histogram(df.filter(F.col("value") <= limit), "value", bins), "grain", name) for name, df in grains])


def totals(raw: Tables, star: Tables) -> DataFrame:
    """Payments (once per order), price and freight: raw, warehouse, absolute and relative gap."""
    once = (
        star["fact_orders"]
        .groupBy("order_id")
        .agg(money(F.max("order_payment_total")).alias("paid"))
        .agg(F.sum("paid"))
    )
    sums = star["fact_orders"].agg(F.struct(money_total("price").alias("price"), money_total("freight_value").alias("freight_value"))).scalar()
    parts = [
        raw["order_payments"].agg(money_total("payment_value").alias("raw_total")).select(
            F.lit("payments").alias("measure"), "raw_total", once.scalar().alias("warehouse_total")
        )
    ]
    for c in ("price", "freight_value"):
        one = raw["order_items"].agg(money_total(c).alias("raw_total"))
        parts.append(one.select(F.lit(c).alias("measure"), "raw_total", sums.getField(c).alias("warehouse_total")))
    gap = F.abs(F.col("raw_total") - F.col("warehouse_total"))
    return stack([p.select("measure", F.col("raw_total").cast("decimal(38,2)"), F.col("warehouse_total").cast("decimal(38,2)")) for p in parts]).select(
        "measure", "raw_total", "warehouse_total", gap.alias("gap"), ratio(gap * 100, F.col("raw_total")).alias("gap_pct")
    )


def lineage(raw: Tables, star: Tables) -> DataFrame:
    """Columns kept, lost and gained per table, with the non-null values found behind each."""
    parts = []
    for target, sources in SOURCES.items():
        here = _modelled(star[target])
        there = dict.fromkeys(c for s in sources for c in raw[s].columns)
        for s in sources:
            fates = {c: "kept" if c in here else "lost" for c in raw[s].columns}
            parts.append(_value_counts(raw[s], target, s, fates))
        gained = {c: "gained" for c in here if c not in there}
        parts.append(_value_counts(star[target], target, target, gained))
    return stack(parts)


def _value_counts(df: DataFrame, target: str, source: str, fates: Mapping[str, str]) -> DataFrame:
    """One pass over the table, one output row per column."""
    counts = df.agg(*[F.count(c).alias(c) for c in fates])
    cells = [F.struct(F.lit(c).alias("column"), F.lit(f).alias("fate"), F.col(c).alias("non_null")) for c, f in fates.items()]
    return counts.select(F.lit(target).alias("target"), F.lit(source).alias("source"), F.inline(F.array(*cells)))


def months(raw: Tables, star: Tables) -> DataFrame:
    """Per month: raw orders, those without items, warehouse orders, and what is left over."""
    bought = F.col("order_purchase_timestamp").try_cast("timestamp_ntz")
    label = F.date_format(bought, "yyyy-MM")
    with_items = raw["order_items"].select("order_id").distinct().withColumn("has_items", F.lit(True))
    orders = raw["orders"].select("order_id", label.alias("year_month")).filter("year_month is not null").distinct()
    per_month = (
        orders.join(with_items, "order_id", "left")
        .groupBy("year_month")
        .agg(
            _n().alias("raw_orders"),
            F.count_if(F.col("has_items").isNull()).alias("raw_without_items"),
        )
    )
    warehouse = (
        star["fact_orders"]
        .filter("date_key is not null")
        .groupBy(month_label(month_of("date_key")).alias("year_month"))
        .agg(F.countDistinct("order_id").alias("warehouse_orders"))
    )
    both = per_month.join(warehouse, "year_month", "full_outer").fillna(0)
    left_over = F.col("raw_orders") - F.col("raw_without_items") - F.col("warehouse_orders")
    return both.withColumn("residual", left_over).orderBy("year_month")


def expected_shape(raw: Tables, expected: Mapping[str, tuple[int | Column, int]]) -> DataFrame:
    """Row and column counts per dataset against expected ones, a number or a scalar of another table."""
    parts = []
    for name, (rows, columns) in expected.items():
        one = raw[name].agg(_n().alias("rows"))
        parts.append(
            one.select(
                F.lit(name).alias("dataset"),
                (F.lit(rows) if isinstance(rows, int) else rows).cast("bigint").alias("expected_rows"),
                "rows",
                F.lit(columns).alias("expected_columns"),
                F.lit(len(raw[name].columns)).alias("columns"),
            )
        )
    ok = (F.col("rows") == F.col("expected_rows")) & (F.col("columns") == F.col("expected_columns"))
    return stack(parts).withColumn("ok", ok)


def zip_and_category_counts(raw: Tables) -> DataFrame:
    """Unique zips, mean rows per zip, products without a category."""
    zips = raw["geolocation"].groupBy("geolocation_zip_code_prefix").agg(_n().alias("n"))
    known = F.count("geolocation_zip_code_prefix")
    unnamed = F.col("product_category_name").isNull() | (F.trim("product_category_name") == "")
    nameless = raw["products"].agg(F.count_if(unnamed)).scalar()
    return zips.agg(
        known.alias("unique_zips"),
        F.round(ratio(F.sum("n"), known)).cast("bigint").alias("mean_rows_per_zip"),
    ).withColumn("products_without_category", nameless)


def without_geography(raw: Tables) -> DataFrame:
    """Customers and sellers whose zip is not in the geography (null zips are not counted)."""
    known = raw["geolocation"].select(F.col("geolocation_zip_code_prefix").alias("zip")).distinct()
    parts = []
    for name, column in (("customers", "customer_zip_code_prefix"), ("sellers", "seller_zip_code_prefix")):
        zips = raw[name].groupBy(F.col(column).alias("zip")).agg(_n().alias("n")).filter("zip is not null")
        lost = zips.join(known, "zip", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("without_geography"))
        parts.append(_label(lost, "dataset", name))
    return stack(parts)


def orders_without_items(raw: Tables) -> DataFrame:
    """Per status. The total is the sum of the rows."""
    items = raw["order_items"].select("order_id").distinct()
    lost = raw["orders"].join(items, "order_id", "left_anti")
    return lost.groupBy("order_status").agg(_n().alias("orders_without_items"))


def orphan_items(raw: Tables) -> DataFrame:
    """Items without an order, and distinct orders among the items."""
    per_order = raw["order_items"].groupBy("order_id").agg(_n().alias("n"))
    known = raw["orders"].select("order_id").distinct().withColumn("hit", F.lit(1))
    both = per_order.join(known, "order_id", "left")
    return both.agg(
        F.coalesce(F.sum(F.when(F.col("hit").isNull(), F.col("n"))), F.lit(0)).alias("orphan_items"),
        F.count("order_id").alias("distinct_orders"),
    )


def item_sums(raw: Tables) -> DataFrame:
    return raw["order_items"].agg(money_total("price").alias("sum_price"), money_total("freight_value").alias("sum_freight"))


def status_counts(raw: Tables) -> DataFrame:
    return raw["orders"].groupBy("order_status").agg(_n().alias("n"))
