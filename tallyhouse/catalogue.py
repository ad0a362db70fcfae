"""Every report and operator as a query over the driver's tables: (spark, folder) -> DataFrame.

Keys start with the id of the inventory entry. ``portable`` fixes the output types, so that
results compare with any other engine: whole numbers as bigint, decimals as double, dates
and timestamps as text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyhouse.functions.columns import date_key, days_between
from tallyhouse.operators import cleaning, modelling
from tallyhouse.operators.groups import group_modes
from tallyhouse.operators.staging import stage, staging_path
from tallyhouse.plans import customers, indicators, integrity, payments, profiling, reconciliation, sales, sellers, views
from tallyhouse.refresh import run, run_if_stale
from tallyhouse.schemas import MONTH, ORDER_TIMESTAMPS
from tallyhouse.session import tune
from tallyhouse.sinks import snapshot
from tallyhouse.sources import given, raw as raw_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


def register(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: portable(fn(tune(spark, given.input_bytes(spark, sf_dir)), sf_dir))
        return fn

    return add


def on_star(name: str, plan: Callable[..., DataFrame], where: dict | None = None, **args) -> None:
    """``where`` narrows the fact at its source to what the plan keeps anyway."""
    register(name)(lambda spark, sf_dir: plan(given.star(spark, sf_dir, **(where or {})), **args))


def on_raw(name: str, plan: Callable[..., DataFrame], **args) -> None:
    register(name)(lambda spark, sf_dir: plan(given.raw(spark, sf_dir), **args))


def on_clean(name: str, plan: Callable[..., DataFrame]) -> None:
    register(name)(lambda spark, sf_dir: plan(warehouse(spark, sf_dir)["clean"], warehouse(spark, sf_dir)["star"]))


def on_both(name: str, plan: Callable[..., DataFrame]) -> None:
    register(name)(lambda spark, sf_dir: plan(given.raw(spark, sf_dir), warehouse(spark, sf_dir)["star"]))


_built: dict[tuple, dict] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> dict:
    """Cleaned tables and the published snapshot of the raw mapping, built once for each state of the tables."""
    key = given.state_of(spark, sf_dir)
    if key not in _built:
        clean = modelling.hold_orders(cleaning.clean_all(given.raw(spark, sf_dir)))
        root = staging_path(spark, "warehouse")
        snapshot.publish(spark, modelling.build_star(clean), root)
        _built[key] = {"clean": clean, "star": snapshot.read_star(spark, root), "root": root}
    return _built[key]


def forget() -> None:
    """Build and stage anew from here on."""
    _built.clear()
    given.forget()


# ---- S: sources, sinks ---------------------------------------------------------------


def _csv_copy(spark: SparkSession, sf_dir: str, names: Sequence[str]) -> tuple[str, dict[str, str]]:
    """The raw mapping written as CSV files, for the readers to load."""
    folder = staging_path(spark, "csv")
    for name in names:
        _write_csv(given.RAW_BUILDERS[name](spark, sf_dir), f"{folder}/{name}")
    return folder, {name: name for name in names}


#: Of the CSV files; the second is the Hadoop option for the level.
CSV_CODEC = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    options = dict(CSV_CODEC, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    df.write.mode(mode).options(**options).csv(path)


@register("s1_load_raw_csv")
def s1(spark, sf_dir):
    folder, files = _csv_copy(spark, sf_dir, ["order_reviews"])
    return raw_files.load_raw_csv(spark, folder, "order_reviews", files)


@register("s2_load_all_raw")
def s2(spark, sf_dir):
    folder, files = _csv_copy(spark, sf_dir, list(given.RAW_BUILDERS))
    loaded = raw_files.load_all_raw(spark, folder, files)
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("dataset"), "rows", F.lit(len(df.columns)).alias("columns"))
        for n, df in loaded.items()
    ]
    return integrity.stack(parts)


@register("s3_write_star_schema")
def s3(spark, sf_dir):
    """The written fact without its stored key, whose order is that of the files."""
    return warehouse(spark, sf_dir)["star"]["fact_orders"].drop("fact_key", MONTH)


@register("s3_fact_key_is_unique")
def s3_key(spark, sf_dir):
    fact = warehouse(spark, sf_dir)["star"]["fact_orders"]
    return fact.agg(F.count(F.lit(1)).alias("rows"), F.count("fact_key").alias("keyed"), F.countDistinct("fact_key").alias("keys"))


@register("s3_fact_by_month")
def s3_month(spark, sf_dir):
    """Rows per stored month, with the days that lie in it."""
    fact = warehouse(spark, sf_dir)["star"]["fact_orders"]
    return fact.groupBy(MONTH).agg(F.count(F.lit(1)).alias("rows"), F.min("date_key").alias("first_key"), F.max("date_key").alias("last_key"))


@register("s4_atomic_refresh")
def s4(spark, sf_dir):
    """Publish twice to one place: same content, no duplicates.

    The place is that of the warehouse, whose months have these rows, so neither refresh writes them again.
    """
    built = warehouse(spark, sf_dir)
    root, star = built["root"], built["star"]
    for _ in range(2):
        snapshot.publish(spark, star, root)
    fact = snapshot.read_star(spark, root)["fact_orders"]
    return fact.groupBy("order_status").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("order_id").alias("orders"))


@register("s5_views_by_name")
def s5(spark, sf_dir):
    views.register_views(given.star(spark, sf_dir))
    return views.query(spark, "select month_label, monthly_revenue from v_monthly_sales")


@register("s6_parametrised_sql")
def s6(spark, sf_dir):
    views.register_views(given.star(spark, sf_dir))
    text = (
        "select customer_state, count(*) as nb_items from v_orders_enriched"
        " where order_status = :status and price >= :floor group by customer_state"
    )
    return views.query(spark, text, {"status": "shipped", "floor": 50000.0})


@register("s7_four_phase_job")
def s7(spark, sf_dir):
    """The whole job from CSV files to a published snapshot, and what it counted on the way."""
    root = staging_path(spark, "job")
    folder, files = _csv_copy(spark, sf_dir, list(given.RAW_BUILDERS))
    report = run(spark, folder, root, files)
    counted = {**report.cleaning, **{f"unresolved {k}": v for k, v in report.unresolved.items()}}
    return spark.createDataFrame(sorted(counted.items()), "measure string, n bigint")


@register("s8_rebuild_if_stale")
def s8(spark, sf_dir):
    """Builds without a snapshot, not again on the same files, and again once a dataset was delivered anew."""
    folder, files = _csv_copy(spark, sf_dir, list(given.RAW_BUILDERS))
    root, seen = staging_path(spark, "refreshed"), []
    for step in ("first", "same files", "new reviews"):
        if step == "new reviews":
            half = given.raw_order_reviews(spark, sf_dir).filter(F.col("review_score") >= 3)
            _write_csv(half, f"{folder}/order_reviews")
        built = run_if_stale(spark, folder, root, files) is not None
        fact = snapshot.read_star(spark, root)["fact_orders"]
        counted = fact.agg(F.count(F.lit(1)).alias("items"), F.count("review_score").alias("reviewed"))
        seen.append(counted.select(F.lit(step).alias("step"), F.lit(built).alias("built"), "items", "reviewed"))
    return integrity.stack(seen)


@register("s9_ingest_manifest")
def s9(spark, sf_dir):
    """After a delivery of new reviews, of which alone the second manifest reads anything.

    Sizes depend on the writer of the files, so only whether there are any bytes is shown.
    """
    folder, files = _csv_copy(spark, sf_dir, [n for n in given.RAW_BUILDERS if n != "order_reviews"])
    files["order_reviews"] = "order_reviews"
    reviews = given.raw_order_reviews(spark, sf_dir)
    late = F.coalesce(F.col("review_score") < 3, F.lit(False))
    _write_csv(reviews.filter(~late), f"{folder}/order_reviews")
    first = raw_files.manifest(spark, folder, files)
    _write_csv(reviews.filter(late), f"{folder}/order_reviews", mode="append")
    entries = raw_files.manifest(spark, folder, files, known=first)
    return raw_files.manifest_totals(entries).select("dataset", "rows", (F.col("bytes") > 0).alias("has_bytes"), "checksum")


@register("s10_warehouse_inventory")
def s10(spark, sf_dir):
    return snapshot.inventory(warehouse(spark, sf_dir)["star"])


# ---- C: cleaning -------------------------------------------------------------------------


@register("c1_drop_full_duplicates")
def c1(spark, sf_dir):
    """Whole rows of a table in which every row occurs twice."""
    events = given.table(spark, sf_dir, "events")
    return cleaning.drop_full_duplicates(events.unionByName(events))


@register("c2_parse_timestamps")
def c2(spark, sf_dir):
    parsed = cleaning.parse_timestamps(given.raw_orders(spark, sf_dir), [*ORDER_TIMESTAMPS, "no_such_column"])
    return parsed.select("order_id", *ORDER_TIMESTAMPS)


@register("c3_strip_strings")
def c3(spark, sf_dir):
    return cleaning.strip_strings(given.table(spark, sf_dir, "documents"))


@register("c4_normalise_geography")
def c4(spark, sf_dir):
    texts = given.table(spark, sf_dir, "documents")
    places = texts.select(
        F.col("text").alias("x_city"), F.col("lang").alias("x_state"), F.col("doc_id").cast("string").alias("x_zip_code_prefix")
    )
    return cleaning.normalise_place(places, "x")


for _id, _name in (
    ("c5", "customers"),
    ("c6", "geolocation"),
    ("c7", "orders"),
    ("c8", "order_items"),
    ("c9", "order_payments"),
    ("c10", "order_reviews"),
    ("c12", "sellers"),
    ("c13", "category_translation"),
):
    register(f"{_id}_clean_{_name}")(
        lambda spark, sf_dir, name=_name: cleaning.CLEANERS[name][0](given.RAW_BUILDERS[name](spark, sf_dir))
    )


@register("c11_clean_products")
def c11(spark, sf_dir):
    translation = cleaning.clean_category_translation(given.raw_category_translation(spark, sf_dir))
    return cleaning.clean_products(given.raw_products(spark, sf_dir), translation)


@register("c14_clean_all")
def c14(spark, sf_dir):
    done = cleaning.clean_all(given.raw(spark, sf_dir))
    return integrity.stack(
        [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("dataset"), "rows") for n, df in done.items()]
    )


@register("c15_mode_with_default")
def c15(spark, sf_dir):
    return group_modes(given.raw_geolocation(spark, sf_dir), ["geolocation_state"], ["geolocation_city"], "none")


# ---- M: modelling --------------------------------------------------------------------------


@register("m1_surrogate_key")
def m1(spark, sf_dir):
    return modelling.surrogate_key(given.raw_products(spark, sf_dir).select("product_id"), "product_key", "product_id")


@register("m2_dim_dates")
def m2(spark, sf_dir):
    return modelling.build_dim_dates(warehouse(spark, sf_dir)["clean"]["orders"])


def _published(name: str, table: str) -> None:
    register(name)(lambda spark, sf_dir: warehouse(spark, sf_dir)["star"][table])


_published("m3_dim_geolocation", "dim_geolocation")
_published("m4_dim_customers", "dim_customers")
_published("m5_dim_sellers", "dim_sellers")
_published("m6_dim_products", "dim_products")


@register("m7_payments_per_order")
def m7(spark, sf_dir):
    return modelling.payments_per_order(cleaning.clean_order_payments(given.raw_order_payments(spark, sf_dir)))


@register("m8_latest_review")
def m8(spark, sf_dir):
    return modelling.latest_review_per_order(cleaning.clean_order_reviews(given.raw_order_reviews(spark, sf_dir)))


@register("m9_order_facts")
def m9(spark, sf_dir):
    built = warehouse(spark, sf_dir)
    c = built["clean"]
    facts = modelling.order_facts(c["orders"], c["order_payments"], c["order_reviews"], built["star"]["dim_customers"])
    return facts.select("order_id", "order_status", "date_key", "order_payment_total", "payment_type", "review_score")


@register("m10_resolved_keys")
def m10(spark, sf_dir):
    fact = warehouse(spark, sf_dir)["star"]["fact_orders"]
    keys = ["customer_key", "seller_key", "product_key", "customer_geo_key", "seller_geo_key"]
    return fact.select("order_id", "order_item_id", *keys)


@register("m11_unresolved_keys")
def m11(spark, sf_dir):
    fact = warehouse(spark, sf_dir)["star"]["fact_orders"]
    keys = ["customer_key", "seller_key", "product_key", "customer_geo_key", "seller_geo_key", "date_key"]
    return fact.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in keys])


@register("m12_date_key")
def m12(spark, sf_dir):
    orders = given.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", date_key("o_orderdate").alias("date_key"))


@register("m13_delivery_days")
def m13(spark, sf_dir):
    orders = warehouse(spark, sf_dir)["clean"]["orders"]
    bought = "order_purchase_timestamp"
    took = days_between("order_delivered_customer_date", bought)
    estimate = days_between("order_estimated_delivery_date", bought)
    return orders.select(
        "order_id", took.alias("delivery_days"), estimate.alias("estimated_days"), (took - estimate).alias("delivery_delta_days")
    )


@register("m14_fact_orders")
def m14(spark, sf_dir):
    built = warehouse(spark, sf_dir)
    c, s = built["clean"], built["star"]
    return modelling.build_fact_orders(
        c["order_items"], c["orders"], c["order_payments"], c["order_reviews"], s["dim_customers"], s["dim_sellers"], s["dim_products"]
    )


# ---- V, D, P, X, K: views and reports ---------------------------------------------------------

on_star("v1_monthly_sales", views.monthly_sales)
on_star("v2_customer_cohorts", views.customer_cohorts)
on_star("v3_orders_enriched", views.orders_enriched)

on_star("d1_overview_kpis", sales.overview_kpis)
on_star("d2_monthly_revenue", sales.monthly_revenue)
on_star("d3_trends_monthly", sales.trends_monthly)
on_star("d4_basket_avg", sales.basket_avg)
on_star("d5_yearly_revenue", sales.yearly_revenue)
on_star("d6_top_categories", sales.top_categories)
on_star("d7_pareto_sellers", sellers.pareto_sellers)
on_star("d8_seller_scoring", sellers.seller_scoring)
on_star("d9_rfm_segmentation", customers.rfm_segmentation)
on_star("d9_rfm_scores", customers.rfm_scored)
on_star("d10_cohorts_retention", customers.cohorts_retention)
on_star("d11_ltv_cohorts", customers.ltv_cohorts)
on_star("d12_new_vs_recurring", customers.new_vs_recurring)


def on_warehouse(name: str, plan: Callable[..., DataFrame], **args) -> None:
    register(name)(lambda spark, sf_dir: plan(warehouse(spark, sf_dir)["star"], **args))


on_warehouse("p1_gap_stats", payments.gap_stats)
on_warehouse("p2_gap_split", payments.gap_split)
on_warehouse("p2_gap_split_unpaid", payments.gap_split, unpaid="no payment")
on_warehouse("p3_gap_histogram", payments.gap_histogram)
on_warehouse("p3_gap_histogram_unpaid", payments.gap_histogram, unpaid="no payment")
on_warehouse("p4_gap_by_payment_type", payments.gap_by_payment_type)
on_warehouse("p5_largest_gaps", payments.largest_gaps)
on_warehouse("p6_underpaid_orders", payments.underpaid_orders)
on_raw("p7_raw_gaps", payments.raw_gaps)
on_raw("p8_raw_gap_stats", payments.raw_gap_stats)
on_raw("p9_dominant_payment_type", payments.dominant_payment_type)
on_raw("p10_gaps_by_dominant_type", payments.raw_gaps_by_dominant_type)
on_raw("p11_installments_by_gap", payments.installments_by_gap)

on_star(
    "x1_delivered_items_of_year",
    sales.delivered_items_of_year,
    where={"status": "delivered", "first_day": date(1997, 1, 1), "last_day": date(1997, 12, 31)},
    year=1997,
)
on_star("x2_top_categories_inner", sales.top_categories_with_product)
on_star("x3_revenue_by_state", sales.revenue_by_state)
on_star("x4_revenue_vs_12_rows_back", sales.revenue_vs_rows_back)
on_star("x5_customer_quintiles", customers.customer_quintiles)
on_star("x6_running_revenue", sales.running_revenue)
on_star("x7_top_products_share", sales.top_products_share)
on_star("x8_customers_with_two_orders", customers.customers_with_orders)
on_star("x9_top_sellers_per_state", sellers.top_sellers_per_state)

on_star("k1_repeat_rate", customers.repeat_rate)
on_star("k2_seller_total_scores", sellers.seller_total_scores)
on_star("k3_new_vs_later", customers.new_vs_later)
on_star("k4_inactive_customers", customers.inactive_customers, as_of=date(2001, 12, 31))
on_star("k5_first_month_flags", customers.first_month_flags)
on_star("k6_revenue_share_by_quintile", sellers.revenue_share_by_quintile)
on_star("k7_mean_price_per_customer", customers.mean_price_per_customer)
on_star("k8_orders_per_customer", customers.orders_per_customer)
on_star("k9_extreme_customers", customers.extreme_customers, above=2_000_000, below=500_000)
on_star("k10_month_over_month", sales.month_over_month)
on_star("k11_next_purchase", customers.next_purchase)
on_star("k12_rank_in_category", sales.rank_in_category)
on_star("k13_states_over_100_orders", sales.states_over)
on_star("k14_items_and_orders", sales.items_and_orders)
on_star("k15_delivered_item_count", sales.delivered_item_count, where={"status": "delivered"})
on_star("k16_latest_rows", sales.latest_rows)
on_star("k16_latest_rows_projected", sales.latest_rows, columns=["order_id", "order_status", "price"])
on_star("k17_items_with_status_mean", sales.items_with_status_mean)
on_star("k18_first_delivered_rows", sales.first_delivered_rows, where={"status": "delivered"})
on_star("k18_status_revenue", sales.status_revenue, where={"status": "delivered"})
on_star("k19_top_products_per_category", sales.top_products_per_category)
on_star("k20_rows_with_month_total", sales.rows_with_month_total)
on_star("k21_score_bands", sales.items_per_score_band)
_JUNE = date(1997, 6, 15)
on_star("k22_rows_of_one_day", sales.rows_between_days, where={"first_day": _JUNE, "last_day": _JUNE}, first_key=19970615, last_key=19970615)
on_star("k22_rows_from_day_on", sales.rows_between_days, where={"first_day": date(2000, 1, 1)}, first_key=20000101)


@register("k22_published_month")
def k22_published(spark, sf_dir):
    """Days of one month of the published fact; only that month's files are read."""
    chosen = sales.rows_between_days(warehouse(spark, sf_dir)["star"], 19970601, 19970630)
    return chosen.groupBy("date_key").agg(F.count(F.lit(1)).alias("items"), F.countDistinct("order_id").alias("orders"))


# ---- I: indicators --------------------------------------------------------------------------


def on_report(name: str, report: Callable[..., DataFrame], indicator: Callable[..., DataFrame], **args) -> None:
    register(name)(lambda spark, sf_dir: indicator(report(given.star(spark, sf_dir)), **args))


on_report("i1_retention_matrix", customers.cohorts_retention, indicators.retention_matrix, min_size=15)
on_report("i2_retention_summary", customers.cohorts_retention, indicators.retention_summary, min_size=15)
on_report("i2_cohort_sizes", customers.cohorts_retention, indicators.cohort_sizes, min_size=15)
on_report("i3_acquisition_summary", customers.new_vs_recurring, indicators.acquisition_summary)
on_report("i4_ltv_selection", customers.ltv_cohorts, indicators.ltv_selection)
on_report("i4_best_ltv", customers.ltv_cohorts, indicators.best_ltv)
on_report("i5_trend_summary", sales.trends_monthly, indicators.trend_summary)
on_report("i6_basket_summary", sales.basket_avg, indicators.basket_summary, min_orders=60)
on_report("i7_satisfaction", sales.overview_kpis, indicators.satisfaction)
on_report("i7_month_summary", sales.monthly_revenue, indicators.month_summary)
on_report("i8_pareto_threshold", sellers.pareto_curve, indicators.pareto_threshold)
on_report("i8_pareto_threshold_shown", sellers.pareto_sellers, indicators.pareto_threshold)
on_report("i9_segment_summary", customers.rfm_segmentation, indicators.segment_summary)
on_report("i10_seller_profile", sellers.seller_scoring, indicators.seller_profile)
on_report("i10_seller_radar", sellers.seller_scoring, indicators.seller_radar)
on_report("i10_seller_table", sellers.seller_scoring, indicators.seller_table)
on_report("i11_category_concentration", sales.top_categories, indicators.category_concentration)
on_report("i11_year_summary", sales.yearly_revenue, indicators.year_summary)

# ---- R: profiling ---------------------------------------------------------------------------

on_raw("r1_dataset_summary", profiling.dataset_summary)
on_raw("r2_column_profile", profiling.profile_all)
on_raw("r2_describe", profiling.describe_all)
on_raw("r3_cardinalities", profiling.cardinalities)
on_raw("r4_orphans", profiling.orphans)
on_raw("r5_child_histogram", profiling.child_histogram, child="order_items")
on_raw("r5_child_histogram_clipped", profiling.child_histogram, child="order_reviews", clip=10)
on_raw("r5_price_histogram", lambda raw: profiling.histogram(raw["order_items"], "price"))
on_raw("r5_freight_histogram", lambda raw: profiling.histogram(raw["order_items"], "freight_value"))
on_raw("r5_rows_per_zip_clipped", lambda raw: profiling.histogram(profiling.zip_sizes(raw), "n", clip=50))
on_raw("r5_payment_histogram_clipped", lambda raw: profiling.histogram(raw["order_payments"], "payment_value", clip=1000))
on_raw("r6_rows_per_zip", profiling.rows_per_zip)
on_raw("r6_coordinate_spread", profiling.coordinate_spread)
on_raw("r7_spellings_per_zip", profiling.spellings_per_zip)
on_raw("r8_ids_per_person", profiling.ids_per_person)
on_raw("r9_zip_coverage", profiling.zip_coverage)
on_raw("r10_top_states", lambda raw: profiling.value_counts(raw["customers"], "customer_state", 10))
on_raw("r10_top_cities", lambda raw: profiling.value_counts(raw["customers"], "customer_city", 15))
on_raw("r10_top_categories", lambda raw: profiling.value_counts(raw["products"], "product_category_name", 20))
on_raw("r11_status_shares", lambda raw: profiling.value_shares(raw["orders"], "order_status"))
on_raw("r12_date_ranges", profiling.date_ranges)
on_raw("r13_orders_per_month", profiling.orders_per_month)
on_raw("r14_null_stamps_by_status", profiling.null_stamps_by_status)
on_raw("r15_children_per_parent", profiling.children_per_parent)
on_raw("r16_payment_mixes", profiling.payment_mixes)
on_raw("r16_payment_types", profiling.payment_types)
on_raw("r17_score_counts", lambda raw: profiling.value_counts(raw["order_reviews"], "review_score"))
on_raw("r17_empty_texts", profiling.empty_texts)
on_raw("r18_missing_columns", lambda raw: profiling.missing_columns(raw["products"]))
on_raw("r18_untranslated_categories", lambda raw: profiling.untranslated_categories(cleaned_names(raw)))
on_raw("r19_physical_describe", lambda raw: profiling.describe(raw["products"], profiling.PHYSICAL))
on_raw("r19_derived_describe", lambda raw: profiling.describe(raw["products"], profiling.DERIVED))
on_raw("r19_price_range", profiling.price_range)


def cleaned_names(raw):
    return {**raw, "products": cleaning.strip_strings(raw["products"])}


# ---- L: reconciliation -----------------------------------------------------------------------

on_both("l1_volumes", reconciliation.volumes)
on_both("l2_coordinate_outliers", reconciliation.coordinate_outliers)
on_both("l2_coordinate_histogram", reconciliation.coordinate_histogram)
on_both("l3_payment_distributions", lambda raw, star: reconciliation.payment_distributions(raw, star, upper=200_000))
on_both("l3_payment_histograms", lambda raw, star: reconciliation.payment_histograms(raw, star, upper=200_000))
on_both("l4_totals", reconciliation.totals)
on_both("l5_lineage", reconciliation.lineage)
on_both("l6_months", reconciliation.months)
@register("l7_expected_shape")
def l7(spark, sf_dir):
    """Nine datasets against what the given tables they come from let expect; two expectations are wrong on purpose."""
    rows = {t: given.table(spark, sf_dir, t).agg(F.count(F.lit(1))).scalar() for t in ("customer", "events", "orders", "part", "supplier")}
    lines = given.table(spark, sf_dir, "lineitem").agg(F.countDistinct("l_orderkey", "l_linenumber")).scalar()
    names = given.table(spark, sf_dir, "part").filter("p_type not in ('PROMO', 'SMALL')").agg(F.countDistinct(F.lower("p_type"))).scalar()
    expected = {
        "category_translation": (names, 2), "customers": (rows["orders"], 5), "geolocation": (rows["customer"], 5), "order_items": (lines, 7),
        "order_payments": (lines, 5), "order_reviews": (rows["events"], 7), "orders": (rows["orders"], 7), "products": (rows["part"], 9), "sellers": (1, 4),
    }
    return reconciliation.expected_shape(given.raw(spark, sf_dir), expected)


on_raw("l8_zip_and_category_counts", reconciliation.zip_and_category_counts)
on_raw("l9_without_geography", reconciliation.without_geography)
on_raw("l10_orders_without_items", reconciliation.orders_without_items)
on_raw("l10_orphan_items", reconciliation.orphan_items)
on_raw("l11_item_sums", reconciliation.item_sums)
on_raw("l11_status_counts", reconciliation.status_counts)

# ---- Q: integrity and comparison --------------------------------------------------------------

on_warehouse("q1_uniqueness", integrity.uniqueness)
on_star("q1_uniqueness_given", lambda star: integrity.uniqueness({**star, "dim_geolocation": _zip_stub(star)}))
on_warehouse("q2_value_rules", integrity.value_rules)
on_warehouse("q3_required_values", integrity.required_values)
on_warehouse("q4_referential", integrity.referential)
on_both("q5_row_counts", integrity.row_counts)
on_both("q6_revenue_totals", integrity.revenue_totals)
on_clean("q7_payment_totals", integrity.payment_totals)
on_clean("q8_latest_reviews", integrity.latest_reviews)
on_clean("q9_delivery_times", integrity.delivery_times)
on_warehouse("q10_date_dimension", integrity.date_dimension)
on_clean("q11_status_distribution", integrity.status_distribution)
on_both("q12_category_translation", integrity.category_translation)
on_both("q13_median_coordinates", integrity.median_coordinates)


def _zip_stub(star):
    return star["dim_sellers"].select(F.col("geo_key").alias("zip_code_prefix"))


@register("q14_compare_results")
def q14(spark, sf_dir):
    """Price per item against price with tax: lines whose tax exceeds the tolerance differ."""
    items = given.star(spark, sf_dir)["fact_orders"]
    keys = ["order_id", "order_item_id"]
    plain = items.select(*keys, "price")
    taxed = items.select(*keys, (F.col("price") + F.col("freight_value")).alias("price"))
    return integrity.compare_results(taxed, plain, keys)


@register("q15_check_structure")
def q15(spark, sf_dir):
    result = views.monthly_sales(given.star(spark, sf_dir))
    return integrity.check_structure(result, ["year", "month", "month_label"], min_rows=1, max_rows=10)


@register("q16_result_properties")
def q16(spark, sf_dir):
    """Five reports read the fact, so items meet their orders once, in a written table of the columns in use."""
    star = given.star(spark, sf_dir)
    used = ["order_id", "date_key", "customer_key", "seller_key", "product_key", "order_status", "price"]
    star = {**star, "fact_orders": stage(star["fact_orders"].select(*used), "items")}
    pareto = sellers.pareto_sellers(star)
    return integrity.stack(
        [
            integrity.not_descending(pareto, "total_revenue", "seller_rank"),
            integrity.tile_balance(customers.customer_quintiles(star), "quintile"),
            integrity.running_total(sales.running_revenue(star), "month", "monthly_revenue", "cumulative_revenue"),
            integrity.ranks_within(sellers.top_sellers_per_state(star), "state", "rank_in_state"),
            integrity.share_between(sales.top_products_share(star), "pct_of_total"),
        ]
    )
