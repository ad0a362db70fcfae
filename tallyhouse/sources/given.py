"""The driver's tables seen as marketplace data.

``star`` maps them straight onto the star schema for the analytic queries. ``raw`` derives
the nine untidy raw datasets, so that cleaning, modelling, profiling and reconciliation run
on data that grows with the given tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse.functions.columns import cents, date_key, days_between
from tallyhouse.operators.modelling import build_dim_dates
from tallyhouse.operators.staging import stage

STATUS = {"F": "delivered", "O": "shipped"}
PAYMENT = {"1-URGENT": "credit_card", "2-HIGH": "boleto", "3-MEDIUM": "voucher", "4-NOT SPECIFIED": "debit_card"}


COLUMNS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read with the known schema, which saves a job that infers it."""
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


class Tables(Mapping):
    """Datasets by name, each planned when first asked for."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._builders, self._built = dict(builders), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def _case(c: str, mapping: dict[str, str], default: str) -> Column:
    out = F.lit(default)
    for value, label in reversed(mapping.items()):
        out = F.when(F.col(c) == value, label).otherwise(out)
    return out


def _tax_cents(amount_cents: Column, rate: Column) -> Column:
    """Tax in whole cents, half up, in integer arithmetic."""
    return F.floor((amount_cents * F.rint(rate * 100).cast("bigint") + 50) / 100)


def _placed(spark: SparkSession, sf_dir: str, name: str, nation_key: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return table(spark, sf_dir, name).join(nation, F.col(nation_key) == F.col("n_nationkey"), "left")


def star_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("order_purchase_timestamp"))
    return build_dim_dates(days)


def star_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _placed(spark, sf_dir, "customer", "c_nationkey").select(
        F.col("c_custkey").alias("customer_key"),
        F.col("c_custkey").alias("customer_id"),
        F.col("c_custkey").alias("customer_unique_id"),
        F.col("c_nationkey").alias("geo_key"),
        F.col("c_mktsegment").alias("city"),
        F.col("n_name").alias("state"),
    )


def star_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _placed(spark, sf_dir, "supplier", "s_nationkey").select(
        F.col("s_suppkey").alias("seller_key"),
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").alias("geo_key"),
        F.col("s_name").alias("city"),
        F.col("n_name").alias("state"),
    )


def star_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_key"),
        F.col("p_partkey").alias("product_id"),
        F.col("p_brand").alias("category_name_pt"),
        F.col("p_type").alias("category_name_en"),
    )


def star_fact(spark: SparkSession, sf_dir: str, status: str | None = None, first_day: date | None = None, last_day: date | None = None) -> DataFrame:
    """Items with their order. A status or a range of days is a filter on the columns of ``orders``, so the
    Parquet reader skips what the mapped columns would only drop later."""
    found = table(spark, sf_dir, "orders")
    if status is not None:
        found = found.filter(F.col("o_orderstatus") == next(k for k, label in STATUS.items() if label == status))
    if first_day is not None:
        found = found.filter(F.col("o_orderdate") >= F.lit(first_day).cast("timestamp_ntz"))
    if last_day is not None:
        found = found.filter(F.col("o_orderdate") < F.lit(last_day + timedelta(days=1)).cast("timestamp_ntz"))
    chosen = not (status is None and first_day is None and last_day is None)
    orders = found.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_key"),
        date_key("o_orderdate").alias("date_key"),
        _case("o_orderstatus", STATUS, "processing").alias("order_status"),
        F.col("o_totalprice").alias("order_payment_total"),
        _case("o_orderpriority", PAYMENT, "not_defined").alias("payment_type"),
        "o_orderdate",
    )
    freight = _tax_cents(cents("l_extendedprice"), F.col("l_tax")) / 100.0
    days = days_between("l_shipdate", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").withColumn("order_id", F.col("l_orderkey"))
    return lines.join(orders, "order_id", "inner" if chosen else "left").select(
        "order_id",
        F.col("l_linenumber").alias("order_item_id"),
        "date_key",
        "customer_key",
        F.col("l_suppkey").alias("seller_key"),
        F.col("l_partkey").alias("product_key"),
        "order_status",
        F.col("l_extendedprice").alias("price"),
        freight.alias("freight_value"),
        "order_payment_total",
        "payment_type",
        F.ceil(F.col("l_quantity") / 10).cast("int").alias("review_score"),
        days.alias("delivery_days"),
        F.lit(30.0).alias("estimated_days"),
        (days - 30.0).alias("delivery_delta_days"),
    )


STAR_BUILDERS = {
    "dim_dates": star_dates,
    "dim_customers": star_customers,
    "dim_sellers": star_sellers,
    "dim_products": star_products,
    "fact_orders": star_fact,
}


def star(spark: SparkSession, sf_dir: str, **where) -> Tables:
    """The star schema; ``where`` narrows the fact at its source, see ``star_fact``."""
    builders = {**STAR_BUILDERS, "fact_orders": partial(star_fact, **where)}
    return Tables({name: partial(build, spark, sf_dir) for name, build in builders.items()})


# ---- raw datasets -------------------------------------------------------------------


def _id(prefix: str, c: str) -> Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def _at(day: Column, clock: str) -> Column:
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(f" {clock}"))


def _root(c: str) -> Column:
    return F.floor(F.sqrt(F.col(c).cast("double")))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer id per order, several per person; a few zip codes lie outside the geography."""
    person = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    moved = F.when(F.col("c_mktsegment") == "FURNITURE", 1).otherwise(0)
    return orders.join(person, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        _id("c", "o_orderkey").alias("customer_id"),
        _id("u", "o_custkey").alias("customer_unique_id"),
        (_root("c_custkey") + moved).cast("string").alias("customer_zip_code_prefix"),
        F.concat(F.lit("  "), F.lower("n_name"), F.lit(" \t")).alias("customer_city"),
        F.lower(F.substring("c_mktsegment", 1, 2)).alias("customer_state"),
    )


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many rows per zip: customers grouped by the root of their key."""
    person = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    city = F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit(" "), F.lower("n_name")))
    return person.select(
        _root("c_custkey").cast("string").alias("geolocation_zip_code_prefix"),
        (F.col("c_acctbal") / 200.0 - 30.0).alias("geolocation_lat"),
        (F.col("c_acctbal") / -300.0 - F.col("c_nationkey")).alias("geolocation_lng"),
        city.alias("geolocation_city"),
        F.lower(F.substring("c_mktsegment", 1, 2)).alias("geolocation_state"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untidy statuses, one of them unknown, some unparseable timestamps."""
    day, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    open_order = (
        F.when(priority == "5-LOW", "lost").when(priority == "1-URGENT", "canceled").otherwise("processing")
    )
    code = F.col("o_orderstatus")
    late = F.date_add(F.to_date(day), (F.col("o_custkey") % 40 + 3).cast("int"))
    return table(spark, sf_dir, "orders").select(
        _id("o", "o_orderkey").alias("order_id"),
        _id("c", "o_orderkey").alias("customer_id"),
        F.when(code == "F", " delivered ").when(code == "O", "shipped").otherwise(open_order).alias("order_status"),
        _at(day, "10:30:00").alias("order_purchase_timestamp"),
        F.when((code == "O") & (priority == "2-HIGH"), "n/a").otherwise(_at(day, "11:00:00")).alias("order_approved_at"),
        F.when(code != "P", _at(F.date_add(F.to_date(day), 2), "08:00:00")).alias("order_delivered_carrier_date"),
        F.when(code == "F", _at(late, "18:45:30")).alias("order_delivered_customer_date"),
        _at(F.date_add(F.to_date(day), 20), "00:00:00").alias("order_estimated_delivery_date"),
    )


_lines: dict[tuple, DataFrame] = {}


def _files(spark: SparkSession, sf_dir: str) -> list[tuple[str, int, int]]:
    """Name, length and time of every table's files, from the listing."""
    found = []
    for name in COLUMNS:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(path):
            found += [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(path)]
    return found


def state_of(spark: SparkSession, sf_dir: str) -> tuple:
    """Application, folder and the tables' files."""
    return (spark.sparkContext.applicationId, sf_dir, *_files(spark, sf_dir))


def input_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Length of all tables together."""
    return sum(length for _, length, _ in _files(spark, sf_dir))


def forget() -> None:
    """Stage the merged lines anew from here on."""
    _lines.clear()


# The flags and line states that the mapping below tells apart.
FLAGS, LINE_STATES = ("A", "N"), ("F",)


def _rank(c: str, known: tuple[str, ...]) -> Column:
    """Place of a text among ascending known ones: 2k + 1 for the k-th, even numbers between them, null for null.

    It keeps the order, so the least place is that of the least text, and a number is merged without sorting rows.
    """
    out = F.lit(2 * len(known))
    for k, value in reversed(list(enumerate(known))):
        out = F.when(F.col(c) < value, 2 * k).when(F.col(c) == value, 2 * k + 1).otherwise(out)
    return F.when(F.col(c).isNotNull(), out)


def _is(c: str, value: str, known: tuple[str, ...]) -> Column:
    return F.col(c) == 2 * known.index(value) + 1


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items merged per (order, line number), which is not unique in the given table; texts are kept as ``_rank``.

    Written once for each state of the tables: items and payments both start from it. Lines of an order are
    written next to each other, so that its id is compressed there and where they are dealt by it.
    """
    key = state_of(spark, sf_dir)
    if key not in _lines:
        merged = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
            F.min("l_partkey").alias("part"),
            F.min("l_suppkey").alias("supplier"),
            F.min(F.to_date("l_shipdate")).alias("shipped"),
            F.sum(cents("l_extendedprice")).alias("amount"),
            F.min("l_discount").alias("discount"),
            F.min("l_tax").alias("tax"),
            F.min(_rank("l_returnflag", FLAGS)).alias("flag"),
            F.min(_rank("l_linestatus", LINE_STATES)).alias("status"),
            F.max("l_quantity").alias("quantity"),
        )
        lines = merged.withColumn("freight", _tax_cents(F.col("amount"), F.col("tax")))
        _lines[key] = stage(lines.sortWithinPartitions("l_orderkey", "l_linenumber"), "order-lines")
    return _lines[key]


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some prices are negative."""
    returned = _is("flag", "A", FLAGS) & (F.col("discount") == 0.1)
    amount = F.when(returned, -F.col("amount")).otherwise(F.col("amount"))
    return order_lines(spark, sf_dir).select(
        _id("o", "l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _id("p", "part").alias("product_id"),
        _id("s", "supplier").alias("seller_id"),
        _at(F.col("shipped"), "00:00:00").alias("shipping_limit_date"),
        (amount / 100.0).alias("price"),
        (F.col("freight") / 100.0).alias("freight_value"),
    )


# cents by which the payment of a line differs from its invoice, per discount
ADJUSTMENT = {0.0: -1550, 0.01: 50, 0.02: 1, 0.03: 2500, 0.04: 7500, 0.05: -500, 0.06: -50}


def raw_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per line, most of them off by a fixed amount; one type is unknown."""
    change = F.lit(0)
    for discount, amount in ADJUSTMENT.items():
        change = F.when(F.col("discount") == discount, amount).otherwise(change)
    a, n, finished = _is("flag", "A", FLAGS), _is("flag", "N", FLAGS), _is("status", "F", LINE_STATES)
    kind = (
        F.when(a & (F.col("tax") == 0.08), "bitcoin")
        .when(a & finished, " credit_card")
        .when(a, "debit_card ")
        .when(n, "boleto")
        .otherwise("voucher")
    )
    due = (F.col("amount") + F.col("freight") + change) / 100.0
    return order_lines(spark, sf_dir).select(
        _id("o", "l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        kind.alias("payment_type"),
        F.ceil(F.col("quantity") / 10).cast("int").alias("payment_installments"),
        F.when(F.col("quantity") == 1, F.lit(0.0)).otherwise(due).alias("payment_value"),
    )


def raw_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many reviews per order, several a day; scores outside 1 to 5."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        _id("r", "event_id").alias("review_id"),
        _id("o", "user_id").alias("order_id"),
        F.floor(F.col("value") / 40).cast("int").alias("review_score"),
        F.when(kind != "click", F.concat(F.lit("  "), kind, F.lit(" "))).alias("review_comment_title"),
        F.when(kind.isin("view", "purchase"), F.col("props")).alias("review_comment_message"),
        _at(F.col("ts"), "00:00:00").alias("review_creation_date"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("review_answer_timestamp"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A category without a name, one without a translation, measures missing by size."""
    size, price = F.col("p_size"), F.col("p_retailprice")
    return table(spark, sf_dir, "part").select(
        _id("p", "p_partkey").alias("product_id"),
        F.when(F.col("p_type") != "PROMO", F.concat(F.lit(" "), F.lower("p_type"))).alias("product_category_name"),
        F.when(size <= 45, F.length("p_name").cast("double")).alias("product_name_lenght"),
        F.when(size >= 3, size * 10.0).alias("product_description_lenght"),
        F.when(size <= 40, size.cast("double")).alias("product_photos_qty"),
        F.when(size != 7, price).alias("product_weight_g"),
        (size + 0.5).cast("double").alias("product_length_cm"),
        F.when(size >= 10, size / 2.0).alias("product_height_cm"),
        (price / 10.0).alias("product_width_cm"),
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "supplier")
        .join(places, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(
            _id("s", "s_suppkey").alias("seller_id"),
            (_root("s_suppkey") + 30).cast("string").alias("seller_zip_code_prefix"),
            F.concat(F.lower("n_name"), F.lit("  ")).alias("seller_city"),
            F.lower(F.substring("n_name", 1, 2)).alias("seller_state"),
        )
    )


def raw_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = table(spark, sf_dir, "part").select("p_type").distinct()
    return kinds.filter(~F.col("p_type").isin("PROMO", "SMALL")).select(
        F.lower("p_type").alias("product_category_name"),
        F.concat(F.lower("p_type"), F.lit("_en")).alias("product_category_name_english"),
    )


RAW_BUILDERS = {
    "customers": raw_customers,
    "geolocation": raw_geolocation,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "order_payments": raw_order_payments,
    "order_reviews": raw_order_reviews,
    "products": raw_products,
    "sellers": raw_sellers,
    "category_translation": raw_category_translation,
}


def raw(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables({name: partial(build, spark, sf_dir) for name, build in RAW_BUILDERS.items()})
