"""Data profiling of the raw tables: shape, distributions, keys, coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from tallyhouse.functions.columns import ratio
from tallyhouse.operators.groups import group_quantiles, melt
from tallyhouse.operators.selection import double_form, quantiles
from tallyhouse.operators.staging import stage
from tallyhouse.plans.integrity import stack
from tallyhouse.schemas import ORDER_TIMESTAMPS

Raw = Mapping[str, DataFrame]

FOREIGN_KEYS = (
    ("orders", "customer_id", "customers"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
    ("order_items", "seller_id", "sellers"),
    ("order_payments", "order_id", "orders"),
    ("order_reviews", "order_id", "orders"),
)
CHILDREN = ("order_items", "order_payments", "order_reviews")
PHYSICAL = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
DERIVED = ("product_name_lenght", "product_description_lenght")
QUARTILES = (0.25, 0.5, 0.75)


def _rows() -> Column:
    return F.count(F.lit(1))


def _name(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.select(F.lit(value).alias(column), *df.columns)


# ---- shape and columns -----------------------------------------------------------------


def dataset_summary(raw: Raw) -> DataFrame:
    """Rows, columns and exact duplicate rows per dataset."""
    parts = []
    for name, df in raw.items():
        groups = df.groupBy(*df.columns).agg(_rows().alias("_n"))
        one = groups.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
            F.lit(len(df.columns)).alias("columns"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
        )
        parts.append(_name(one, "dataset", name))
    return stack(parts)


def profile_all(raw: Raw) -> DataFrame:
    """``column_profile`` of every dataset."""
    return stack([_name(column_profile(df), "dataset", name) for name, df in raw.items()])


def describe_all(raw: Raw) -> DataFrame:
    """``describe`` of the numeric columns of every dataset that has any."""
    return _described({name: (df, numeric_columns(df)) for name, df in raw.items()})


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: type, non-null count, distinct values, percent missing.

    Cells become (column, 128-bit fingerprint) pairs and are counted per distinct pair, in the
    tasks first, so one shuffle serves every column and a cell weighs the same whatever its text.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    cells = melt(df, [], df.columns, "string")
    seen = F.col("value").isNotNull()
    prints = [F.when(seen, F.xxhash64(F.lit(salt), "value")).alias(f"print{salt}") for salt in (1, 2)]
    counted = cells.select("column", seen.alias("seen"), *prints).groupBy("column", "seen", "print1", "print2").agg(_rows().alias("n"))
    per_column = counted.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("seen"), F.col("n"))), F.lit(0)).alias("non_null"),
        F.count_if("seen").alias("n_unique"),
        F.sum("n").alias("rows"),
    )
    kind = F.lit(None).cast("string")
    for c, t in types.items():
        kind = F.when(F.col("column") == c, t).otherwise(kind)
    missing = ratio((F.col("rows") - F.col("non_null")) * 100, F.col("rows"))
    return per_column.select("column", kind.alias("dtype"), "non_null", "n_unique", missing.alias("missing_pct"))


def significant(x: Column, digits: int = 10) -> Column:
    """``x`` to so many significant digits, so that the order in which tasks finish does not show."""
    return F.format_string(f"%.{digits - 1}e", x).cast("double")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per numeric column: count, mean, sample deviation, min, quartiles, max.

    Mean and deviation are of any magnitude, to ten significant digits; the rest is exact.
    """
    return _described({"": (df, columns)}).drop("dataset")


def _described(parts: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """``describe`` of the columns of several datasets, whose quartiles are selected together."""
    parts = {name: (df, columns) for name, (df, columns) in parts.items() if columns}
    long = stack([_name(melt(df, [], columns, "double"), "dataset", name) for name, (df, columns) in parts.items()])
    stats = long.groupBy("dataset", "column").agg(
        F.count("value").alias("count"),
        significant(F.avg("value")).alias("mean"),
        significant(F.stddev_samp("value")).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    names = {str(k): name for k, name in enumerate((name, c) for name, (_, columns) in parts.items() for c in columns)}
    series = {name: k for k, name in names.items()}
    keys = stack([double_form(df, {series[name, c]: c for c in columns}) for name, (df, columns) in parts.items()])
    found = quantiles(keys, QUARTILES)
    rows = [(*names[k], *[found[k, p] for p in QUARTILES]) for k in names if (k, QUARTILES[0]) in found]  # one per column
    wide = long.sparkSession.createDataFrame(rows, "dataset string, column string, p25 double, p50 double, p75 double")
    return stats.join(F.broadcast(wide), ["dataset", "column"], "left").select(
        "dataset", "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


# ---- keys and relations -------------------------------------------------------------------


def children_per_parent(raw: Raw) -> DataFrame:
    """Rows per order in each child table: mean, median, max, single-row share, more than one row."""
    parts = []
    for child in CHILDREN:
        sizes = raw[child].groupBy("order_id").agg(_rows().alias("n"))
        parts.append(_name(_size_stats(sizes), "child", child))
    return stack(parts)


def _size_stats(sizes: DataFrame) -> DataFrame:
    """Statistics of a column ``n`` of group sizes, which is staged, as the median is selected in passes."""
    n, sizes = F.col("n"), stage(sizes.select("n"), "sizes")
    medians = group_quantiles(sizes, [], ["n"], [0.5]).agg(F.max("value")).scalar()
    one = sizes.agg(
        _rows().alias("parents"),
        ratio(F.sum(n), _rows()).alias("mean"),
        F.max(n).alias("max"),
        F.count_if(n == 1).alias("single"),
        F.count_if(n > 1).alias("multiple"),
    )
    return one.select(
        "parents", "mean", medians.alias("median"), "max", "single", ratio(F.col("single"), F.col("parents")).alias("single_share"), "multiple"
    )


def cardinalities(raw: Raw) -> DataFrame:
    """Children per foreign key value: mean, max, and values with more than one child."""
    return _foreign_values(raw).groupBy("relation").agg(
        _rows().alias("parents"),
        ratio(F.sum("n"), _rows()).alias("mean"),
        F.max("n").alias("max"),
        F.count_if(F.col("n") > 1).alias("multiple"),
    )


def _foreign_values(raw: Raw) -> DataFrame:
    """relation, parent, value, n: rows per foreign key value, each child table read once for all its keys."""
    parts = []
    for child in dict.fromkeys(c for c, _, _ in FOREIGN_KEYS):
        keys = [(fk, parent) for c, fk, parent in FOREIGN_KEYS if c == child]
        cells = [
            F.struct(F.lit(f"{child}.{fk} -> {parent}").alias("relation"), F.lit(parent).alias("parent"), F.col(fk).alias("value")) for fk, parent in keys
        ]
        parts.append(raw[child].select(F.inline(F.array(*cells))))
    return stack(parts).filter("value is not null").groupBy("relation", "parent", "value").agg(_rows().alias("n"))


def orphans(raw: Raw) -> DataFrame:
    """Distinct foreign key values without a parent row."""
    parents = stack([
        raw[parent].select(F.lit(parent).alias("parent"), F.col(fk).alias("value")) for parent, fk in dict.fromkeys((p, fk) for _, fk, p in FOREIGN_KEYS)
    ])
    met = _foreign_values(raw).join(parents.distinct().withColumn("known", F.lit(1)), ["parent", "value"], "left")
    return met.groupBy("relation").agg(F.count_if(F.col("known").isNull()).alias("orphans"))


def child_histogram(raw: Raw, child: str, clip: int | None = None) -> DataFrame:
    """How many orders have 1, 2, 3 ... rows, larger counts folded into ``clip``."""
    n = F.col("n") if clip is None else F.least(F.col("n"), F.lit(clip))
    sizes = raw[child].groupBy("order_id").agg(_rows().alias("n"))
    return sizes.groupBy(n.alias("rows_per_order")).agg(_rows().alias("orders"))


def histogram(df: DataFrame, column: str, bins: int = 50, clip: float | None = None) -> DataFrame:
    """Equal-width bins between the minimum and the (clipped) maximum; the last bin is closed."""
    value = F.col(column) if clip is None else F.least(F.col(column), F.lit(clip))
    values = df.filter(F.col(column).isNotNull()).select(value.cast("double").alias("x"))
    edges = values.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    lo, width = edges.getField("lo"), (edges.getField("hi") - edges.getField("lo")) / bins
    place = F.coalesce(F.floor(F.try_divide(F.col("x") - lo, width)), F.lit(0))
    return values.groupBy(F.least(place, F.lit(bins - 1)).alias("bin")).agg(_rows().alias("n"))


# ---- geography ---------------------------------------------------------------------------


def zip_sizes(raw: Raw) -> DataFrame:
    return raw["geolocation"].groupBy("geolocation_zip_code_prefix").agg(_rows().alias("n"))


def rows_per_zip(raw: Raw) -> DataFrame:
    """Rows per zip prefix: zips, mean, median, max."""
    return _size_stats(zip_sizes(raw)).select(F.col("parents").alias("zips"), "mean", "median", "max")


def coordinate_spread(raw: Raw) -> DataFrame:
    """Description of the per-zip deviations of latitude and longitude, zips with several rows only."""
    per_zip = raw["geolocation"].groupBy("geolocation_zip_code_prefix").agg(
        F.round(F.stddev_samp("geolocation_lat"), 6).alias("lat_std"),
        F.round(F.stddev_samp("geolocation_lng"), 6).alias("lng_std"),
    )
    spread = stage(per_zip.select("lat_std", "lng_std").dropna(), "spread")
    return describe(spread, ["lat_std", "lng_std"])


def spellings_per_zip(raw: Raw) -> DataFrame:
    """Zips with more than one city or state spelling."""
    cells = melt(
        raw["geolocation"], ["geolocation_zip_code_prefix"], ["geolocation_city", "geolocation_state"], "string"
    ).filter(F.col("value").isNotNull())
    per_zip = (
        cells.distinct().groupBy("geolocation_zip_code_prefix", "column").agg(_rows().alias("spellings"))
    )
    several = F.count_if((F.col("spellings") > 1) & (F.col("column") == "geolocation_city"))
    states = F.count_if((F.col("spellings") > 1) & (F.col("column") == "geolocation_state"))
    return per_zip.agg(several.alias("zips_with_several_cities"), states.alias("zips_with_several_states"))


def zip_coverage(raw: Raw) -> DataFrame:
    """Distinct zips of customers and sellers, how many are in the geography, key uniqueness."""
    known = raw["geolocation"].select(F.col("geolocation_zip_code_prefix").alias("zip")).distinct()
    parts = []
    for name, key, column in (
        ("customers", "customer_id", "customer_zip_code_prefix"),
        ("sellers", "seller_id", "seller_zip_code_prefix"),
    ):
        zips = raw[name].select(F.col(column).alias("zip")).filter("zip is not null").distinct()
        matched = zips.join(known.withColumn("hit", F.lit(1)), "zip", "left")
        keys = raw[name].groupBy(key).agg(_rows().alias("n"))
        unique = keys.agg(F.coalesce(F.max("n"), F.lit(0)) <= 1).scalar()
        one = matched.agg(_rows().alias("zips"), F.count("hit").alias("matched")).select(
            "zips",
            "matched",
            ratio(F.col("matched") * 100, F.col("zips")).alias("matched_pct"),
            unique.cast("bigint").alias("key_is_unique"),
        )
        parts.append(_name(one, "dataset", name))
    return stack(parts)


# ---- values --------------------------------------------------------------------------------


def ids_per_person(raw: Raw) -> DataFrame:
    """Customer ids per person: how many persons have 1, 2, 3 ... ids, with the recurrent share."""
    ids = raw["customers"].select("customer_unique_id", "customer_id").distinct()
    per_person = ids.groupBy("customer_unique_id").agg(_rows().alias("ids"))
    spread = per_person.groupBy("ids").agg(_rows().alias("persons"))
    everyone = W.partitionBy()
    recurrent = F.sum(F.when(F.col("ids") > 1, F.col("persons")).otherwise(0)).over(everyone)
    people = F.sum("persons").over(everyone)
    return spread.select("ids", "persons", ratio(recurrent * 100, people).alias("recurrent_pct"))


def value_counts(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Most frequent values first, nulls left out."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(_rows().alias("n"))
    ordered = counts.orderBy(F.desc("n"), "value")
    return ordered if k is None else ordered.limit(k)


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Counts with their percentage of all non-null rows."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(_rows().alias("n"))
    share = F.round(ratio(F.col("n") * 100, counts.agg(F.sum("n")).scalar()), 2)
    return counts.withColumn("pct", share).orderBy(F.desc("n"), "value")


def _stamps(orders: DataFrame) -> DataFrame:
    return orders.withColumns({c: F.col(c).try_cast("timestamp_ntz") for c in ORDER_TIMESTAMPS})


def date_ranges(raw: Raw) -> DataFrame:
    """First and last day and null count per order timestamp."""
    stamps = _stamps(raw["orders"])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.to_date(c).alias("day")) for c in ORDER_TIMESTAMPS])
    long = stamps.select(F.inline(cells))
    return long.groupBy("column").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count_if(F.col("day").isNull()).alias("nulls")
    )


def orders_per_month(raw: Raw) -> DataFrame:
    """Orders per calendar month between the first and the last, empty months included."""
    bought = F.col("order_purchase_timestamp").try_cast("timestamp_ntz")
    per_month = (
        raw["orders"]
        .select(F.trunc(F.to_date(bought), "month").alias("month"))
        .filter("month is not null")
        .groupBy("month")
        .agg(_rows().alias("n"))
    )
    span = per_month.agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    calendar = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month"))
    return calendar.join(per_month, "month", "left").select("month", F.coalesce("n", F.lit(0)).alias("orders"))


def null_stamps_by_status(raw: Raw) -> DataFrame:
    stamps = _stamps(raw["orders"])
    missing = [F.count_if(F.col(c).isNull()).alias(c) for c in ORDER_TIMESTAMPS[1:]]
    return stamps.groupBy("order_status").agg(*missing)


def payment_mixes(raw: Raw) -> DataFrame:
    """Orders that mix payment types."""
    kinds = raw["order_payments"].select("order_id", "payment_type").distinct()
    per_order = kinds.groupBy("order_id").agg(F.count("payment_type").alias("kinds"))
    mixed = F.count_if(F.col("kinds") > 1)
    return per_order.agg(
        _rows().alias("orders"), mixed.alias("mixed_orders"), ratio(mixed * 100, _rows()).alias("mixed_pct")
    )


def payment_types(raw: Raw) -> DataFrame:
    """Rows and zero-value rows per payment type."""
    return raw["order_payments"].groupBy("payment_type").agg(
        _rows().alias("n"), F.count_if(F.col("payment_value") == 0).alias("zero_value")
    )


def empty_texts(raw: Raw) -> DataFrame:
    title, message = F.col("review_comment_title"), F.col("review_comment_message")
    return raw["order_reviews"].agg(
        ratio(F.count_if(message.isNull()), _rows()).alias("message_empty"),
        ratio(F.count_if(title.isNull()), _rows()).alias("title_empty"),
    )


def missing_columns(df: DataFrame) -> DataFrame:
    """Columns with nulls, in one pass over the table."""
    counts = df.agg(_rows().alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("null_count")) for c in df.columns])
    long = counts.select("_rows", F.inline(cells)).filter("null_count > 0")
    return long.select("column", "null_count", F.round(ratio(F.col("null_count") * 100, F.col("_rows")), 2).alias("pct"))


def untranslated_categories(raw: Raw) -> DataFrame:
    """Categories in use without a translation."""
    used = raw["products"].select("product_category_name").filter("product_category_name is not null")
    return used.subtract(raw["category_translation"].select("product_category_name"))


def price_range(raw: Raw) -> DataFrame:
    return raw["order_items"].agg(
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.min("freight_value").alias("min_freight"),
        F.max("freight_value").alias("max_freight"),
    )
