"""Cleaning of the nine raw datasets. Duplicates go before stripping, as the order matters."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyhouse.functions.columns import at_least, clamp, pad_zip, strip, title_case
from tallyhouse.operators.groups import group_medians, group_modes
from tallyhouse.operators.staging import at_once, stage
from tallyhouse.schemas import ORDER_STATUSES, ORDER_TIMESTAMPS, PAYMENT_TYPES

PRODUCT_MEASURES = (
    "product_name_lenght",
    "product_description_lenght",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
)


class CleaningLog:
    """What the cleaners drop, each count an aggregate of its own, so that none can be missing."""

    def __init__(self) -> None:
        self._counters: dict[str, DataFrame] = {}

    def watch(self, df: DataFrame, label: str, counter: Column) -> DataFrame:
        self._counters[label] = df.agg(counter.alias("n"))
        return df

    def note(self, spark: SparkSession, label: str, n: int) -> None:
        """A count that is known already."""
        self._counters[label] = spark.range(1).select(F.lit(n).cast("bigint").alias("n"))

    def table(self) -> DataFrame:
        """measure, n: one row per counter."""
        parts = [df.select(F.lit(label).alias("measure"), "n") for label, df in sorted(self._counters.items())]
        return reduce(DataFrame.unionByName, parts)

    def counts(self) -> dict[str, int]:
        return {r["measure"]: r["n"] for r in self.table().collect()}  # one row per counter


# ---- building blocks ------------------------------------------------------------


#: Upper bits of a row's hash that are compared at first; fewer bits are fewer bytes to exchange.
PRINT_BITS = 48


def drop_full_duplicates(df: DataFrame, log: CleaningLog | None = None, label: str = "rows") -> DataFrame:
    """Distinct whole rows.

    With a log the rows' hashes alone are exchanged first. Rows whose hash no other row has are distinct;
    where that holds for all, ``df`` is the result, read again and neither exchanged nor written. Otherwise rows
    that share a hash are compared whole, and the distinct rows are staged with their multiplicities, so that rows
    in and rows distinct are sums over the written table, which also serves whatever reads the result.
    """
    if log is None:
        return df.dropDuplicates()
    copies = _free("copies", df)
    rows_in, rows_shared, shared = _shared_prints(df)
    if not rows_shared:
        for count in ("in", "distinct"):
            log.note(df.sparkSession, f"{label} {count}", rows_in)
        return df
    counted = stage(_counted(df, shared, copies), "distinct")
    log.watch(counted, f"{label} in", F.coalesce(F.sum(copies), F.lit(0)))
    return log.watch(counted, f"{label} distinct", F.count(F.lit(1))).drop(copies)


def _free(name: str, df: DataFrame) -> str:
    """A column name that the table does not have."""
    while name in df.columns:
        name += "_"
    return name


def _print(df: DataFrame) -> Column:
    """Equal rows have equal ones, as 0.0 and -0.0 hash alike, and all NaN."""
    return F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), 64 - PRINT_BITS)


def _shared_prints(df: DataFrame) -> tuple[int, int, DataFrame]:
    """How many rows there are, how many of them share their print with another row, and the prints these have."""
    counts = df.select(_print(df).alias("print")).groupBy("print").agg(F.count(F.lit(1)).alias("n"))
    shared = F.col("n") > 1
    found = counts.agg(F.sum("n").alias("rows"), F.sum(F.when(shared, F.col("n"))).alias("shared")).first()  # one row
    return found.rows or 0, found.shared or 0, counts.filter(shared).select("print")


def _counted(df: DataFrame, shared: DataFrame, copies: str) -> DataFrame:
    """Distinct rows with their multiplicities; only rows of shared prints are grouped."""
    mark, columns = _free("print", df), [F.col(f"`{c}`") for c in df.columns]
    marked, among = df.withColumn(mark, _print(df)), stage(shared.withColumnRenamed("print", mark), "prints")
    alone = marked.join(among, mark, "left_anti").select(*columns, F.lit(1).cast("bigint").alias(copies))
    several = marked.join(among, mark, "left_semi").groupBy(*columns).agg(F.count(F.lit(1)).alias(copies))
    return alone.unionByName(several)


def parse_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Unparseable text becomes null; columns the table does not have are skipped."""
    return df.withColumns({c: F.col(c).try_cast("timestamp_ntz") for c in columns if c in df.columns})


def strip_strings(df: DataFrame, but: Sequence[str] = ()) -> DataFrame:
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in but]
    return df.withColumns({c: strip(c) for c in text}) if text else df


def distinct_stripped(df: DataFrame, by: str, log: CleaningLog | None = None, label: str = "rows") -> DataFrame:
    """Distinct whole rows, their texts stripped.

    Without a log the rows are dealt by the stripped ``by`` before copies are dropped. What joins or groups
    by it next finds them in place, so one exchange serves both. The raw text stays beside it where it differs,
    as copies are found before stripping.
    """
    if log is not None:
        return strip_strings(drop_full_duplicates(df, log, label))
    bare = _free("bare", df)
    dealt = df.withColumn(bare, strip(by)).withColumn(by, F.when(F.col(by) != F.col(bare), F.col(by))).repartition(bare)
    found = dealt.dropDuplicates().select(*[F.col(bare).alias(by) if c == by else F.col(f"`{c}`") for c in df.columns])
    return strip_strings(found, but=[by])


def normalise_place(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumns(
        {
            f"{prefix}_city": title_case(f"{prefix}_city"),
            f"{prefix}_state": F.upper(f"{prefix}_state"),
            f"{prefix}_zip_code_prefix": pad_zip(f"{prefix}_zip_code_prefix"),
        }
    )


def keep_domain(df: DataFrame, column: str, allowed: Sequence[str], log: CleaningLog | None = None) -> DataFrame:
    """Drop rows whose value is null or outside the domain."""
    valid = F.coalesce(F.col(column).isin(*allowed), F.lit(False))
    if log is not None:
        df = log.watch(df, f"{column} rejected", F.count_if(~valid))
    return df.filter(valid)


# ---- one cleaner per dataset ------------------------------------------------------


def clean_customers(df: DataFrame, log: CleaningLog | None = None) -> DataFrame:
    return normalise_place(strip_strings(drop_full_duplicates(df, log, "customers")), "customer")


def clean_sellers(df: DataFrame, log: CleaningLog | None = None) -> DataFrame:
    return normalise_place(strip_strings(drop_full_duplicates(df, log, "sellers")), "seller")


def clean_geolocation(df: DataFrame, log: CleaningLog | None = None) -> DataFrame:
    """One row per zip prefix. Repeated rows are kept: they weigh the median and the mode."""
    places = normalise_place(strip_strings(df), "geolocation")
    zip_code = ["geolocation_zip_code_prefix"]
    places = places.filter(F.col(zip_code[0]).isNotNull())
    names = group_modes(places, zip_code, ["geolocation_city", "geolocation_state"])
    points = group_medians(places, zip_code, ["geolocation_lat", "geolocation_lng"])
    return names.join(points, zip_code, "left").select(df.columns)


def clean_orders(df: DataFrame, log: CleaningLog | None = None) -> DataFrame:
    df = parse_timestamps(strip_strings(drop_full_duplicates(df, log, "orders")), ORDER_TIMESTAMPS)
    return keep_domain(df, "order_status", ORDER_STATUSES, log)


def clean_order_items(df: DataFrame, log: CleaningLog | None = None) -> DataFrame:
    df = parse_timestamps(distinct_stripped(df, "order_id", log, "order_items"), ["shipping_limit_date"])
    return df.withColumns({c: at_least(c, 0.0) for c in ("price", "freight_value")})


def clean_order_payments(df: DataFrame, log: CleaningLog | None = None) -> DataFrame:
    df = distinct_stripped(df, "order_id", log, "order_payments")
    return keep_domain(df, "payment_type", PAYMENT_TYPES, log).withColumn(
        "payment_value", at_least("payment_value", 0.0)
    )


def clean_order_reviews(df: DataFrame, log: CleaningLog | None = None) -> DataFrame:
    df = strip_strings(drop_full_duplicates(df, log, "order_reviews"))
    df = df.withColumn("review_score", clamp("review_score", 1, 5))
    df = df.fillna("", ["review_comment_title", "review_comment_message"])
    return parse_timestamps(df, ["review_creation_date", "review_answer_timestamp"])


def clean_products(df: DataFrame, translation: DataFrame, log: CleaningLog | None = None) -> DataFrame:
    df = strip_strings(drop_full_duplicates(df, log, "products"))
    df = df.join(strip_strings(translation), "product_category_name", "left")
    df = df.fillna("unknown", ["product_category_name", "product_category_name_english"])
    return impute_medians(df, [c for c in PRODUCT_MEASURES if c in df.columns])


def impute_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill nulls with the column's median over the whole table (left null if there is none).

    The table is staged, as medians are selected in several passes over it.
    """
    held = stage(df, "imputed")
    found = group_medians(held, [], columns).first()  # one row
    return held.withColumns({c: F.coalesce(c, F.lit(found[c] if found else None).cast("double")) for c in columns})


def clean_category_translation(df: DataFrame, log: CleaningLog | None = None) -> DataFrame:
    return strip_strings(drop_full_duplicates(df, log, "category_translation"))


# ---- registry ----------------------------------------------------------------------

CLEANERS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "customers": (clean_customers, ()),
    "sellers": (clean_sellers, ()),
    "geolocation": (clean_geolocation, ()),
    "category_translation": (clean_category_translation, ()),
    "products": (clean_products, ("category_translation",)),
    "orders": (clean_orders, ()),
    "order_items": (clean_order_items, ()),
    "order_payments": (clean_order_payments, ()),
    "order_reviews": (clean_order_reviews, ()),
}


def clean_all(raw: Mapping[str, DataFrame], log: CleaningLog | None = None) -> dict[str, DataFrame]:
    """Clean every dataset; a cleaner receives the cleaned datasets it depends on.

    What cleaners stage, they stage at once.
    """
    inputs, done = {name: raw[name] for name in CLEANERS}, {}
    for depends in (False, True):
        names = [n for n, (_, needs) in CLEANERS.items() if bool(needs) == depends]
        clean = lambda n: CLEANERS[n][0](inputs[n], *[done[d] for d in CLEANERS[n][1]], log=log)
        done |= zip(names, at_once([partial(clean, n) for n in names]))
    return {n: done[n] for n in CLEANERS}
