"""Integrity checks and result comparison. Every check is a job that returns (check, n_violations)."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from tallyhouse.functions.columns import at_least, days_between, halves, money, money_sum, money_total, pad_zip, ratio, strip, whole
from tallyhouse.operators.groups import group_medians, latest_per_group
from tallyhouse.operators.ranking import Ranking, asc, rank_all
from tallyhouse.operators.staging import stage

Tables = Mapping[str, DataFrame]

UNIQUE = {
    "dim_geolocation": [["zip_code_prefix"]],
    "dim_customers": [["customer_id"]],
    "dim_sellers": [["seller_id"]],
    "dim_products": [["product_id"]],
    "dim_dates": [["date_key"]],
    "fact_orders": [["order_id", "order_item_id"]],
}
SURROGATES = {
    "dim_customers": "customer_key",
    "dim_sellers": "seller_key",
    "dim_products": "product_key",
    "dim_geolocation": "geo_key",
}
REQUIRED = {
    "dim_dates": ["full_date", "year", "quarter", "month", "day", "day_of_week", "day_name", "is_weekend"],
    "dim_geolocation": ["zip_code_prefix"],
    "dim_customers": ["customer_id", "customer_unique_id"],
    "dim_sellers": ["seller_id"],
    "dim_products": ["product_id"],
    "fact_orders": ["order_id", "order_item_id", "price", "freight_value"],
}
FOREIGN = (
    ("fact_orders", "date_key", "dim_dates", "date_key"),
    ("fact_orders", "customer_key", "dim_customers", "customer_key"),
    ("fact_orders", "seller_key", "dim_sellers", "seller_key"),
    ("fact_orders", "product_key", "dim_products", "product_key"),
    ("fact_orders", "customer_geo_key", "dim_geolocation", "geo_key"),
    ("fact_orders", "seller_geo_key", "dim_geolocation", "geo_key"),
    ("dim_customers", "geo_key", "dim_geolocation", "geo_key"),
    ("dim_sellers", "geo_key", "dim_geolocation", "geo_key"),
)


def stack(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """All rules in one pass, one output row per rule."""
    names = list(rules)
    one = df.agg(*[F.count_if(rule).alias(f"c{i}") for i, rule in enumerate(rules.values())])
    pairs = [F.struct(F.lit(n).alias("check"), F.col(f"c{i}").alias("n_violations")) for i, n in enumerate(names)]
    return one.select(F.inline(F.array(*pairs)))


def _single(df: DataFrame, check: str) -> DataFrame:
    """Count of the rows of ``df`` as one check."""
    return df.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit(check).alias("check"), "n_violations")


# ---- constraints of the published tables ----------------------------------------------


def uniqueness(tables: Tables, but: Collection[str] = ()) -> DataFrame:
    """Key values that occur more than once, in all tables ``but`` some."""
    parts = []
    for name, keys in UNIQUE.items():
        for key in keys if name not in but else ():
            twice = tables[name].groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            parts.append(_single(twice, f"unique {name}.{'+'.join(key)}"))
    return stack(parts)


def value_rules(tables: Tables) -> DataFrame:
    score = F.col("review_score")
    return _counts(
        tables["fact_orders"],
        {
            "price >= 0": F.col("price") < 0,
            "freight_value >= 0": F.col("freight_value") < 0,
            "review_score in 1..5": ~score.between(1, 5),
        },
    )


def required_values(tables: Tables, but: Collection[str] = ()) -> DataFrame:
    parts = []
    for name, columns in REQUIRED.items():
        if name in but:
            continue
        rules = {f"not null {name}.{c}": F.col(c).isNull() for c in columns}
        if name in SURROGATES:
            key = SURROGATES[name]
            rules[f"positive {name}.{key}"] = F.coalesce(F.col(key) <= 0, F.lit(True))
        parts.append(_counts(tables[name], rules))
    return stack(parts)


def referential(tables: Tables) -> DataFrame:
    """Rows whose non-null foreign key has no parent row.

    Where the keys of a parent are all whole numbers from its least to its greatest, as dense surrogate keys are,
    a key between them has a parent and goes no further. All other keys of a child table are taken in one scan as
    (relation, key) pairs and counted per pair before the join, so a hot key meets its parent as one
    row. Relations and parents are numbers until the end: a pair is two numbers to the grouping and the
    exchange, not three with two texts.
    """
    numbered = {parent: k for k, parent in enumerate(dict.fromkeys((parent, pk) for _, _, parent, pk in FOREIGN))}
    parents = {k: tables[parent].select(F.lit(k).alias("parent"), F.col(pk).cast("bigint").alias("key")) for (parent, pk), k in numbered.items()}
    runs = _whole_runs(parents)
    by_child: dict[str, list[Column]] = {}
    relations = []
    for number, (child, fk, parent, pk) in enumerate(FOREIGN):
        k, key = numbered[parent, pk], F.col(fk).cast("bigint")
        relations.append((number, k, f"{child}.{fk} -> {parent}"))
        open_key = F.when(~key.between(*map(F.lit, runs[k])), key) if k in runs else key
        by_child.setdefault(child, []).append(F.struct(F.lit(number).alias("relation"), open_key.alias("key")))
    pairs = stack([tables[child].select(F.inline(F.array(*cells))) for child, cells in by_child.items()])
    keys = pairs.filter("key is not null").groupBy("relation", "key").agg(F.count(F.lit(1)).alias("n"))
    parent_of = F.array(*[F.lit(parent) for _, parent, _ in relations])
    lost = keys.withColumn("parent", F.get(parent_of, "relation"))
    with_gaps = [ids for k, ids in parents.items() if k not in runs]
    if with_gaps:
        lost = lost.join(stack(with_gaps), ["parent", "key"], "left_anti")
    checks = pairs.sparkSession.createDataFrame([(number, check) for number, _, check in relations], "relation int, check string")
    counted = checks.join(lost.groupBy("relation").agg(F.sum("n").alias("n")), "relation", "left")
    return counted.select("check", F.coalesce("n", F.lit(0)).alias("n_violations"))


def _whole_runs(parents: Mapping[int, DataFrame]) -> dict[int, tuple[int, int]]:
    """Least and greatest key of every parent that has all whole numbers between them as keys.

    Only parents with as many keys as that are looked at twice. Each key sets its bit in a map of 4 KB for
    32768 numbers, so about an eighth of a byte a number is exchanged where keys are stored in order.
    """
    ends = stack([ids.groupBy("parent").agg(F.min("key").alias("least"), F.max("key").alias("greatest"), F.count("key").alias("n")) for ids in parents.values()])
    found = {r.parent: r for r in ends.collect() if r.n and r.greatest - r.least + 1 == r.n}  # one row per parent
    if not found:
        return {}
    placed = stack([parents[k].filter("key is not null").select("parent", (F.col("key") - F.lit(r.least) + 1).alias("place")) for k, r in found.items()])
    maps = placed.groupBy("parent", F.bitmap_bucket_number("place").alias("map")).agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("place"))).alias("seen"))
    seen = {r.parent: r.seen for r in maps.groupBy("parent").agg(F.sum("seen").alias("seen")).collect()}  # one row per parent
    return {k: (r.least, r.greatest) for k, r in found.items() if seen[k] == r.n}


def date_dimension(tables: Tables) -> DataFrame:
    day, key = F.col("full_date"), F.col("date_key")
    agrees = (F.year(day) == F.col("year")) & (F.month(day) == F.col("month")) & (F.day(day) == F.col("day"))
    parts = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    return _counts(
        tables["dim_dates"],
        {
            "date_key in 20000101..20991231": ~key.between(20000101, 20991231),
            "date parts agree": ~agrees,
            "date_key agrees with parts": key != parts,
        },
    )


def constraint_violations(tables: Tables, fact_holds: bool = False) -> DataFrame:
    """What must hold before a snapshot is published.

    ``fact_holds`` says that the fact's rows are known to keep the rules on them alone; its foreign keys are looked up all the same.
    """
    but = ["fact_orders"] if fact_holds else []
    rows = [uniqueness(tables, but), *([] if fact_holds else [value_rules(tables)]), required_values(tables, but)]
    return stack([*rows, referential(tables)])


# ---- raw against warehouse -------------------------------------------------------------


def row_counts(raw: Tables, star: Tables) -> DataFrame:
    """Rows per table against distinct raw keys (distinct raw rows for the fact)."""
    expected = {
        "dim_customers": raw["customers"].agg(F.countDistinct("customer_id").alias("expected")),
        "dim_sellers": raw["sellers"].agg(F.countDistinct("seller_id").alias("expected")),
        "dim_products": raw["products"].agg(F.countDistinct("product_id").alias("expected")),
        "dim_geolocation": raw["geolocation"].agg(F.countDistinct("geolocation_zip_code_prefix").alias("expected")),
        "fact_orders": raw["order_items"].distinct().agg(F.count(F.lit(1)).alias("expected")),
    }
    parts = [
        one.select(
            F.lit(name).alias("check"),
            "expected",
            star[name].agg(F.count(F.lit(1))).scalar().alias("actual"),
        )
        for name, one in expected.items()
    ]
    return stack(parts).withColumn("n_violations", F.abs(F.col("expected") - F.col("actual")))


def revenue_totals(raw: Tables, star: Tables, tolerance: float = 1e-6) -> DataFrame:
    """Price and freight sums within a relative tolerance."""
    amounts = ("price", "freight_value")
    totals = raw["order_items"].distinct().agg(*[money_total(at_least(c, 0.0)).alias(f"raw_{c}") for c in amounts])
    stored = star["fact_orders"].agg(F.struct(*[money_total(c).alias(c) for c in amounts]).alias("s")).scalar()
    pairs = [F.struct(F.lit(c).alias("check"), F.col(f"raw_{c}").alias("raw_total"), F.col("s").getField(c).alias("total")) for c in amounts]
    gap = F.abs(F.col("total") - F.col("raw_total")).cast("double")
    return totals.withColumn("s", stored).select(F.inline(F.array(*pairs))).withColumn("n_violations", (gap > F.abs(F.col("raw_total").cast("double")) * tolerance).cast("bigint"))


def payment_totals(clean: Tables, star: Tables) -> DataFrame:
    """Every order's payment total, and the grand total over the orders of the fact."""
    raw = clean["order_payments"].groupBy("order_id").agg(money_sum("payment_value").alias("raw_total"))
    fact = (
        star["fact_orders"]
        .groupBy("order_id")
        .agg(money(F.max("order_payment_total")).alias("total"))
    )
    both = fact.join(raw, "order_id", "left")
    differs = ~F.col("total").eqNullSafe(F.col("raw_total"))
    grand = F.sum("total") != F.sum(F.when(F.col("total").isNotNull(), F.col("raw_total")))
    one = both.agg(F.count_if(differs).alias("a"), F.coalesce(grand, F.lit(False)).cast("bigint").alias("b"))
    return one.select(
        F.inline(
            F.array(
                F.struct(F.lit("payment total per order").alias("check"), F.col("a").alias("n_violations")),
                F.struct(F.lit("payment grand total").alias("check"), F.col("b").alias("n_violations")),
            )
        )
    )


def latest_reviews(clean: Tables, star: Tables) -> DataFrame:
    """Fact rows whose score is not the one of the order's latest review."""
    newest = ["review_creation_date", "review_answer_timestamp", "review_id"]
    latest = latest_per_group(clean["order_reviews"], ["order_id"], newest, ["review_score"])
    scores = star["fact_orders"].groupBy("order_id", "review_score").agg(F.count(F.lit(1)).alias("n"))
    both = scores.join(latest.withColumnRenamed("review_score", "expected"), "order_id", "left")
    wrong = both.filter(~F.col("review_score").eqNullSafe(F.col("expected")))
    return wrong.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_violations")).select(
        F.lit("latest review score").alias("check"), "n_violations"
    )


def delivery_times(clean: Tables, star: Tables, tolerance: float = 1e-4) -> DataFrame:
    """Days recomputed from the orders, and delta = delivery - estimate."""
    orders = clean["orders"].select(
        "order_id", days_between("order_delivered_customer_date", "order_purchase_timestamp").alias("expected")
    )
    columns = ["order_id", "delivery_days", "estimated_days", "delivery_delta_days"]
    per_order = star["fact_orders"].groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    both = per_order.join(orders, "order_id", "left")
    days = F.col("delivery_days")
    off = F.coalesce(F.abs(days - F.col("expected")) > tolerance, days.isNull() != F.col("expected").isNull())
    delta = F.abs(F.col("delivery_delta_days") - (days - F.col("estimated_days"))) > tolerance
    one = both.agg(
        F.coalesce(F.sum(F.when(off, F.col("n"))), F.lit(0)).alias("a"),
        F.coalesce(F.sum(F.when(delta, F.col("n"))), F.lit(0)).alias("b"),
    )
    return one.select(
        F.inline(
            F.array(
                F.struct(F.lit("delivery_days from orders").alias("check"), F.col("a").alias("n_violations")),
                F.struct(F.lit("delta = delivery - estimate").alias("check"), F.col("b").alias("n_violations")),
            )
        )
    )


def status_distribution(clean: Tables, star: Tables) -> DataFrame:
    """Item counts per status: cleaned items with their order against the fact; and no new status."""
    items = clean["order_items"].groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    expected = (
        items.join(clean["orders"].select("order_id", "order_status"), "order_id", "left")
        .groupBy("order_status")
        .agg(F.sum("n").alias("expected"))
    )
    actual = star["fact_orders"].groupBy("order_status").agg(F.count(F.lit(1)).alias("actual"))
    same = F.col("e.order_status").eqNullSafe(F.col("a.order_status"))
    both = expected.alias("e").join(actual.alias("a"), same, "full_outer")
    known = clean["orders"].select("order_status").distinct()
    new = actual.filter("order_status is not null").join(known, "order_status", "left_anti")
    counts = both.filter(~F.col("expected").eqNullSafe(F.col("actual")))
    return stack([_single(counts, "status counts"), _single(new, "status subset")])


def category_translation(raw: Tables, star: Tables) -> DataFrame:
    """Known categories are translated, missing ones are unknown, and the unknown counts agree."""
    known = (
        raw["category_translation"]
        .select(strip("product_category_name").alias("category"))
        .distinct()
        .withColumn("known", F.lit(True))
    )
    products = raw["products"].select("product_id", strip("product_category_name").alias("category")).distinct()
    joined = products.join(known, "category", "left").join(
        star["dim_products"].select("product_id", "category_name_en"), "product_id", "left"
    )
    is_known = F.coalesce("known", F.lit(False))
    unknown = F.col("category_name_en") == "unknown"
    one = joined.agg(
        F.count_if(is_known & unknown).alias("a"),
        F.count_if(F.col("category").isNull() & ~unknown).alias("b"),
        (F.count_if(~is_known) - F.count_if(unknown)).alias("c"),
    )
    checks = {"known category translated": "a", "null category unknown": "b", "unknown count agrees": "c"}
    rows = [F.struct(F.lit(k).alias("check"), F.abs(v).alias("n_violations")) for k, v in checks.items()]
    return one.select(F.inline(F.array(*rows)))


def median_coordinates(raw: Tables, star: Tables, tolerance: float = 1e-4) -> DataFrame:
    """Coordinates of the dimension against exact medians of the raw rows."""
    places = raw["geolocation"].withColumn("zip_code_prefix", pad_zip(strip("geolocation_zip_code_prefix")))
    medians = group_medians(places, ["zip_code_prefix"], ["geolocation_lat", "geolocation_lng"])
    both = star["dim_geolocation"].join(medians, "zip_code_prefix")
    return _counts(
        both,
        {
            "median lat": F.abs(F.col("lat") - F.col("geolocation_lat")) > tolerance,
            "median lng": F.abs(F.col("lng") - F.col("geolocation_lng")) > tolerance,
        },
    )


# ---- result tables -----------------------------------------------------------------------


def compare_results(
    result: DataFrame, expected: DataFrame, keys: Sequence[str], rel: float = 0.01, absolute: float = 0.01
) -> DataFrame:
    """Same columns in order, same row count, values equal within tolerances after aligning on ``keys``.

    Both sides are summed per key first: rows, an additive fingerprint of the values, the least row.
    A key with one row a side, or with the same rows on both, is settled by this one join. Only
    rows of other keys are numbered by their values and aligned by number; the numbering is
    range-partitioned, so one key may hold any part of the rows.
    """
    if result.columns != expected.columns:
        one = expected.sparkSession.range(1)
        return one.select(F.lit("columns").alias("check"), F.lit(1).cast("bigint").alias("n_violations"))
    values = [c for c in result.columns if c not in keys]

    def packed(df: DataFrame, side: str) -> DataFrame:
        key = F.struct(F.lit(0).alias("_"), *[F.col(f"`{k}`") for k in keys])
        return df.select(key.alias("_key"), F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in values]).alias(side))

    def summed(df: DataFrame, side: str) -> DataFrame:
        """Least values one by one: they are the row where a key has one, and numbers are hashed, not sorted."""
        cells = [F.col(side).getField(c) for c in values]
        hashed = df.select("_key", *[F.xxhash64(F.lit(salt), side).alias(f"h{salt}") for salt in (1, 2)], *[c.alias(f"c{k}") for k, c in enumerate(cells)])
        least = [F.min(f"c{k}").alias(f"c{k}") for k in range(len(values))]
        sums = hashed.groupBy("_key").agg(F.count(F.lit(1)).alias(f"n_{side}"), *halves("h1", "p1"), *halves("h2", "p2"), *least)
        row = F.struct(F.lit(0).alias("_"), *[F.col(f"c{k}").alias(c) for k, c in enumerate(values)])
        return sums.select("_key", f"n_{side}", F.struct(whole("p1"), whole("p2")).alias(f"p_{side}"), row.alias(side))

    differs = F.lit(False)
    for c in values:
        x, y = F.col("l").getField(c), F.col("r").getField(c)
        if isinstance(expected.schema[c].dataType, T.NumericType):
            x, y = x.cast("double"), y.cast("double")
            near = F.abs(x - y) <= F.lit(absolute) + F.lit(rel) * F.abs(y)
            differs = differs | ~F.coalesce(near, x.isNull() & y.isNull())
        else:
            differs = differs | ~x.eqNullSafe(y)

    left, right = packed(result, "l"), packed(expected, "r")
    n, m = F.coalesce("n_l", F.lit(0)), F.coalesce("n_r", F.lit(0))
    single, several = (n == 1) & (m == 1), F.greatest(n, m) > 1
    same = (n == m) & F.col("p_l").eqNullSafe(F.col("p_r"))
    unsettled = several & (n > 0) & (m > 0) & ~same
    both = summed(left, "l").join(summed(right, "r"), "_key", "full_outer")
    rows, wrong, open_ = both.agg(F.coalesce(F.sum(F.abs(n - m)), F.lit(0)), F.count_if(single & differs), F.count_if(unsettled)).first()
    if open_:
        picked = stage(both.filter(unsettled).select("_key"), "unsettled")  # both numberings read these keys, each more than once
        numbered = [
            rank_all(df.join(picked, "_key", "left_semi"), Ranking(order=[asc(side)], within=["_key"], row_number="_n")) for df, side in ((left, "l"), (right, "r"))
        ]
        wrong += numbered[0].join(numbered[1], ["_key", "_n"]).filter(differs).count()
    return result.sparkSession.createDataFrame([("rows", rows), ("values", wrong)], "check string, n_violations bigint")


def check_structure(
    result: DataFrame, columns: Sequence[str], min_rows: int = 1, max_rows: int | None = None
) -> DataFrame:
    """Column list and row-count bounds; no more rows are counted than the bounds ask for."""
    most = min_rows if max_rows is None else max(min_rows, max_rows + 1)
    n = F.col("n")
    too_many = F.lit(False) if max_rows is None else n > max_rows
    one = result.limit(most).agg(F.count(F.lit(1)).alias("n"))
    checks = [
        F.struct(F.lit("columns").alias("check"), F.lit(int(result.columns != list(columns))).cast("bigint").alias("n_violations")),
        F.struct(F.lit("min rows").alias("check"), (n < min_rows).cast("bigint").alias("n_violations")),
        F.struct(F.lit("max rows").alias("check"), too_many.cast("bigint").alias("n_violations")),
    ]
    return one.select(F.inline(F.array(*checks)))


def not_descending(df: DataFrame, column: str, place: str) -> DataFrame:
    """Rows greater than their predecessor. ``place`` is the row's position, so the predecessor
    is found by an equi-join instead of an ordered window over the whole result."""
    here = df.select(F.col(place).alias("_p"), F.col(column).alias("_v"))
    before = here.select((F.col("_p") + 1).alias("_p"), F.col("_v").alias("_b"))
    return _single(here.join(before, "_p").filter("_v > _b"), f"{column} descending")


def tile_balance(df: DataFrame, tile: str, low: float = 0.15, high: float = 0.25, tiles: int = 5) -> DataFrame:
    """Tiles whose share of the rows is outside (low, high), and missing tiles."""
    sizes = df.groupBy(tile).agg(F.count(F.lit(1)).alias("n"))
    share = ratio(F.col("n"), F.sum("n").over(W.partitionBy()))
    checked = sizes.withColumn("share", share)
    return checked.agg(
        (F.count_if(~((F.col("share") > low) & (F.col("share") < high))) + F.abs(F.lit(tiles) - F.count(F.lit(1)))).alias(
            "n_violations"
        )
    ).select(F.lit(f"{tile} balance").alias("check"), "n_violations")


def running_total(df: DataFrame, order: str, value: str, total: str, rel: float = 0.01) -> DataFrame:
    """A running total never falls and ends at the sum. For results of calendar size."""
    before = F.lag(total).over(W.orderBy(order))
    one = df.withColumn("_b", before).agg(
        F.count_if(F.col(total) < F.col("_b")).alias("falls"),
        (F.abs(F.max_by(total, order) - F.sum(value)).cast("double") > F.abs(F.sum(value)).cast("double") * rel)
        .cast("bigint")
        .alias("off"),
    )
    return one.select(F.lit(f"{total} running").alias("check"), (F.col("falls") + F.col("off")).alias("n_violations"))


def ranks_within(df: DataFrame, group: str, rank: str, k: int = 3) -> DataFrame:
    """Groups with more than k rows or ranks outside 1..k."""
    groups = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("lo"), F.max(rank).alias("hi"))
    return _single(groups.filter((F.col("n") > k) | (F.col("lo") < 1) | (F.col("hi") > k)), f"{rank} within {k}")


def share_between(df: DataFrame, share: str, low: float = 5, high: float = 100) -> DataFrame:
    """The shares add up to something strictly between the bounds."""
    total = F.sum(share)
    return df.agg((~((total > low) & (total < high))).cast("bigint").alias("n_violations")).select(
        F.lit(f"{share} in bounds").alias("check"), "n_violations"
    )
