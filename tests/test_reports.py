"""Reports on tiny facts with hand-computed answers, and the traps of their semantics."""

import datetime
import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyhouse.plans import customers, indicators, integrity, payments, profiling, reconciliation, sales, sellers

FACT = (
    "order_id string, order_item_id int, date_key int, customer_key bigint, seller_key bigint, product_key bigint, order_status string,"
    " price double, freight_value double, order_payment_total double, payment_type string, review_score int, delivery_days double,"
    " estimated_days double, delivery_delta_days double"
)


def item(order, n, day, customer, seller, product, price, status="delivered", paid=None, kind="boleto", score=4, days=10.0):
    delta = None if days is None else days - 12.0
    return (order, n, day, customer, seller, product, status, price, 1.0, paid, kind, score, days, 12.0, delta)


@pytest.fixture(scope="module")
def star(spark):
    items = [
        item("a", 1, 20170105, 1, 1, 1, 100.0, paid=151.99),
        item("a", 2, 20170105, 1, 2, 2, 50.0, paid=151.99),
        item("b", 1, 20170210, 2, 1, 1, 30.0, paid=31.02),
        item("c", 1, 20170301, 3, 2, None, 20.0, paid=21.0, score=None),
        item("d", 1, 20170303, 4, 3, 3, 10.0, "shipped", paid=None, days=None),
        item("e", 1, 20170404, 3, 3, 2, 5.0, paid=6.01, days=None),
        item("f", 1, None, 5, 1, 1, 7.0, paid=80.0, kind="debit_card"),
    ]
    return {
        "fact_orders": spark.createDataFrame(items, FACT),
        "dim_customers": spark.createDataFrame(
            [(1, "c1", "u1", "X", "SP"), (2, "c2", "u1", "X", "SP"), (3, "c3", "u3", "Y", "RJ"), (4, "c4", "u4", "Y", "RJ"), (5, "c5", "u5", "Z", "RJ"), (6, "c6", "u6", "Z", None)],
            "customer_key bigint, customer_id string, customer_unique_id string, city string, state string",
        ),
        "dim_sellers": spark.createDataFrame([(1, "s1", "A", "SP"), (2, "s2", "B", "SP"), (3, "s3", "C", "RJ")], "seller_key bigint, seller_id string, city string, state string"),
        "dim_products": spark.createDataFrame([(1, "p1", "livros", "books"), (2, "p2", "jogos", None), (3, "p3", None, None)], "product_key bigint, product_id string, category_name_pt string, category_name_en string"),
    }


def test_kpis_count_orders_once_and_rate_all_statuses(star):
    got = sales.overview_kpis(star).first()
    assert (got.total_orders, float(got.total_revenue), got.avg_review, got.avg_delivery_days) == (5, 212.0, 4.0, 10.0)


def test_undated_items_are_in_no_month(star):
    assert [(r.month_label, float(r.monthly_revenue)) for r in sales.monthly_revenue(star).collect()] == [("2017-01", 150.0), ("2017-02", 30.0), ("2017-03", 20.0), ("2017-04", 5.0)]


def test_trend(star):
    got = sales.trends_monthly(star).collect()
    assert [r.growth_pct for r in got] == [None, -80.0, -33.3, -75.0]
    assert [float(r.running_total) for r in got] == [150.0, 180.0, 200.0, 205.0]


def test_categories_with_and_without_product(star):
    assert [(r.category_name, float(r.total_revenue)) for r in sales.top_categories(star).collect()] == [("books", 137.0), ("jogos", 55.0), ("Unknown", 20.0)]
    assert [r.category for r in sales.top_categories_with_product(star).collect()] == ["books", "jogos"]


def test_share_is_of_all_statuses(star):
    got = sales.top_products_share(star).collect()
    assert got[0].product_id == "p1" and got[0].pct_of_total == pytest.approx(137 * 100 / 222)


def test_persons_join_several_customer_ids(star):
    retention = rows(customers.cohorts_retention(star))
    assert retention == [(201701, 0, 1), (201701, 1, 1), (201703, 0, 1), (201703, 1, 1)]
    ltv = customers.ltv_cohorts(star).collect()
    assert [float(r.cumulative_revenue) for r in ltv] == [150.0, 180.0, 20.0, 25.0]
    assert [r.ltv_per_customer for r in ltv] == [150.0, 180.0, 20.0, 25.0]
    assert [tuple(r) for r in customers.new_vs_recurring(star).collect()][1] == ("2017-02", 0, 1, 1, 0.0)
    assert tuple(customers.repeat_rate(star).first()) == (2, 2, 100.0)
    assert rows(customers.customers_with_orders(star)) == [("u1", 2), ("u3", 2)]


def test_orders_per_customer_counts_zero(star):
    assert rows(customers.orders_per_customer(star)) == [("u1", 1), ("u1", 1), ("u3", 2), ("u4", 1), ("u5", 1), ("u6", 0)]
    assert {r.customer_unique_id: r.avg_order for r in customers.mean_price_per_customer(star).collect()}["u6"] is None


def test_inactive_on_a_given_day(star):
    got = customers.inactive_customers(star, datetime.date(2017, 8, 20))
    assert rows(got) == [("u1", 191)]


def test_next_purchase_inside_and_after_a_day(star):
    got = {(r.order_id, r.order_item_id): r.next_date_key for r in customers.next_purchase(star).collect()}
    assert got == {("a", 1): 20170105, ("a", 2): None, ("b", 1): None, ("c", 1): 20170404, ("d", 1): None, ("e", 1): None}


def test_extremes_keep_rows_of_both_branches(star):
    assert len(customers.extreme_customers(star, above=20, below=40).collect()) == 7


def test_recency_against_the_newest_of_any_status(star):
    got = {r.customer_unique_id: r.recency for r in customers.rfm_raw(star).collect()}
    assert got == {"u1": 53, "u3": 0}


def test_next_purchase_with_equal_rows(spark, star):
    """Two equal items of one day: one is followed by the other, the last by the next day."""
    rows_ = [item("a", 1, 20200101, 9, 1, 1, 5.0), item("a", 1, 20200101, 9, 1, 1, 5.0), item("b", 1, 20200301, 9, 1, 1, 5.0)]
    got = customers.next_purchase({**star, "fact_orders": spark.createDataFrame(rows_, FACT)}).collect()
    assert sorted((r.order_id, r.next_date_key) for r in got if r.next_date_key) == [("a", 20200101), ("a", 20200301)]
    assert [r.order_id for r in got if r.next_date_key is None] == ["b"]


@pytest.mark.parametrize("base,step", [(1e8, 0.001), (0.0, 1e-7), (1e12, 1.0)])
def test_deviation_of_any_magnitude(spark, base, step):
    values = [base, base + step, base + 2 * step]
    got = profiling.describe(spark.createDataFrame([(v,) for v in values], "x double"), ["x"]).first()
    assert got.std == pytest.approx(statistics.stdev(values), rel=1e-4)
    assert got.mean == pytest.approx(base + step, rel=1e-9)


def test_seller_without_delivery_scores_best_on_delay(star):
    got = {r.seller_id: r for r in sellers.seller_scoring(star).collect()}
    assert got["s3"].avg_delivery_days is None and got["s3"].delivery_score == 3
    assert got["s3"].on_time_pct == 0.0


def test_pareto(star):
    got = sellers.pareto_sellers(star).collect()
    assert [(r.seller_id, float(r.cumulative_revenue), r.cumulative_pct, r.pct_rank, r.pareto_group) for r in got] == [
        ("s1", 137.0, 64.62, 0.0, "80%"),
        ("s2", 207.0, 97.64, 0.5, "20%"),
        ("s3", 212.0, 100.0, 1.0, "20%"),
    ]
    top = indicators.pareto_threshold(sellers.pareto_curve(star)).first()
    assert (top.threshold_rank, top.sellers) == (2, 3)


def test_gaps_in_exact_cents(star):
    stats = payments.gap_stats(star).first()
    assert (stats.nb_commandes_avec_ecart, float(stats.delta_min), float(stats.delta_max)) == (2, 0.02, 72.0)
    split = {r.type_ecart: (r.nb_commandes, r.somme_delta) for r in payments.gap_split(star).collect()}
    assert split["exact"][0] == 4 and "sous-paye (paid < invoiced)" not in split
    named = {r.type_ecart: r.nb_commandes for r in payments.gap_split(star, unpaid="no payment").collect()}
    assert named == {"surpaye (paid > invoiced)": 2, "exact": 3, "no payment": 1}
    assert rows(payments.gap_histogram(star)) == [("0.01 a 1", 1), ("> 50", 2), ("exact (+-0.01)", 3)]


def test_indicator_fallbacks(spark):
    ltv = spark.createDataFrame([(201701, 0, 10, 1.0), (201702, 0, 30, 2.0), (201703, 0, 20, 3.0)], "cohort_month int, months_since_first int, nb_customers bigint, ltv_per_customer double")
    assert [r.cohort_month for r in indicators.ltv_selection(ltv, min_size=500, fallback=2).collect()] == [201702, 201703]
    assert [r.cohort_month for r in indicators.ltv_selection(ltv, min_size=25).collect()] == [201702]
    assert tuple(indicators.best_ltv(ltv, min_size=15).first()) == ("2017-03", 3.0)
    trends = spark.createDataFrame([("2017-01", 20000.0, None, 1.0), ("2017-02", 50000.0, 900.0, 2.0), ("2017-03", 5.0, -99.9, 3.0)], "month_label string, monthly_revenue double, growth_pct double, running_total double")
    assert tuple(indicators.trend_summary(trends).first()) == (2, 2.0, 100.0, "rising")


def test_compare_results(spark):
    a = spark.createDataFrame([(1, "x", 100.0), (2, "y", None), (3, "z", 5.0)], "k int, s string, v double")
    near = a.withColumn("v", F.col("v") * 1.005)
    def check(df):
        return {r.check: r.n_violations for r in integrity.compare_results(df, a, ["k"]).collect()}
    assert check(near) == {"rows": 0, "values": 0}
    assert check(a.withColumn("v", F.col("v") * 1.2)) == {"rows": 0, "values": 2}
    assert check(a.filter("k < 3")) == {"rows": 1, "values": 0}
    assert check(a.unionByName(a.filter("k = 1"))) == {"rows": 1, "values": 0}
    assert check(a.withColumn("s", F.lit("x"))) == {"rows": 0, "values": 2}
    assert check(a.select("k", "v", "s")) == {"columns": 1}


def test_unique_keys_are_compared_without_numbering(spark, monkeypatch):
    """Repeated keys with the same rows are settled by their fingerprints too; only the others are numbered."""
    a = spark.createDataFrame([(k, float(v)) for k in (1, None, 3) for v in range(1 if k else 4)], "k int, v double").repartition(3)
    numbered = []
    real = integrity.rank_all
    monkeypatch.setattr(integrity, "rank_all", lambda df, want: numbered.append(1) or real(df, want))
    check = lambda x, y: {r.check: r.n_violations for r in integrity.compare_results(x, y, ["k"]).collect()}
    assert check(a, a.orderBy("v")) == {"rows": 0, "values": 0} and not numbered
    assert check(a.unionByName(a), a) == {"rows": 6, "values": 3} and len(numbered) == 2
    assert check(a.withColumn("v", F.when(F.col("k").isNull(), F.col("v") + 1).otherwise(F.col("v"))), a) == {"rows": 0, "values": 4}
    assert check(a, a.filter("false")) == {"rows": 6, "values": 0}


def test_structure_and_properties(spark):
    df = spark.createDataFrame([(i, 100 - i, 1 + i % 5) for i in range(100)], "place int, v int, q int")
    def bad(check):
        return sum(r.n_violations for r in check.collect())
    assert bad(integrity.check_structure(df, ["place", "v", "q"], 1, 100)) == 0
    assert bad(integrity.check_structure(df, ["v"], 101, 99)) == 3
    assert bad(integrity.not_descending(df, "v", "place")) == 0
    assert bad(integrity.not_descending(df, "q", "place")) == 80
    assert bad(integrity.tile_balance(df, "q")) == 0
    assert bad(integrity.tile_balance(df.filter("q < 5"), "q")) > 0
    total = df.selectExpr("place", "1 as v", "place + 1 as total")
    assert bad(integrity.running_total(total, "place", "v", "total")) == 0
    assert bad(integrity.running_total(total.withColumn("total", -F.col("total")), "place", "v", "total")) == 100
    ranks = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 4)], "g string, r int")
    assert bad(integrity.ranks_within(ranks, "g", "r")) == 1
    assert bad(integrity.share_between(spark.createDataFrame([(3.0,), (1.0,)], "s double"), "s")) == 1


def test_integrity_holds_on_the_fixture(raw, clean, published):
    star = published["star"]
    checks = [
        integrity.constraint_violations(star),
        integrity.date_dimension(star),
        integrity.row_counts(raw, star).select("check", "n_violations"),
        integrity.revenue_totals(raw, star).select("check", "n_violations"),
        integrity.payment_totals(clean, star),
        integrity.latest_reviews(clean, star),
        integrity.delivery_times(clean, star),
        integrity.status_distribution(clean, star),
        integrity.category_translation(raw, star),
        integrity.median_coordinates(raw, star),
    ]
    assert [r for c in checks for r in c.collect() if r.n_violations] == []


def test_integrity_finds_what_is_broken(raw, clean, published):
    star = dict(published["star"])
    fact = star["fact_orders"]
    def bad(check, tables):
        return {r.check: r.n_violations for r in check(*tables).collect() if r.n_violations}
    paid = {**star, "fact_orders": fact.withColumn("order_payment_total", F.col("order_payment_total") + 1)}
    assert bad(integrity.payment_totals, (clean, paid)) == {"payment total per order": 2, "payment grand total": 1}
    assert bad(integrity.latest_reviews, (clean, {**star, "fact_orders": fact.withColumn("review_score", F.lit(1))})) == {"latest review score": 3}
    late = {**star, "fact_orders": fact.withColumn("delivery_days", F.col("delivery_days") + 1)}
    assert bad(integrity.delivery_times, (clean, late)) == {"delivery_days from orders": 2, "delta = delivery - estimate": 2}
    assert bad(integrity.referential, ({**star, "dim_products": star["dim_products"].filter("product_id = 'p2'")},)) == {"fact_orders.product_key -> dim_products": 2}
    assert bad(integrity.status_distribution, (clean, {**star, "fact_orders": fact.withColumn("order_status", F.lit("new"))})) == {"status counts": 3, "status subset": 1}


def test_left_anti_ignores_null_keys(make, raw):
    geo = raw["geolocation"].unionByName(make("geolocation", [(None, 0.0, 0.0, None, None)]))
    got = {r.dataset: r.without_geography for r in reconciliation.without_geography({**raw, "geolocation": geo}).collect()}
    assert got == {"customers": 2, "sellers": 0}


def test_empty_months_are_listed(make, raw):
    orders = make("orders", [("a", "c", "delivered", "2018-01-05", *[None] * 4), ("b", "c", "delivered", "2018-04-01", *[None] * 4)])
    assert [r.orders for r in profiling.orders_per_month({**raw, "orders": orders}).orderBy("month").collect()] == [1, 0, 0, 1]


def test_describe_matches_builtin(spark):
    df = spark.range(1, 102).selectExpr("cast(id * id as double) as x", "cast(if(id % 7 = 0, null, id) as double) as y")
    got = {r.column: r for r in profiling.describe(df, ["x", "y"]).collect()}
    want = df.agg(F.mean("x").alias("m"), F.stddev_samp("x").alias("s"), F.percentile("x", 0.25).alias("q"), F.count("y").alias("n")).first()
    assert got["x"].mean == pytest.approx(want.m) and got["x"].std == pytest.approx(want.s) and got["x"].p25 == want.q
    assert got["y"]["count"] == want.n


def test_foreign_keys_are_grouped_as_numbers(published):
    plan = integrity.referential(published["star"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(relation" in plan and "hashpartitioning(check" not in plan.split("relation")[0]


def test_compared_numbers_are_hashed(spark):
    """Least values of a key need no sort of its rows; several rows of a key are still aligned."""
    plans = []
    left = spark.createDataFrame([(1, 1.0, 2), (2, 5.0, None), (3, 7.0, 1), (3, 8.0, 1)], "k int, v double, w int")
    right = spark.createDataFrame([(1, 1.0, 2), (2, 9.0, None), (3, 8.0, 1), (3, 70.0, 1)], "k int, v double, w int")
    frame = type(left)
    first = frame.first
    frame.first = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or first(df)
    try:
        got = {r.check: r.n_violations for r in integrity.compare_results(left, right, ["k"]).collect()}
    finally:
        frame.first = first
    assert got == {"rows": 0, "values": 3}
    assert plans and not any("SortAggregate" in p for p in plans)


def test_result_properties_join_the_items_once(spark, monkeypatch):
    from tallyhouse import catalogue
    from tallyhouse.sources import given

    sf, built = "/root/testdata/sf0.001", []
    monkeypatch.setattr(catalogue, "stage", lambda df, name: built.append(df) or spark.createDataFrame(df.collect(), df.schema), raising=False)
    plan = catalogue.QUERIES["q16_result_properties"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert len(built) == 1 and "lineitem.parquet" not in plan
    assert built[0].count() == given.table(spark, sf, "lineitem").count()


def test_keys_of_a_parent_without_gaps_are_not_exchanged(spark, published):
    star = published["star"]
    plan = integrity.referential(star)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("customer_unique_id") == 1  # the customers are read as a child only
    runs = lambda *keys: integrity._whole_runs({0: spark.createDataFrame([(0, k) for k in keys], "parent int, key bigint")})
    assert runs(3, 1, 2, None) == {0: (1, 3)} and runs(*range(-5, 70000)) == {0: (-5, 69999)}
    assert runs(1, 2, 2, 4) == runs(1, 3) == runs(-(2**63), 2**63 - 1) == runs(None) == {}
    one = star["dim_customers"].limit(1).drop("customer_key")
    for parents, bad in (((1, 2, 3), (0, 4)), ((1, 2, 2, 4), (3, 5))):
        customers = one.crossJoin(spark.createDataFrame([(k,) for k in parents], "customer_key bigint"))
        keys = spark.createDataFrame([(k,) for k in (*parents, *bad, bad[0], None)], "customer_key bigint")
        fact = star["fact_orders"].drop("customer_key").limit(1).crossJoin(keys)
        found = {r.check: r.n_violations for r in integrity.referential({**star, "dim_customers": customers, "fact_orders": fact}).collect()}
        assert found["fact_orders.customer_key -> dim_customers"] == 3
