import datetime
import re

import pytest
from conftest import rows

from tallyhouse.operators import modelling
from tallyhouse.refresh import unresolved_keys
from tallyhouse.schemas import STAR


def test_dim_dates(built):
    got = {r.date_key: r for r in built["dim_dates"].collect()}
    assert sorted(got) == [20180115, 20180116, 20180120, 20180125, 20180220, 20180310]
    saturday = got[20180120]
    assert (saturday.full_date, saturday.day_of_week, saturday.day_name, saturday.is_weekend) == (datetime.date(2018, 1, 20), 5, "Saturday", 1)
    assert (saturday.year, saturday.quarter, saturday.month, saturday.day) == (2018, 1, 1, 20)


def test_keys_are_dense_and_ordered(built):
    for table, key, natural in (("dim_customers", "customer_key", "customer_id"), ("dim_sellers", "seller_key", "seller_id"), ("dim_products", "product_key", "product_id"), ("dim_geolocation", "geo_key", "zip_code_prefix")):
        pairs = sorted((r[key], r[natural]) for r in built[table].collect())
        assert [k for k, _ in pairs] == list(range(1, len(pairs) + 1))
        assert [n for _, n in pairs] == sorted(n for _, n in pairs)


def test_geo_lookup(built):
    assert {r.customer_id: r.geo_key for r in built["dim_customers"].collect()} == {"c1": 1, "c2": None, "c3": None}
    assert {r.seller_id: r.geo_key for r in built["dim_sellers"].collect()} == {"s1": 1, "s2": 2}


def test_fact(built):
    fact = {(r.order_id, r.order_item_id): r for r in built["fact_orders"].collect()}
    assert len(fact) == 3
    o1 = fact["o1", 1]
    assert (o1.order_payment_total, o1.payment_type, o1.review_score) == (300.0, "credit_card", 5)
    assert o1.order_payment_total == fact["o1", 2].order_payment_total
    assert o1.delivery_days == pytest.approx(5.0) and o1.estimated_days == pytest.approx(9 + 14 / 24)
    assert o1.delivery_delta_days == pytest.approx(o1.delivery_days - o1.estimated_days)
    assert (o1.date_key, o1.customer_key, o1.customer_geo_key, o1.seller_geo_key) == (20180115, 1, 1, 1)
    o2 = fact["o2", 1]
    assert (o2.customer_geo_key, o2.delivery_days, o2.delivery_delta_days) == (None, None, None)
    assert built["fact_orders"].columns == [c for c in STAR["fact_orders"].names if c != "fact_key"]


def test_unresolved_customer_is_counted(clean, built):
    some = built["dim_customers"].filter("customer_id <> 'c1'")
    fact = modelling.build_fact_orders(clean["order_items"], clean["orders"], clean["order_payments"], clean["order_reviews"], some, built["dim_sellers"], built["dim_products"])
    assert unresolved_keys({"fact_orders": fact}) == {"customer_key": 2, "seller_key": 0, "product_key": 0}


def test_item_of_dropped_order_keeps_payment_and_review(clean, built):
    none = clean["orders"].filter("false")
    fact = modelling.build_fact_orders(clean["order_items"], none, clean["order_payments"], clean["order_reviews"], built["dim_customers"], built["dim_sellers"], built["dim_products"])
    got = fact.filter("order_id = 'o1' and order_item_id = 1").first()
    assert (got.order_status, got.date_key, got.order_payment_total, got.review_score) == (None, None, 300.0, 5)


def test_order_without_payment_or_review(make, clean, built):
    none_paid, none_seen = clean["order_payments"].filter("false"), clean["order_reviews"].filter("false")
    fact = modelling.build_fact_orders(clean["order_items"], clean["orders"], none_paid, none_seen, built["dim_customers"], built["dim_sellers"], built["dim_products"])
    assert {(r.order_payment_total, r.payment_type, r.review_score) for r in fact.collect()} == {(None, None, None)}


def test_latest_review_ties_go_to_the_later_answer(spark):
    df = spark.createDataFrame(
        [("a", "o", 1, "2018-01-02", "2018-01-03"), ("b", "o", 2, "2018-01-02", "2018-01-05"), ("c", "o", 3, None, "2019-01-01"), ("d", "p", 4, None, None)],
        "review_id string, order_id string, review_score int, review_creation_date string, review_answer_timestamp string",
    )
    assert rows(modelling.latest_review_per_order(df)) == [("o", 2), ("p", 4)]


def test_payment_mode_defaults(spark):
    df = spark.createDataFrame([("o", None, 1.0), ("p", "voucher", 2.0), ("p", "boleto", 0.1), ("p", None, 0.2)], "order_id string, payment_type string, payment_value double")
    assert rows(modelling.payments_per_order(df)) == [("o", 1.0, "not_defined"), ("p", 2.3, "boleto")]


def test_payments_meet_in_one_exchange(spark):
    data = [("a", "voucher", 1.0), ("a", "boleto", 2.5), ("b", "credit_card", None), ("c", "voucher", 0.1), ("c", "voucher", 0.2), ("c", "boleto", 9.0), ("d", None, 4.0)]
    per_order = modelling.payments_per_order(spark.createDataFrame(data, "order_id string, payment_type string, payment_value double"))
    got = {r.order_id: (r.order_payment_total, r.payment_type) for r in per_order.collect()}
    assert got == {"a": (3.5, "boleto"), "b": (None, "credit_card"), "c": (9.3, "voucher"), "d": (4.0, "not_defined")}
    plan = per_order._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange") == 1 and "SortAggregate" not in plan


def test_items_meet_orders_last(built):
    """Where products are not broadcast, the wide rows are dealt by order last, so an order's items lie together."""
    joins = re.findall(r"Join LeftOuter, \((\w+)#", built["fact_orders"]._jdf.queryExecution().optimizedPlan().toString())
    assert joins[:3] == ["order_id"] * 3 and {"seller_id", "product_id"} <= set(joins[3:])
