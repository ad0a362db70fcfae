import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyhouse.functions.columns import pad_zip, strip, title_case
from tallyhouse.operators import cleaning
from tallyhouse.operators.cleaning import CLEANERS, CleaningLog, clean_all

TEXTS = ["d'oeste", "embu-guacu", "  SAO  paulo ", "são joão", "a1b2", "", "o'brien mc-donald's", "12 de maio", "\t x \n", "straße", "l.a"]


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [r.v for r in df.select("i", expression(F.col("c")).alias("v")).orderBy("i").collect()]


def test_title_case_like_python(spark):
    assert values(spark, TEXTS, title_case) == [t.title() for t in TEXTS]


def test_strip_like_python(spark):
    texts = [*TEXTS, " x　", "\x1f y", "in side"]
    assert values(spark, texts, strip) == [t.strip() for t in texts]


def test_pad_zip_never_truncates(spark):
    assert values(spark, ["1", "12345", "1234567", None, ""], pad_zip) == ["00001", "12345", "1234567", None, "00000"]


def test_customers(clean):
    assert rows(clean["customers"]) == [
        ("c1", "u1", "01234", "Sao Paulo", "SP"),
        ("c2", "u2", "56789", "Rio De Janeiro", "RJ"),
        ("c3", "u3", "00100", "Brasilia", "DF"),
    ]


def test_duplicates_go_before_stripping(make):
    df = make("customers", [("c", "u", "1", "x", "sp")] * 2 + [("c", "u", "1", "x ", "sp")])
    assert cleaning.clean_customers(df).count() == 2


def test_geolocation_median_and_mode(clean):
    got = {r[0]: r[1:] for r in rows(clean["geolocation"])}
    assert set(got) == {"01234", "05678"}
    assert got["01234"] == (pytest.approx(-23.55), pytest.approx(-46.65), "Sao Paulo", "SP")
    assert got["05678"] == (-22.8, -43.2, "Rio De Janeiro", "RJ")


def test_geolocation_all_null_names(make):
    df = make("geolocation", [("9", 1.0, 2.0, None, None), ("9", None, None, None, None)])
    assert rows(cleaning.clean_geolocation(df)) == [("00009", 1.0, 2.0, "unknown", "unknown")]


def test_geolocation_repeated_rows_weigh(make):
    df = make("geolocation", [("9", 1.0, 1.0, "a", "x")] * 3 + [("9", 5.0, 5.0, "b", "y")] * 2)
    assert rows(cleaning.clean_geolocation(df)) == [("00009", 1.0, 1.0, "A", "X")]


def test_unknown_status_dropped_and_counted(spark, make):
    log = CleaningLog()
    df = make("orders", [("o1", "c", " delivered ", "2018-01-01", None, None, None, "bad"), ("o2", "c", "lost", *[None] * 5), ("o3", "c", *[None] * 6)])
    got = cleaning.clean_orders(df, log).collect()
    assert [(r.order_id, r.order_status, r.order_estimated_delivery_date) for r in got] == [("o1", "delivered", None)]
    assert log.counts() == {"orders in": 3, "orders distinct": 3, "order_status rejected": 2}


def test_negative_values_become_zero_and_nulls_stay(make):
    items = make("order_items", [("o", 1, "p", "s", None, -5.0, -1.0), ("o", 2, "p", "s", None, None, 2.0)])
    assert [(r.price, r.freight_value) for r in cleaning.clean_order_items(items).orderBy("order_item_id").collect()] == [(0.0, 0.0), (None, 2.0)]
    pays = make("order_payments", [("o", 1, "voucher", 1, -3.0), ("o", 2, "bitcoin", 1, 9.0), ("o", 3, None, 1, 9.0)])
    assert rows(cleaning.clean_order_payments(pays)) == [("o", 1, "voucher", 1, 0.0)]


def test_review_scores_clamped_and_comments_filled(make):
    df = make("order_reviews", [("a", "o", 0, None, None, None, None), ("b", "o", 9, " x ", "y", None, None), ("c", "o", None, "", "", None, None)])
    got = cleaning.clean_order_reviews(df).orderBy("review_id").collect()
    assert [(r.review_score, r.review_comment_title, r.review_comment_message) for r in got] == [(1, "", ""), (5, "x", "y"), (None, "", "")]


def test_products_imputed(clean):
    got = {r.product_id: r for r in clean["products"].collect()}
    assert (got["p2"].product_category_name, got["p2"].product_category_name_english) == ("unknown", "unknown")
    assert got["p1"].product_category_name_english == "computers"
    assert (got["p2"].product_name_lenght, got["p3"].product_description_lenght) == (40.0, 400.0)
    assert (got["p2"].product_photos_qty, got["p3"].product_weight_g, got["p3"].product_height_cm) == (2.5, 750.0, 7.5)


def test_untranslated_category_keeps_its_name(make):
    products = make("products", [("p", "novo", *[None] * 7)])
    translation = make("category_translation", [("informatica", "computers")])
    got = cleaning.clean_products(products, translation).first()
    assert (got.product_category_name, got.product_category_name_english, got.product_weight_g) == ("novo", "unknown", None)


@pytest.mark.parametrize("name", ["customers", "geolocation", "orders", "sellers", "order_items", "order_payments", "order_reviews"])
def test_empty_input_keeps_columns(make, name):
    empty = make(name, [])
    got = CLEANERS[name][0](empty)
    assert got.columns == empty.columns and got.count() == 0


def test_registry_needs_its_dependencies(raw):
    without = {k: v for k, v in raw.items() if k != "category_translation"}
    with pytest.raises(KeyError):
        clean_all(without)


def test_strip_only_searches_texts_with_odd_ends(spark):
    texts = ["a", " a", "a\u2003", "\u00a0é ", "é", "é\x85", "!~", "~ !", "", "  ", "日本", "\x7f a \x7f", None]
    assert values(spark, texts, strip) == [t if t is None else t.strip() for t in texts]


def test_payments_of_an_order_are_dealt_once(spark, make):
    data = [("o1", 1, "voucher", 1, 2.0)] * 2 + [(" o1", 1, "voucher", 1, 2.0), ("o1 ", 1, "voucher", 1, 2.0), ("o2", 1, "boleto ", 1, 1.0), (None, 1, "boleto", 1, 3.0), (None, 1, "boleto", 1, 3.0), ("o3", 1, "bitcoin", 1, 9.0)]
    clean = cleaning.clean_order_payments(make("order_payments", data))
    assert rows(clean) == rows(cleaning.clean_order_payments(make("order_payments", data), CleaningLog()))
    assert clean.count() == 5 and clean.columns == make("order_payments", data).columns
    summed = clean.groupBy("order_id").agg(F.sum("payment_value").alias("paid"))
    assert rows(summed) == [("o1", 6.0), ("o2", 1.0), (None, 3.0)]
    plan = clean.groupBy("order_id").agg(F.sum("payment_value"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_lines_are_merged_without_sorting_rows(spark, tmp_path, monkeypatch):
    """Least texts are found by their places; unknown and missing ones keep their order."""
    import datetime

    from tallyhouse.sources import given

    day = datetime.datetime(1997, 1, 1)
    flags = [("A", "N"), ("N", "R"), ("R", "a"), (None, "A"), ("", "A"), ("B", "N"), (None, None), ("N", "N")]
    data = [(k, 1, 1, 1, 1.0, 1.0, 0.01, 0.0, f, s, day) for k, pair in enumerate(flags) for f, s in zip(pair, ("O", "F" if k % 2 else "G"))]
    schema = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    plans = []
    monkeypatch.setattr(given, "stage", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    paid = {int(r.order_id[1:]): r.payment_type for r in given.raw_order_payments(spark, str(tmp_path)).collect()}
    given.forget()
    card = {True: " credit_card", False: "debit_card "}
    kind = lambda f, s: "voucher" if f is None else card[s == "F"] if f == "A" else "boleto" if f == "N" else "voucher"
    least = lambda texts: min((t for t in texts if t is not None), default=None)
    assert paid == {k: kind(least(pair), least(["O", "F" if k % 2 else "G"])) for k, pair in enumerate(flags)}
    assert plans and not any("SortAggregate" in p for p in plans)


def test_rows_that_share_no_print_are_neither_exchanged_nor_written(make, monkeypatch):
    """With a log only rows whose hash another row has are grouped whole; without such rows the input is the result."""
    staged = []
    monkeypatch.setattr(cleaning, "stage", lambda df, name: staged.append(name) or df.localCheckpoint())
    one = ("c", "u", None, "x", "sp")
    log, df = CleaningLog(), make("customers", [one, ("c", "u", "x", None, "sp"), ("d", "u", "1", "x", "sp"), (None,) * 5])
    monkeypatch.setattr(cleaning, "PRINT_BITS", 64)
    full = df.filter("customer_zip_code_prefix is not null")
    assert rows(cleaning.drop_full_duplicates(full, log, "few")) == rows(full) and not staged
    twice = df.unionByName(df.limit(1)).unionByName(df.filter("customer_id is null"))
    for bits in (64, 48, 1):  # the first two rows share a print, as a hash passes over nulls
        monkeypatch.setattr(cleaning, "PRINT_BITS", bits)
        found = cleaning.drop_full_duplicates(twice, log, f"twice {bits}")
        assert found.columns == df.columns and rows(found) == rows(df)
    assert cleaning.drop_full_duplicates(df.limit(0), log, "none").count() == 0
    counted = log.counts()
    assert counted == {"few in": 2, "few distinct": 2, "none in": 0, "none distinct": 0, **{f"twice {b} {k}": n for b in (64, 48, 1) for k, n in (("in", 6), ("distinct", 4))}}
    assert staged.count("distinct") == 3


def test_numbers_that_are_equal_are_copies_whatever_their_bits(spark):
    df = spark.createDataFrame([(0.0, float("nan")), (-0.0, float("nan")), (1.0, None)], "a double, b double")
    log = CleaningLog()
    assert cleaning.drop_full_duplicates(df, log).count() == df.dropDuplicates().count() == 2
    assert log.counts() == {"rows in": 3, "rows distinct": 2}


def test_logged_deduplication_exchanges_hashes_alone(spark, tmp_path):
    """Of distinct rows with wide texts less is shuffled and written than the rows take."""
    spark.range(20_000).selectExpr("id", *[f"sha2(concat(id, '{k}'), 256) as t{k}" for k in range(4)]).write.parquet(str(tmp_path / "t"))
    wide, log = spark.read.parquet(str(tmp_path / "t")), CleaningLog()
    distinct = cleaning.drop_full_duplicates(wide, log)
    assert distinct.inputFiles() == wide.inputFiles()
    assert distinct.count() == 20_000 and log.counts() == {"rows in": 20_000, "rows distinct": 20_000}
