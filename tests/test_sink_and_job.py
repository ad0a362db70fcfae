import datetime
import os

import pytest
from conftest import ROWS, rows
from pyspark.sql import functions as F, types as T

from tallyhouse import refresh
from tallyhouse.operators import staging
from tallyhouse.plans import sales, views
from tallyhouse.schemas import MONTH, RAW, STAR
from tallyhouse.sinks import snapshot
from tallyhouse.sources import given, raw as sources

NAMES = {"category_translation": "product_category_name_translation.csv"}


@pytest.fixture
def folder(spark, raw, tmp_path):
    for name, df in raw.items():
        df.toPandas().to_csv(tmp_path / NAMES.get(name, f"x_{name}_dataset.csv"), index=False)
    return str(tmp_path)


def test_schemas_and_order(published):
    for name, df in published["star"].items():
        expected = [(f.name, f.dataType) for f in STAR[name]] + [(MONTH, T.IntegerType())] * (name == "fact_orders")
        assert [(f.name, f.dataType) for f in df.schema] == expected


def test_row_counts_and_unique_fact_key(published):
    star = published["star"]
    assert {n: df.count() for n, df in star.items()} == {"dim_dates": 6, "dim_geolocation": 2, "dim_customers": 3, "dim_sellers": 2, "dim_products": 3, "fact_orders": 3}
    assert len({r.fact_key for r in star["fact_orders"].collect()}) == 3


def test_files_of_other_months_are_not_read(published):
    """A range of days selects the month folders; a day inside goes on to the reader."""
    fact = published["star"]["fact_orders"]
    one = sales.within_days(fact, 20180101, 20180131)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan and "GreaterThanOrEqual(date_key,20180101)" in plan
    assert one.count() == 2 and len(one.inputFiles()) <= len(fact.inputFiles())
    assert sales.rows_between_days(published["star"], 20180201).count() == 1
    assert sales.delivered_items_of_year(published["star"], 2018).count() == 2


def test_source_filters_reach_the_reader(spark):
    """The reports that keep one status or a range of days push both down to the orders' files."""
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    star = given.star(spark, "/root/testdata/sf0.001", status="delivered", first_day=datetime.date(1997, 1, 1), last_day=datetime.date(1997, 12, 31))
    plan = sales.delivered_items_of_year(star, 1997)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = next(line for line in plan.split("\n") if "o_orderstatus" in line and "PushedFilters" in line)
    for part in ("EqualTo(o_orderstatus,F)", "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00", "LessThan(o_orderdate,1998-01-01T00:00"):
        assert part in pushed


def test_publishing_twice_changes_nothing(spark, built, tmp_path):
    root = str(tmp_path)
    first = snapshot.publish(spark, built, root)
    before = rows(snapshot.read_star(spark, root)["fact_orders"])
    second = snapshot.publish(spark, built, root)
    assert first != second and snapshot.current_snapshot(spark, root) == second
    assert rows(snapshot.read_star(spark, root)["fact_orders"]) == before


def test_failed_check_leaves_the_old_snapshot(spark, built, tmp_path):
    root = str(tmp_path)
    good = snapshot.publish(spark, built, root)
    for broken in (
        {"fact_orders": built["fact_orders"].withColumn("review_score", F.lit(6))},
        {"fact_orders": built["fact_orders"].withColumn("price", F.lit(-1.0))},
        {"fact_orders": built["fact_orders"].unionByName(built["fact_orders"])},
        {"dim_customers": built["dim_customers"].filter("customer_id <> 'c1'")},
    ):
        with pytest.raises(snapshot.PublishError):
            snapshot.publish(spark, {**built, **broken}, root)
        assert snapshot.current_snapshot(spark, root) == good
        assert snapshot.snapshots(spark, root) == [good]
    assert snapshot.read_star(spark, root)["fact_orders"].count() == 3


def test_old_snapshots_expire_by_age(spark, built, tmp_path):
    root = str(tmp_path)
    ids = [snapshot.publish(spark, built, root) for _ in range(3)]
    assert snapshot.snapshots(spark, root) == ids
    assert snapshot.expire(spark, root, datetime.timedelta(hours=1)) == []
    assert snapshot.expire(spark, root, datetime.timedelta(0)) == ids[:2]
    assert snapshot.snapshots(spark, root) == ids[2:]


def test_nothing_published(spark, tmp_path):
    assert snapshot.current_snapshot(spark, str(tmp_path)) is None
    with pytest.raises(snapshot.PublishError):
        snapshot.read_star(spark, str(tmp_path))


def test_inventory_reports_missing_extra_and_empty(spark, published):
    star = dict(published["star"])
    del star["dim_dates"]
    star["dim_sellers"] = star["dim_sellers"].filter("false")
    star["extra"] = spark.range(2)
    got = {r["table"]: (r.expected, r.present, r.rows, r.ok) for r in snapshot.inventory(star).collect()}
    assert got["dim_dates"] == (True, False, 0, False)
    assert got["dim_sellers"] == (True, True, 0, False)
    assert got["extra"] == (False, True, 2, False)
    assert got["fact_orders"] == (True, True, 3, True)
    with pytest.raises(snapshot.PublishError, match="dim_dates, dim_sellers, extra"):
        snapshot.require_complete(star)
    snapshot.require_complete(published["star"])


def test_csv_reader_keeps_leading_zeros_and_line_breaks(spark, tmp_path):
    (tmp_path / "x_customers_dataset.csv").write_text("customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\nc,u,01234,a,sp\n")
    (tmp_path / "x_order_reviews_dataset.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r,o,5,,"two\nlines, ""quoted""",2018-01-01,2018-01-02\n'
    )
    assert sources.load_raw_csv(spark, str(tmp_path), "customers").first().customer_zip_code_prefix == "01234"
    review = sources.load_raw_csv(spark, str(tmp_path), "order_reviews").first()
    assert (review.review_comment_title, review.review_comment_message) == (None, 'two\nlines, "quoted"')


def test_unknown_dataset_and_missing_file(spark, tmp_path):
    with pytest.raises(sources.SourceError, match="unknown dataset"):
        sources.load_raw_csv(spark, str(tmp_path), "nope")
    with pytest.raises(sources.SourceError, match="no file"):
        sources.load_raw_csv(spark, str(tmp_path), "orders")


def test_load_all_and_manifest(spark, folder):
    loaded = sources.load_all_raw(spark, folder)
    assert set(loaded) == set(RAW)
    got = {r.dataset: r for r in sources.manifest_totals(sources.manifest(spark, folder)).collect()}
    assert {n: r.rows for n, r in got.items()} == {n: len(v) for n, v in ROWS.items()}
    assert all(r.bytes > 0 and r.checksum for r in got.values())


def test_checksum_ignores_row_order(spark):
    df = spark.range(100)
    assert sources.fingerprint(df.orderBy(F.desc("id"))).first() == sources.fingerprint(df.repartition(5)).first()
    assert sources.fingerprint(df.filter("id > 0")).first() != sources.fingerprint(df).first()


def test_whole_job_then_fresh(spark, folder, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("out"))
    report = refresh.run_if_stale(spark, folder, root)
    assert report.unresolved == {"customer_key": 0, "seller_key": 0, "product_key": 0}
    assert report.cleaning["orders in"] == 2 and report.cleaning["payment_type rejected"] == 0
    assert refresh.run_if_stale(spark, folder, root) is None
    assert refresh.run_if_stale(spark, folder, root, force=True) is not None


def test_a_file_that_lands_during_the_build_is_new(spark, folder, tmp_path_factory, monkeypatch):
    """The listing is taken before anything is read, so a later delivery is not lost."""
    root = str(tmp_path_factory.mktemp("late"))
    read = refresh.load_all_raw

    def and_then_deliver(*args):
        loaded = read(*args)
        with open(f"{folder}/x_sellers_dataset.csv", "a") as f:
            f.write("s9,1234,sao paulo,sp\n")
        return loaded

    monkeypatch.setattr(refresh, "load_all_raw", and_then_deliver)
    assert refresh.run_if_stale(spark, folder, root) is not None
    monkeypatch.setattr(refresh, "load_all_raw", read)
    assert refresh.run_if_stale(spark, folder, root) is not None
    assert refresh.run_if_stale(spark, folder, root) is None
    assert sources.needs_refresh(sources.source_files(spark, folder), None)


def test_two_deliveries_are_refused(spark, folder):
    with open(f"{folder}/x_sellers_dataset.csv") as f, open(f"{folder}/y_sellers_dataset.csv", "w") as g:
        g.write(f.read())
    with pytest.raises(sources.SourceError, match="2 matches"):
        sources.load_raw_csv(spark, folder, "sellers")
    assert sources.load_raw_csv(spark, folder, "sellers", {"sellers": "*_sellers_dataset.csv"}).count() == 2 * len(ROWS["sellers"])


def test_errors_carry_their_phase(spark, raw, tmp_path):
    with pytest.raises(refresh.PhaseError) as seen:
        refresh.run(spark, str(tmp_path / "nowhere"), str(tmp_path))
    assert seen.value.phase == "extract"
    with pytest.raises(refresh.PhaseError) as seen:
        refresh.build_and_publish(spark, {}, str(tmp_path))
    assert seen.value.phase == "clean"
    twice = {**raw, "customers": raw["customers"].unionByName(raw["customers"].withColumn("customer_city", F.lit("x")))}
    with pytest.raises(refresh.PhaseError) as seen:
        refresh.build_and_publish(spark, twice, str(tmp_path))
    assert seen.value.phase == "load"


def test_views_and_parameters(spark, published, tmp_path):
    views.register_views(published["star"])
    views.register_views(published["star"])
    got = views.query(spark, "select month_label, monthly_revenue from v_monthly_sales where monthly_revenue > ?", [1]).collect()
    assert [(r.month_label, float(r.monthly_revenue)) for r in got] == [("2018-01", 300.0)]
    (tmp_path / "q.sql").write_text("select count(*) as n from v_orders_enriched where order_status = :s")
    text, df = views.query_from_file(spark, str(tmp_path / "q.sql"), {"s": "shipped"})
    assert "count" in text and df.first().n == 1


def test_job_with_empty_side_tables_does_not_hang(spark, raw, tmp_path):
    empty = {n: raw[n].filter("1 = 0") for n in ("order_payments", "order_reviews", "category_translation")}
    report = refresh.build_and_publish(spark, {**raw, **empty}, str(tmp_path))
    assert report.cleaning["orders in"] == 2
    fact = snapshot.read_star(spark, str(tmp_path))["fact_orders"]
    assert {(r.order_payment_total, r.payment_type, r.review_score) for r in fact.collect()} == {(None, None, None)}


class FakeSession:
    """Only what the staging folder asks of a session."""

    class conf:
        @staticmethod
        def get(key, default):
            return default

    class sparkContext:
        master = "spark://cluster:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_dir(FakeSession)


def test_staged_tables_live_in_the_shared_folder(spark):
    path = staging.staging_path(spark, "x")
    assert path.startswith(staging.shared_dir(spark))
    staged = staging.stage(spark.range(10).filter("id > 3"))
    assert staged.count() == 6 and "Range" not in staged._jdf.queryExecution().executedPlan().toString()


def test_an_unchanged_month_keeps_its_files(spark, built, tmp_path):
    root = str(tmp_path)
    files = lambda: {f.split("/fact_orders/")[1] for f in snapshot.read_star(spark, root)["fact_orders"].inputFiles()}
    first = snapshot.publish(spark, built, root)
    before, old = files(), snapshot.read_star(spark, root)
    held = rows(old["fact_orders"])
    one_day = built["fact_orders"].withColumn("price", F.when(F.col("date_key") == 20180220, 77.0).otherwise(F.col("price")))
    second = snapshot.publish(spark, {**built, "fact_orders": one_day}, root)
    after = files()
    assert {f for f in before if "order_month=201801" in f} < after
    assert {f.split("version=")[1].split("/")[0] for f in after - before} == {second}
    assert all("order_month=201802" in f for f in after ^ before)
    new = snapshot.read_star(spark, root)["fact_orders"]
    assert sorted(r.price for r in new.collect()) == [77.0, 100.0, 200.0]
    assert len({r.fact_key for r in new.collect()}) == 3
    assert rows(old["fact_orders"]) == held  # a reader of the old snapshot goes on
    assert snapshot.expire(spark, root, datetime.timedelta(0)) == [first]
    assert rows(snapshot.read_star(spark, root)["fact_orders"]) == rows(new)
    assert files() == after and not [p for p in tmp_path.rglob(f"order_month=201802/version={first}")]


def test_a_fact_without_new_months_is_checked_for_its_foreign_keys_alone(spark, built, tmp_path, monkeypatch):
    root, seen = str(tmp_path), []
    check = snapshot.constraint_violations

    def watch(tables, **how):
        found = check(tables, **how)
        seen.append({r["check"] for r in found.collect()})
        return found

    monkeypatch.setattr(snapshot, "constraint_violations", watch)
    fact = built["fact_orders"]
    dearer = fact.withColumn("price", F.col("price") + 1)
    for rows_of in (fact, fact, dearer):
        snapshot.publish(spark, {**built, "fact_orders": rows_of}, root)
    first, same, changed = seen
    assert first == changed and first - same == {
        "unique fact_orders.order_id+order_item_id", "price >= 0", "freight_value >= 0", "review_score in 1..5",
        *[f"not null fact_orders.{c}" for c in ("order_id", "order_item_id", "price", "freight_value")],
    }
    with pytest.raises(snapshot.PublishError, match="customer_key"):
        snapshot.publish(spark, {**built, "fact_orders": dearer, "dim_customers": built["dim_customers"].filter("customer_key > 1")}, root)
    with pytest.raises(snapshot.PublishError, match="unique fact_orders"):
        snapshot.publish(spark, {**built, "fact_orders": dearer.unionAll(dearer)}, root)


def test_refreshes_of_the_warehouse_write_no_month_again(spark):
    from tallyhouse import catalogue

    data = "/root/testdata/sf0.001"
    catalogue.QUERIES["s4_atomic_refresh"](spark, data).collect()
    root = catalogue.warehouse(spark, data)["root"]
    written = snapshot._versions(spark, root)
    assert len(snapshot.snapshots(spark, root)) >= 3 and len({version for version, _ in written}) == 1
    assert len(written) == snapshot.read_star(spark, root)["fact_orders"].select(MONTH).distinct().count()


def test_months_that_come_and_go(spark, built, tmp_path):
    """A month without rows is in no later snapshot, one without date is a month of its own, a failed publish leaves no files."""
    root, fact = str(tmp_path), built["fact_orders"]
    snapshot.publish(spark, built, root)
    snapshot.publish(spark, {**built, "fact_orders": fact.filter("date_key < 20180201")}, root)
    assert snapshot.read_star(spark, root)["fact_orders"].count() == 2
    undated = fact.withColumn("date_key", F.when(F.col("date_key") < 20180201, F.col("date_key")))
    for _ in range(2):
        snapshot.publish(spark, {**built, "fact_orders": undated}, root)
        assert sorted(rows(snapshot.read_star(spark, root)["fact_orders"].select(MONTH)), key=str) == [(201801,), (201801,), (None,)]
    with pytest.raises(snapshot.PublishError):
        snapshot.publish(spark, {**built, "fact_orders": undated.withColumn("price", F.lit(-1.0))}, root)
    kept = {v for v, _ in snapshot._versions(spark, root)}
    assert kept <= set(snapshot.snapshots(spark, root))
    assert len(snapshot._versions(spark, root)) == 3  # both first months, and the undated one


def test_empty_fact_is_published(spark, built, tmp_path):
    snapshot.publish(spark, {**built, "fact_orders": built["fact_orders"].filter("false")}, str(tmp_path))
    assert snapshot.read_star(spark, str(tmp_path))["fact_orders"].count() == 0


def test_known_files_are_not_read_again(spark, folder):
    first = sources.manifest(spark, folder)
    path = f"{folder}/x_orders_dataset.csv"
    stamp, text = os.stat(path), open(path).read()

    def rewrite(content):
        """Other content under the same length and time."""
        with open(path, "w") as f:
            f.write(content)
        os.utime(path, ns=(stamp.st_atime_ns, stamp.st_mtime_ns))

    rewrite(text.replace("delivered", "DELIVERED"))
    os.rename(f"{folder}/x_sellers_dataset.csv", f"{folder}/x2_sellers_dataset.csv")
    with open(f"{folder}/y late_sellers_dataset.csv", "w") as f:
        f.write("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns9,1234,sao paulo,sp\n")
    files = {"sellers": "*_sellers_dataset.csv"}
    second = sources.manifest(spark, folder, files, known=first)
    old, new = ({(r.dataset, r.path.split("/")[-1]): (r.rows, r.checksum) for r in m.collect()} for m in (first, second))
    assert new["orders", "x_orders_dataset.csv"] == old["orders", "x_orders_dataset.csv"]
    assert ("sellers", "x_sellers_dataset.csv") not in new and new["sellers", "y late_sellers_dataset.csv"][0] == 1
    assert new["sellers", "x2_sellers_dataset.csv"] == old["sellers", "x_sellers_dataset.csv"]
    rewrite(text)
    totals = lambda known: rows(sources.manifest_totals(sources.manifest(spark, folder, files, known=known)))
    assert totals(None) == totals(second) == rows(sources.manifest_totals(second))


def test_reviews_come_in_files_of_bounded_size(spark, folder, monkeypatch):
    monkeypatch.setattr(sources, "WHOLE", 10)
    with pytest.raises(sources.SourceError, match="order_reviews"):
        sources.load_raw_csv(spark, folder, "order_reviews")
    assert sources.load_raw_csv(spark, folder, "orders").count() == 2


def test_one_shuffle_per_deduplicated_dataset(spark, raw):
    """With a log, counters and result read the staged distinct rows: no plan behind them deduplicates again."""
    from tallyhouse.operators.cleaning import CleaningLog, clean_all

    log = CleaningLog()
    twice = {**raw, "sellers": raw["sellers"].unionByName(raw["sellers"])}
    clean = clean_all(twice, log)
    for name in ("customers", "sellers", "orders", "order_items", "order_payments", "order_reviews", "category_translation"):
        plan = clean[name]._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "HashAggregate" not in plan, name
    counted = log.counts()
    assert (counted["sellers in"], counted["sellers distinct"]) == (4, 2)


def test_month_prints_sum_hashes_without_decimals_per_row(published):
    fact = published["star"]["fact_orders"]
    cells = [F.col(f.name) for f in STAR["fact_orders"] if f.name != "fact_key"]
    expected = {}
    for r in fact.select(MONTH, *[F.xxhash64(F.lit(salt), *cells).alias(f"h{salt}") for salt in (1, 2)]).collect():
        n, a, b = expected.get(r[MONTH], (0, 0, 0))
        expected[r[MONTH]] = (n + 1, a + r.h1, b + r.h2)
    prints = snapshot.month_prints(fact)
    assert {r[MONTH]: (r["rows"], int(r.print1), int(r.print2)) for r in prints.collect()} == expected
    assert "decimal" not in prints._jdf.queryExecution().executedPlan().toString().split("partial_sum")[-1].lower()


def test_checksums_are_summed_without_decimals_per_row(spark):
    import hashlib
    import re

    texts = [str(k) for k in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    expected = sum(int(hashlib.md5(t.encode()).hexdigest()[:15], 16) for t in texts)
    assert rows(sources.fingerprint(df)) == [(300, str(expected))] and rows(sources.fingerprint(df.limit(0))) == [(0, "0")]
    plan = sources.fingerprint(df)._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"16, 10[^)]*\) as (\w+)", plan)) == {"bigint"}


def test_a_fact_of_costly_joins_is_computed_once(spark, built, tmp_path, monkeypatch):
    """What a refresh writes of unchanged months it removes again, with and without a date, and in a job that fails."""
    root, fact, printed = str(tmp_path), built["fact_orders"], []
    prints = snapshot.month_prints
    monkeypatch.setattr(snapshot, "month_prints", lambda df: printed.append(len(df.inputFiles())) or prints(df))
    undated = fact.withColumn("date_key", F.when(F.col("date_key") < 20180201, F.col("date_key")))
    first = snapshot.publish(spark, {**built, "fact_orders": undated}, root, once=True)
    before = rows(snapshot.read_star(spark, root)["fact_orders"])
    second = snapshot.publish(spark, {**built, "fact_orders": undated}, root, once=True)
    assert {v for v, _ in snapshot._versions(spark, root)} == {first} and snapshot.current_snapshot(spark, root) == second
    assert rows(snapshot.read_star(spark, root)["fact_orders"]) == before
    dearer = undated.withColumn("price", F.when(F.col("date_key").isNull(), 77.0).otherwise(F.col("price")))
    third = snapshot.publish(spark, {**built, "fact_orders": dearer}, root, once=True)
    assert sorted((v, p.split(MONTH)[1].split("/")[0]) for v, p in snapshot._versions(spark, root)) == sorted(
        [(first, "=201801"), (first, "=__HIVE_DEFAULT_PARTITION__"), (third, "=__HIVE_DEFAULT_PARTITION__")]
    )
    assert sorted(r.price for r in snapshot.read_star(spark, root)["fact_orders"].collect()) == [77.0, 100.0, 200.0]
    assert len(printed) == 3 and all(printed[:2])  # each publication took its fingerprints of written files alone
    with pytest.raises(snapshot.PublishError):
        snapshot.publish(spark, {**built, "fact_orders": fact.withColumn("price", F.lit(-1.0))}, root, once=True)
    assert {v for v, _ in snapshot._versions(spark, root)} == {first, third}


def test_a_refresh_computes_its_fact_once(spark, folder, tmp_path_factory, monkeypatch):
    root, asked = str(tmp_path_factory.mktemp("once")), []
    write = snapshot.write_fact
    monkeypatch.setattr(snapshot, "write_fact", lambda *args: asked.append(args[-1]) or write(*args))
    refresh.run(spark, folder, root)
    refresh.run(spark, folder, root)
    assert asked == [True, True] and len({v for v, _ in snapshot._versions(spark, root)}) == 1


def test_csv_copies_are_compressed_and_read_back(spark, raw, tmp_path):
    from tallyhouse import catalogue

    text = spark.createDataFrame([("r", "o", 5, None, 'two\nlines, "quoted" \\ ', "2018-01-01", "2018-01-02")], RAW["order_reviews"])
    catalogue._write_csv(raw["order_reviews"].unionByName(text), str(tmp_path / "order_reviews"))
    assert all(p.name.endswith(".csv.gz") for p in (tmp_path / "order_reviews").glob("part-*"))
    read = sources.load_raw_csv(spark, str(tmp_path), "order_reviews", {"order_reviews": "order_reviews"})
    assert rows(read) == rows(raw["order_reviews"].unionByName(text))


def test_a_build_frees_its_shuffles_and_leaves_the_session_as_it_was(spark, raw, tmp_path, monkeypatch):
    seen, publish = [], refresh.publish
    monkeypatch.setattr(refresh, "publish", lambda *args, **how: seen.append(spark.conf.get(refresh.FREED, None)) or publish(*args, **how))
    refresh.build_and_publish(spark, raw, str(tmp_path))
    assert spark.conf.get(refresh.FREED, None) is None
    with pytest.raises(refresh.PhaseError):
        refresh.build_and_publish(spark, {}, str(tmp_path))
    assert spark.conf.get(refresh.FREED, None) is None
    spark.conf.set(refresh.FREED, "false")
    refresh.build_and_publish(spark, raw, str(tmp_path))
    assert seen == ["true", "false"] and spark.conf.get(refresh.FREED, None) == "false"
    spark.conf.unset(refresh.FREED)
