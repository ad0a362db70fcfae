import re

import pytest
from pyspark.sql import functions as F

from tallyhouse import catalogue, session
from tallyhouse.operators.ranking import Ranking, asc, rank_all
from tallyhouse.sources import given

SF = "/root/testdata/sf0.001"
FIXED = 4  # shuffle partitions of the session


@pytest.fixture(autouse=True)
def untuned(spark):
    yield
    session.tune(spark)


def exchanges(df):
    return {int(n) for n in re.findall(r"hashpartitioning\(.*?, (\d+)\)", df._jdf.queryExecution().executedPlan().toString())}


def test_exchanges_start_with_more_partitions_on_more_input(spark, monkeypatch):
    monkeypatch.setattr(session, "SHARE", 1 << 30, raising=False)
    small = catalogue.QUERIES["q1_uniqueness_given"](spark, SF)
    assert exchanges(small) == {FIXED}
    monkeypatch.setattr(session, "SHARE", 10_000, raising=False)
    large = catalogue.QUERIES["q1_uniqueness_given"](spark, SF)
    n = -(-given.input_bytes(spark, SF) // 10_000)
    assert n > FIXED and exchanges(large) == {n}
    assert sorted(small.collect()) == sorted(large.collect())


def test_sorts_of_whole_tables_get_more_buckets_on_more_input(spark):
    session.tune(spark, 10 * FIXED * session.SHARE)
    ranked = rank_all(spark.range(1000).withColumn("v", F.col("id") % 7), Ranking(order=[asc("v"), asc("id")], row_number="n"))
    assert "_bucket" not in ranked.columns and session.sorted_buckets(spark) == 10 * FIXED // 4
    files = {f.rsplit("/", 1)[-1][:10] for f in ranked.inputFiles()}
    assert len(files) == 10 * FIXED // 4
    got = [(r["v"], r["id"]) for r in ranked.orderBy("n").collect()]
    assert got == sorted(got) and len(got) == 1000


def test_sizes_named_by_the_session_stay(spark):
    key = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(key, "5m")
    session.tune(spark)
    assert spark.conf.get(key) == "5m"
    spark.conf.unset(key)
    session.tune(spark)
    assert spark.conf.get(key) == session.SIZES[key]
