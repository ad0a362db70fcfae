import random

import pytest
from pyspark.sql import Window as W, functions as F

from tallyhouse.operators.groups import group_medians, group_modes, group_quantiles, latest_per_group
from tallyhouse.operators.ranking import Ranking, asc, desc, rank_all


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = [
        (i, None if i % 50 == 0 else (1 if rng.random() < 0.9 else rng.randrange(2, 9)), "hot" if i % 3 else f"g{i % 40}")
        for i in range(3001)
    ]
    df = spark.createDataFrame(rows, "id int, v int, g string")
    return df.withColumn("amount", F.col("id").cast("decimal(18,2)")).repartition(5)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def plain(df, want):
    """The same columns by windows that hold a whole group in one task."""
    order = [k.order for k in want.order]
    group = W.partitionBy(*want.within)
    total, ties = group.orderBy(*order), group.orderBy(*order[: want.ties])
    cols = {}
    if want.row_number:
        cols[want.row_number] = F.row_number().over(total).cast("bigint")
    if want.rank:
        cols[want.rank] = F.rank().over(ties).cast("bigint")
    if want.percent_rank:
        cols[want.percent_rank] = F.percent_rank().over(ties)
    for name, k in want.ntiles.items():
        cols[name] = F.ntile(k).over(total).cast("bigint")
    for name, source in want.running.items():
        cols[name] = F.sum(source).over(total.rowsBetween(W.unboundedPreceding, W.currentRow))
    return df.withColumns(cols)


def same(df, want, buckets):
    got, expected = rank_all(df, want, buckets=buckets), plain(df, want)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in expected.schema]
    assert [repr(r) for r in rows(got)] == [repr(r) for r in rows(expected)]


@pytest.mark.parametrize("buckets", [1, 2, 7])
@pytest.mark.parametrize("first", [asc("v"), desc("v")])
def test_equals_plain_window(skewed, first, buckets):
    want = Ranking(
        order=[first, asc("id")],
        row_number="rn",
        rank="rk",
        percent_rank="pr",
        ntiles={"five": 5, "seven": 7},
        running={"cum": "amount", "ids": "id"},
    )
    same(skewed, want, buckets)


@pytest.mark.parametrize("buckets", [1, 3, 6])
def test_equals_plain_window_per_group(skewed, buckets):
    same(skewed, Ranking(order=[desc("v"), asc("id")], within=["g"], row_number="rn", rank="rk"), buckets)


@pytest.mark.parametrize("buckets", [1, 3, 6])
def test_nan_null_and_zero_keys(spark, buckets):
    values = [float("nan")] * 20 + [None] * 10 + [0.0, -0.0, 1.5, float("inf")] * 5
    df = spark.createDataFrame(list(enumerate(values)), "id int, x double").repartition(4)
    same(df, Ranking(order=[asc("x"), asc("id")], row_number="rn", rank="rk", percent_rank="pr"), buckets)
    same(df, Ranking(order=[desc("x"), asc("id")], row_number="rn", rank="rk"), buckets)


def test_sums_with_nulls(spark):
    df = spark.createDataFrame([(i, None if i < 3 or i % 2 else i) for i in range(12)], "id int, v int").withColumn("v", F.col("v").cast("decimal(18,2)"))
    same(df, Ranking(order=[asc("id")], running={"cum": "v"}), 4)


def test_group_restarts_are_refused_for_whole_table_columns():
    for extra in ({"ntiles": {"t": 5}}, {"percent_rank": "p"}, {"running": {"c": "v"}}):
        with pytest.raises(ValueError):
            Ranking(order=[asc("id")], within=["g"], **extra)


def test_single_run_over_all_buckets(spark):
    df = spark.range(500).withColumn("same", F.lit(1))
    got = rank_all(df, Ranking(order=[asc("same"), asc("id")], rank="rk", row_number="rn"), buckets=4)
    assert {r.rk for r in got.collect()} == {1}
    assert sorted(r.rn for r in got.collect()) == list(range(1, 501))


def test_fewer_rows_than_tiles(spark):
    same(spark.range(3), Ranking(order=[asc("id")], ntiles={"t": 5}), 3)


@pytest.mark.parametrize("buckets", [1, 6])
def test_medians_match_builtin(skewed, buckets):
    expected = rows(skewed.groupBy("g").agg(F.median("id").alias("id"), F.median("v").alias("v")))
    assert rows(group_medians(skewed, ["g"], ["id", "v"], buckets=buckets)) == expected


def test_quantiles_interpolate(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,)], "x double")
    got = {r.p: r.value for r in group_quantiles(df, [], ["x"], [0.25, 0.5, 0.75]).collect()}
    assert got == {0.25: 1.75, 0.5: 3.0, 0.75: 5.0}


def test_mode_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, "b", None), (1, "a", None), (2, "x", "k"), (2, "x", None), (2, "y", None)], "g int, s string, t string"
    )
    assert rows(group_modes(df, ["g"], ["s", "t"])) == [(1, "a", "unknown"), (2, "x", "k")]
    assert group_modes(df, ["g"], ["t"], None).filter("g = 1").first().t is None


def test_latest_puts_null_dates_last(spark):
    df = spark.createDataFrame([("o", None, 1), ("o", "2018-01-01", 2), ("p", None, 3)], "k string, d string, s int")
    assert rows(latest_per_group(df, ["k"], ["d"], ["s"])) == [("o", 2), ("p", 3)]


def test_no_rows(spark):
    empty = spark.createDataFrame([], "id int, v decimal(10,2)")
    want = Ranking(order=[asc("id")], row_number="rn", rank="rk", ntiles={"t": 5}, running={"cum": "v"})
    assert rows(rank_all(empty, want, buckets=3)) == []
