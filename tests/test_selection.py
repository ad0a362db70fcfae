"""Order statistics, tiles and ranks without sorts, against plain windows and Python."""

import math
import random
import statistics

import pytest
from conftest import rows
from pyspark.sql import Window as W, functions as F

from tallyhouse.operators import selection
from tallyhouse.operators.groups import group_quantiles, rank_within
from tallyhouse.operators.ranking import asc, desc
from tallyhouse.operators.selection import add_tiles, double_key, double_of, long_form, select_ranks

ODD = [0.0, -0.0, 1.0, -1.0, math.inf, -math.inf, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, -1.7976931348623157e308, 0.1, 3.0, 2**52 + 0.5]


def test_keys_order_doubles_as_spark_does(spark):
    rng = random.Random(4)
    values = ODD + [2.0**e for e in range(-1074, 1024)] + [-(2.0**e) for e in range(-1074, 1024)]
    values += [math.nextafter(2.0**e, -math.inf) for e in range(-1073, 1024)] + [rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300) for _ in range(5000)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", double_key(F.col("v")).alias("k")).collect()
    assert all(double_of(r.k) == r.v for r in got)
    by_key = [r.v for r in sorted(got, key=lambda r: r.k)]
    assert by_key == sorted(values) and len({r.k for r in got}) == len(set(values))
    nan = spark.range(1).select(double_key(F.lit(math.nan)).alias("k")).first().k
    assert nan > max(r.k for r in got) and math.isnan(double_of(nan))


@pytest.mark.parametrize("few", [True, False])
def test_ranks_of_several_series(spark, few):
    rng = random.Random(1)
    series = {"a": [rng.choice([1, 2, 3]) if few else rng.getrandbits(62) - (1 << 61) for _ in range(2000)], "b": [7], "c": [-(1 << 63) + 1, 0, (1 << 63) - 1]}
    long = spark.createDataFrame([(s, k) for s, ks in series.items() for k in ks], "series string, key bigint").repartition(5)
    found = select_ranks(long, lambda n: F.array(F.lit(1).cast("bigint"), F.ceil(n / 2), n, n + 1))
    for s, keys in series.items():
        keys = sorted(keys)
        for rank in {1, math.ceil(len(keys) / 2), len(keys)}:
            f = found[s, rank]
            assert (f.key, f.below, f.here, f.total) == (keys[rank - 1], sum(k < f.key for k in keys), keys.count(f.key), len(keys))
        assert (s, len(keys) + 1) not in found


def test_nothing_to_select(spark):
    assert select_ranks(spark.createDataFrame([], "series string, key bigint"), lambda n: F.array(n)) == {}


def test_whole_columns_as_statistics(spark):
    rng = random.Random(2)
    data = [(None if i % 7 == 0 else rng.gauss(0, 1e6), rng.randrange(5), None) for i in range(999)]
    df = spark.createDataFrame(data, "x double, n int, nothing double").repartition(4)
    got = {(r.column, r.p): r.value for r in group_quantiles(df, [], ["x", "n", "nothing"], [0.25, 0.5, 0.75]).collect()}
    for c, k in (("x", 0), ("n", 1)):
        expected = statistics.quantiles([r[k] for r in data if r[k] is not None], n=4, method="inclusive")
        assert [got[c, p] for p in (0.25, 0.5, 0.75)] == pytest.approx(expected, rel=1e-15)
    assert not any(c == "nothing" for c, _ in got)


def test_no_shuffle_moves_rows(spark):
    """What a pass shuffles is a histogram, summed in the tasks first."""
    long = long_form(spark.range(0, 200_000, 1, 4).withColumn("x", F.col("id") % 10), {"x": F.col("x")})
    digit = long.groupBy("series", F.shiftright("key", 48)).count()
    plan = digit._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan


AXES = {"five": asc("v"), "back": desc("v"), "money": desc("amount"), "same": asc("one"), "x": asc("x")}


def plain_tiles(df, axes, k):
    return df.withColumns({name: F.ntile(k).over(W.orderBy(key.order, "id")).cast("bigint") for name, key in axes.items()})


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(7)
    names = lambda i: ["", "é", "a", "a\0", "ab", "seller-%06d" % i, "%032x" % (i * 2654435761), "s" * 30 + str(i)][i % 8 if i > 7 else i]
    data = [
        (names(i) + (f"/{i}" if i > 7 and i % 8 < 5 else ""), None if i % 50 == 0 else (1 if rng.random() < 0.9 else rng.randrange(2, 9)), 1, rng.choice([None, math.nan, math.inf, -0.0, 0.0, 1.5, 2.5]))
        for i in range(1507)
    ]
    df = spark.createDataFrame(data, "id string, v int, one int, x double")
    return df.withColumn("amount", (F.crc32(F.col("id").cast("binary")) % 1000 - 500).cast("decimal(20,2)") / 100).withColumn("amount", F.col("amount").cast("decimal(18,2)")).repartition(5)


@pytest.mark.parametrize("k", [2, 5, 7])
def test_tiles_equal_plain_windows(scored, k):
    got, expected = add_tiles(scored, AXES, k, "id"), plain_tiles(scored, AXES, k)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in expected.schema]
    assert [repr(r) for r in rows(got)] == [repr(r) for r in rows(expected)]


@pytest.mark.parametrize("n", [0, 1, 3, 5])
def test_fewer_rows_than_tiles(spark, n):
    df = spark.range(n).select(F.col("id").cast("string").alias("id"), (F.col("id") % 2).alias("v"))
    assert rows(add_tiles(df, {"t": desc("v")}, 5, "id")) == rows(df.withColumn("t", F.ntile(5).over(W.orderBy(F.desc("v"), "id")).cast("bigint")))


def test_tiles_need_no_range_shuffle(spark, scored, monkeypatch):
    """One staged table, no sort of its rows: the result is a projection of it."""
    written = []
    real = selection.stage
    monkeypatch.setattr(selection, "stage", lambda df, name: written.append(name) or real(df, name))
    plan = add_tiles(scored, AXES, 5, "id")._jdf.queryExecution().executedPlan().toString()
    assert written == ["tiled"] and not any(word in plan for word in ("Exchange", "Sort", "Window"))


@pytest.mark.parametrize("cells", [1, 3, 256])
@pytest.mark.parametrize("by", [asc("x"), desc("x"), asc("v"), desc("amount")])
def test_ranks_within_hot_groups(spark, scored, cells, by):
    df = scored.withColumn("g", F.when(F.crc32(F.col("id").cast("binary")) % 3 > 0, "hot").when(F.col("v") == 2, F.lit(None)).otherwise(F.concat(F.lit("g"), F.col("v"))))
    expected = df.withColumn("rk", F.rank().over(W.partitionBy("g").orderBy(by.order)).cast("bigint"))
    assert [repr(r) for r in rows(rank_within(df, ["g"], by, "rk", cells))] == [repr(r) for r in rows(expected)]


def test_ranks_need_no_range_shuffle(spark, scored):
    plan = rank_within(scored, ["one"], desc("amount"), "rk")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize("cells", [1, 2, 64])
def test_medians_of_hot_and_small_groups(spark, cells):
    rng = random.Random(3)
    data = [("hot" if i % 3 else (None if i % 2 else f"g{i % 90}"), rng.choice([None, math.inf, 1.0, 2.0]) if i % 4 else rng.gauss(0, 1)) for i in range(2500)]
    df = spark.createDataFrame(data, "g string, x double").repartition(6)
    got = {(r.g, r.p): r.value for r in group_quantiles(df, ["g"], ["x"], [0.1, 0.5], cells).collect()}
    for g in {r[0] for r in data}:
        mine = sorted(x for h, x in data if h == g and x is not None)
        for p in (0.1, 0.5):
            at = (len(mine) - 1) * p
            lo, hi = mine[math.floor(at)], mine[math.ceil(at)]
            assert got[g, p] == (lo if lo == hi else lo + (hi - lo) * (at - math.floor(at)))


def test_every_pass_hashes_its_counts(spark, monkeypatch):
    """Also where a digit is narrowed down: no pass sorts the rows it counts."""
    plans, frame = [], type(spark.range(1))
    monkeypatch.setattr(frame, "collect", lambda df, f=frame.collect: plans.append(df._jdf.queryExecution().executedPlan().toString()) or f(df))
    values = spark.range(3000).select((F.col("id") / 7 + 1000).alias("x"))
    got = {r.p: r.value for r in group_quantiles(values, [], ["x"], [0.5]).collect()}
    assert got == {0.5: pytest.approx(1000 + 1499.5 / 7, rel=1e-15)}
    assert len(plans) > 2 and not any("SortAggregate" in p for p in plans)
