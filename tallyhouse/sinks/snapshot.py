"""Publish the star schema as one checked, atomically switched snapshot.

    <root>/snapshots/<id>/<table>/   a dimension in Parquet, never changed after publishing
    <root>/snapshots/<id>/months/    the months of the fact: who wrote their files, rows, fingerprint
    <root>/snapshots/<id>/sources/   the source files that the snapshot was built from
    <root>/fact_orders/<month>/version=<id>/   rows of one month as that snapshot wrote them
    <root>/CURRENT                   id of the published snapshot

A month whose rows are those of the published snapshot keeps its files: a refresh adds only the
months that changed, and snapshots share the others. A refresh writes a new snapshot, checks it, and replaces the pointer in one rename. Where it
wrote no month, the rules on rows of the fact alone are not counted anew: these files passed them when they were published. A failed
check or a lost job leaves the pointer, and so every reader, on the old snapshot. Old snapshots
stay until ``expire`` is called with an age that no reader exceeds.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timedelta, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyhouse.functions.columns import halves, whole
from tallyhouse.operators.modelling import DIMENSION_ORDER
from tallyhouse.operators.staging import CODEC, at_once
from tallyhouse.plans.integrity import constraint_violations, stack
from tallyhouse.plans.views import register_views
from tallyhouse.schemas import MONTH, STAR
from tallyhouse.sources.raw import LISTING

POINTER = "CURRENT"
SOURCES = "sources"
FACT, VERSION = "fact_orders", "version"
TABLES = (*DIMENSION_ORDER, FACT)
MONTHS = T.StructType([
    T.StructField(MONTH, T.IntegerType()), T.StructField("rows", T.LongType()), T.StructField("print1", T.DecimalType(38, 0)), T.StructField("print2", T.DecimalType(38, 0)),
    T.StructField(VERSION, T.StringType()),
])
#: Columns of an item; the others repeat within its order.
_OF_ITEM = ("order_item_id", "seller_key", "product_key", "seller_geo_key", "price", "freight_value")
_KEY_BITS = 52  # of a fact key, below the month: tasks and their rows


class PublishError(Exception):
    """A constraint is violated or no snapshot exists; the published state is unchanged."""


def _hadoop(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns, order and types of the table's schema."""
    return df.select([F.col(f.name).cast(f.dataType) for f in STAR[table]])


def write_dimensions(star: Mapping[str, DataFrame], folder: str) -> None:
    at_once([partial(conform(star[name], name).write.mode("overwrite").parquet, f"{folder}/{name}", compression=CODEC) for name in DIMENSION_ORDER])


def month_prints(fact: DataFrame) -> DataFrame:
    """Rows and additive fingerprints per month; the stored key is no content.

    A fingerprint is the sum of 64-bit hashes, put together as a decimal per month instead of per row.
    """
    cells = [F.col(f.name) for f in STAR[FACT] if f.name != "fact_key"]
    hashed = fact.select(MONTH, *[F.xxhash64(F.lit(salt), *cells).alias(f"hash{salt}") for salt in (1, 2)])
    sums = hashed.groupBy(MONTH).agg(F.count(F.lit(1)).alias("rows"), *halves("hash1", "print1"), *halves("hash2", "print2"))
    return sums.select(MONTH, "rows", *[whole(name).alias(name) for name in ("print1", "print2")])


def write_fact(fact: DataFrame, root: str, snapshot: str, published: DataFrame | None, once: bool = False) -> DataFrame:
    """Write the months that ``published`` does not hold with the same rows; returns all months with the version that holds them.

    A month is written whole, in tasks of even size that adaptive execution makes of large and
    small months, and sorted by day and order inside files, where items of an order repeat its values. Its keys are unique in the fact: the month, the
    task's number, the row's place in the task. Where a snapshot is published, the fact is computed
    once for the fingerprints and once more for the months to write. With ``once``, for a fact of costly joins, all months
    are written and the files of those that ``published`` holds are removed again.
    """
    spark, month = fact.sparkSession, F.floor(F.col("date_key") / 100).cast("int")
    fact = fact.withColumn(MONTH, month).select(*[F.col(f.name).cast(f.dataType) for f in STAR[FACT] if f.name != "fact_key"], MONTH)
    held = {} if published is None else {r[MONTH]: r for r in published.collect()}  # a row per calendar month
    same = lambda prints: [r for r in held.values() if (now := prints.get(r[MONTH])) and tuple(now)[: len(MONTHS) - 1] == tuple(r)[: len(MONTHS) - 1]]
    kept = []
    if held and not once:
        kept = same({r[MONTH]: r for r in month_prints(fact).collect()})
        months = [r[MONTH] for r in kept if r[MONTH] is not None]
        stays = F.when(F.col(MONTH).isNull(), F.lit(any(r[MONTH] is None for r in kept))).otherwise(F.col(MONTH).isin(months))
        fact = fact.filter(~stays)
    ordinal = F.coalesce((F.floor(F.col(MONTH) / 100) - 2000) * 12 + F.col(MONTH) % 100, F.lit(0)).cast("bigint")
    # What an order's items repeat is side by side in the exchanged rows, which compresses best.
    side_by_side = fact.select(*_OF_ITEM, *[c for c in fact.columns if c not in _OF_ITEM])
    dealt = side_by_side.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, "date_key", "order_id", "order_item_id")
    keyed = dealt.withColumn("fact_key", F.shiftleft(ordinal, _KEY_BITS) + F.monotonically_increasing_id() + 1).withColumn(VERSION, F.lit(snapshot))
    keyed.select(*STAR[FACT].names, MONTH, VERSION).write.mode("append").partitionBy(MONTH, VERSION).parquet(f"{root}/{FACT}", compression=CODEC)
    written = {r[MONTH]: r for r in month_prints(_fact(spark, root, f"*/{VERSION}={snapshot}")).withColumn(VERSION, F.lit(snapshot)).collect()}
    if once:
        kept = same(written)
        for r in kept:
            _remove(spark, f"{root}/{FACT}/{_folder(r[MONTH], snapshot)}")
            del written[r[MONTH]]
    return spark.createDataFrame([*kept, *written.values()], MONTHS)


def _folder(month: int | None, version: str) -> str:
    """Of a month of the fact, below its folder."""
    return f"{MONTH}={'__HIVE_DEFAULT_PARTITION__' if month is None else month}/{VERSION}={version}"


def _fact(spark: SparkSession, root: str, *folders: str) -> DataFrame:
    """The fact from some of its folders, without their versions; its month is the last column, by which files are pruned."""
    schema = T.StructType([*STAR[FACT], T.StructField(MONTH, T.IntegerType()), T.StructField(VERSION, T.StringType())])
    folder, fs = _hadoop(spark, f"{root}/{FACT}")
    there = [f for f in folders if "*" not in f or fs.globStatus(_hadoop(spark, f"{root}/{FACT}/{f}")[0])]
    read = spark.read.schema(schema).option("basePath", folder.toString())
    fact = read.parquet(*[f"{root}/{FACT}/{f}" for f in there]) if there else spark.createDataFrame([], schema)
    return fact.drop(VERSION)


def read_tables(spark: SparkSession, root: str, snapshot: str) -> dict[str, DataFrame]:
    """The tables of a snapshot."""
    folder = f"{root}/snapshots/{snapshot}"
    tables = {name: spark.read.schema(STAR[name]).parquet(f"{folder}/{name}") for name in DIMENSION_ORDER}
    months = spark.read.schema(MONTHS).parquet(f"{folder}/months").collect()  # a row per calendar month
    return tables | {FACT: _fact(spark, root, *sorted(_folder(r[MONTH], r[VERSION]) for r in months))}


def publish(spark: SparkSession, star: Mapping[str, DataFrame], root: str, sources: DataFrame | None = None, once: bool = False) -> str:
    """Write, check, switch. Returns the snapshot id; a failed attempt is removed.

    ``sources`` is the listing of the files that ``star`` was read from, taken before reading. ``once`` is for ``write_fact``.
    """
    snapshot = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    folder, current = f"{root}/snapshots/{snapshot}", current_snapshot(spark, root)
    published = None if current is None else spark.read.schema(MONTHS).parquet(f"{root}/snapshots/{current}/months")
    try:
        if sources is not None:
            sources.write.parquet(f"{folder}/{SOURCES}")
        write_dimensions(star, folder)
        months = write_fact(star[FACT], root, snapshot, published, once)
        months.coalesce(1).write.parquet(f"{folder}/months")
        passed = published is not None and months.filter(F.col(VERSION) == snapshot).isEmpty()
        broken = constraint_violations(read_tables(spark, root, snapshot), fact_holds=passed).filter("n_violations > 0").collect()  # one row per rule
        if broken:
            raise PublishError("; ".join(f"{r['check']}: {r['n_violations']}" for r in broken))
    except Exception:
        _remove(spark, folder)
        for _, path in _versions(spark, root, snapshot):
            _remove(spark, path)
        raise
    _switch(spark, root, snapshot)
    return snapshot


def _versions(spark: SparkSession, root: str, snapshot: str = "*") -> list[tuple[str, str]]:
    """(snapshot that wrote it, folder) of stored months: as many as calendar months times kept versions."""
    pattern, fs = _hadoop(spark, f"{root}/{FACT}/{MONTH}=*/{VERSION}={snapshot}")
    return [(s.getPath().getName().split("=")[1], s.getPath().toString()) for s in fs.globStatus(pattern) or []]


def expire(spark: SparkSession, root: str, older_than: timedelta) -> list[str]:
    """Remove unpublished snapshots that were written longer ago than ``older_than``; returns their ids.

    Files of a month go when they are as old and no snapshot that stays has them.
    """
    current, limit = current_snapshot(spark, root), datetime.now(timezone.utc) - older_than
    written = lambda s: datetime.strptime(s.split("-")[0], "%Y%m%dT%H%M%S%f").replace(tzinfo=timezone.utc)
    everything = snapshots(spark, root)
    old = [s for s in everything if s != current and written(s) < limit]
    stay = [f"{root}/snapshots/{s}/months" for s in everything if s not in old]
    present = [p for p in stay if _hadoop(spark, p)[1].exists(_hadoop(spark, p)[0])]
    used = {tuple(r) for r in spark.read.schema(MONTHS).parquet(*present).select(MONTH, VERSION).distinct().collect()} if present else set()
    for s in old:
        _remove(spark, f"{root}/snapshots/{s}")
    for s, path in _versions(spark, root):
        month = path.rstrip("/").split("/")[-2].split("=")[1]
        if s != current and written(s) < limit and (int(month) if month.isdecimal() else None, s) not in used:
            _remove(spark, path)
    return old


def published_sources(spark: SparkSession, root: str) -> DataFrame | None:
    """Listing of the source files of the published snapshot; None without a snapshot or a listing."""
    snapshot = current_snapshot(spark, root)
    if snapshot is None:
        return None
    path, fs = _hadoop(spark, f"{root}/snapshots/{snapshot}/{SOURCES}")
    return spark.read.schema(LISTING).parquet(path.toString()) if fs.exists(path) else None


def snapshots(spark: SparkSession, root: str) -> list[str]:
    """Ids below the root, oldest first."""
    folder, fs = _hadoop(spark, f"{root}/snapshots")
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def _remove(spark: SparkSession, folder: str) -> None:
    path, fs = _hadoop(spark, folder)
    fs.delete(path, True)


def _switch(spark: SparkSession, root: str, snapshot: str) -> None:
    jvm = spark._jvm
    temp, fs = _hadoop(spark, f"{root}/.{POINTER}-{snapshot}")
    target, _ = _hadoop(spark, f"{root}/{POINTER}")
    out = fs.create(temp, True)
    out.write(bytearray(snapshot.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(temp), fs.makeQualified(target), options)


def current_snapshot(spark: SparkSession, root: str) -> str | None:
    pointer, fs = _hadoop(spark, f"{root}/{POINTER}")
    if not fs.exists(pointer):
        return None
    return spark.read.text(f"{root}/{POINTER}", wholetext=True).first()[0].strip()


def read_star(spark: SparkSession, root: str, views: bool = False) -> dict[str, DataFrame]:
    snapshot = current_snapshot(spark, root)
    if snapshot is None:
        raise PublishError(f"nothing published at {root}")
    star = read_tables(spark, root, snapshot)
    if views:
        register_views(star)
    return star


def inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Expected against present tables with row counts; ``ok`` needs the table present and not empty."""
    spark = next(iter(tables.values())).sparkSession
    parts = []
    for name in sorted({*TABLES, *tables}):
        rows = tables[name] if name in tables else spark.range(0)
        parts.append(
            rows.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table"),
                F.lit(name in TABLES).alias("expected"),
                F.lit(name in tables).alias("present"),
                "rows",
            )
        )
    return stack(parts).withColumn("ok", F.col("expected") & F.col("present") & (F.col("rows") > 0))


def require_complete(tables: Mapping[str, DataFrame]) -> None:
    """Raise unless exactly the expected tables are there and none is empty."""
    wrong = [r["table"] for r in inventory(tables).filter(~F.col("ok")).collect()]  # one row per table
    if wrong:
        raise PublishError(f"missing, unexpected or empty tables: {', '.join(wrong)}")
