"""Rankings over a whole table without pulling it, or a hot group of it, into one task.

A window without PARTITION BY sends every row to a single partition, and a window over a
hot group does the same to that group. ``rank_all`` has one way for every size:

1. range-partition and sort the rows once by the whole key and write them with their
   (bucket, row in bucket), so that every later pass sees the same buckets;
2. take one row of statistics per bucket and cumulate these rows, one per 16 MB of input
   or as many as there are shuffle partitions, into offsets;
3. add the offsets to the positions inside the bucket.

The sort must be total: end ``order`` with an entity id. Range partitioning compares the
whole key, so a run of equal leading values spreads over as many buckets as it needs. Keys
compare as Spark compares them: nulls and NaN equal themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallyhouse.operators.staging import stage
from tallyhouse.session import sorted_buckets

_ROW_BITS = 33  # layout of monotonically_increasing_id: partition in the upper 31 bits


@dataclass(frozen=True)
class Key:
    """One sort key. Nulls first ascending and last descending, as most engines default to."""

    name: str
    descending: bool = False

    @property
    def order(self) -> Column:
        c = F.col(self.name)
        return c.desc_nulls_last() if self.descending else c.asc_nulls_first()

    @property
    def backwards(self) -> Column:
        return Key(self.name, not self.descending).order


def asc(name: str) -> Key:
    return Key(name)


def desc(name: str) -> Key:
    return Key(name, descending=True)


@dataclass(frozen=True)
class Ranking:
    """What to compute, as output column names.

    ``ties`` is how many leading keys of ``order`` decide equality for ranks; the id that makes
    the sort total is left out. Row numbers and ranks restart at each value of ``within``;
    ntiles, percent ranks and running sums are over the whole table only.
    """

    order: Sequence[Key]
    within: Sequence[str] = ()
    ties: int = 1
    row_number: str | None = None
    rank: str | None = None
    percent_rank: str | None = None
    ntiles: Mapping[str, int] = field(default_factory=dict)
    running: Mapping[str, str] = field(default_factory=dict)  # output -> decimal or integral column

    def __post_init__(self) -> None:
        if self.within and (self.ntiles or self.percent_rank or self.running):
            raise ValueError("ntile, percent_rank and running sums are whole-table only")


def rank_all(df: DataFrame, want: Ranking, buckets: int | None = None) -> DataFrame:
    """Add the columns of ``want`` to ``df``, with the values and types of a plain window.

    ``buckets`` is the number of range partitions, by default one that grows with the input ``tune`` was told of.
    """
    buckets = buckets or sorted_buckets(df.sparkSession)
    keys = [*[asc(c) for c in want.within], *want.order]
    order = [k.order for k in keys]
    frozen = stage(
        df.repartitionByRange(buckets, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_bucket", F.shiftright("_id", _ROW_BITS).cast("int"))
        .withColumn("_row", F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1)
        .drop("_id"),
        "ranked",
    )
    runs: dict[str, int] = {}
    if want.within:
        runs["group"] = len(want.within)
    if want.rank or want.percent_rank:
        runs["tie"] = len(want.within) + want.ties
    out = frozen.join(F.broadcast(_offsets(frozen, keys, runs, list(want.running.values()))), "_bucket")

    # Where the run of each row began: in its bucket, or where the run that reaches into it did.
    row = F.col("_before") + F.col("_row")
    for run, width in runs.items():
        in_bucket = F.rank().over(W.partitionBy("_bucket").orderBy(*order[:width]))
        carried = F.coalesce(F.col(f"_{run}_carried"), F.col("_before") + 1)
        out = out.withColumn(f"_{run}_start", F.when(in_bucket == 1, carried).otherwise(F.col("_before") + in_bucket))
    base = F.col("_group_start") - 1 if want.within else F.lit(0)
    answer: dict[str, Column] = {}
    if want.row_number:
        answer[want.row_number] = (row - base).cast("bigint")
    if want.rank:
        answer[want.rank] = (F.col("_tie_start") - base).cast("bigint")
    if want.percent_rank:
        answer[want.percent_rank] = (F.col("_tie_start") - 1) / F.greatest(F.col("_total") - 1, F.lit(1)).cast("double")
    for name, k in want.ntiles.items():
        answer[name] = _ntile(row, F.col("_total"), k)
    frame = W.partitionBy("_bucket").orderBy("_row").rowsBetween(W.unboundedPreceding, W.currentRow)
    for name, source in want.running.items():
        kind = df.select(F.sum(source).alias("s")).schema["s"].dataType
        here, earlier = F.sum(source).over(frame), F.col(f"_sum_{source}")
        answer[name] = F.coalesce(here + earlier, here, earlier).cast(kind)
    return out.withColumns(answer).select(*df.columns, *answer)


def _ntile(row: Column, total: Column, k: int) -> Column:
    """The first ``total % k`` tiles hold one row more than the others."""
    size, larger = F.floor(total / k), total % k
    edge = larger * (size + 1)
    later = larger + F.ceil((row - edge) / F.greatest(size, F.lit(1)))
    return F.when(row <= edge, F.ceil(row / (size + 1))).otherwise(later).cast("bigint")


def _offsets(frozen: DataFrame, keys: Sequence[Key], runs: Mapping[str, int], sums: Sequence[str]) -> DataFrame:
    """One row per bucket: rows and sums before it, all rows, and where a run that reaches into it began.

    The windows below see one row per bucket, a number fixed before the data is read.
    """
    names = [k.name for k in keys]
    edge = F.struct(*names)
    per_bucket = frozen.groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(edge, "_row").alias("first"),
        F.max_by(edge, "_row").alias("last"),
        *[F.sum(c).alias(f"sum_{c}") for c in dict.fromkeys(sums)],
    )
    for run, width in runs.items():  # rows of the last run of each bucket
        newest = F.rank().over(W.partitionBy("_bucket").orderBy(*[k.backwards for k in keys[:width]]))
        tail = frozen.withColumn("_newest", newest).filter("_newest = 1").groupBy("_bucket").agg(F.count(F.lit(1)).alias(f"{run}_tail"))
        per_bucket = per_bucket.join(tail, "_bucket")
    by = W.orderBy("_bucket")
    past = by.rowsBetween(W.unboundedPreceding, -1)
    out = per_bucket.withColumn("_before", F.coalesce(F.sum("n").over(past), F.lit(0)))
    out = out.withColumn("_total", F.sum("n").over(W.partitionBy()))
    columns = ["_bucket", "_before", "_total"]
    for run, width in runs.items():
        head = F.struct(*[F.col(f"first.{n}") for n in names[:width]])
        end = F.struct(*[F.col(f"last.{n}") for n in names[:width]])
        out = out.withColumn("_head", head).withColumn("_end", end)
        goes_on = F.coalesce(F.lag("_end").over(by).eqNullSafe(F.col("_head")) & (F.row_number().over(by) > 1), F.lit(False))
        out = out.withColumn("_on", goes_on)
        own = F.when(~(F.col("_on") & F.col("_head").eqNullSafe(F.col("_end"))), F.col("_before") + F.col("n") - F.col(f"{run}_tail") + 1)
        out = out.withColumn("_own", own)
        carried = F.when(F.col("_on"), F.last("_own", ignorenulls=True).over(past))
        out = out.withColumn(f"_{run}_carried", carried).drop("_head", "_end", "_on", "_own")
        columns.append(f"_{run}_carried")
    for c in dict.fromkeys(sums):
        out = out.withColumn(f"_sum_{c}", F.sum(f"sum_{c}").over(past))
        columns.append(f"_sum_{c}")
    return out.select(*columns)
