"""Exact medians, quantiles, modes and latest rows per group, safe for hot groups.

``median``, ``percentile`` and ``mode`` keep every distinct value of a group in one
aggregation buffer. Counting (group, value) pairs first spreads a hot group over all tasks
and leaves one row per distinct value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallyhouse.operators.ranking import Key
from tallyhouse.operators.selection import double_form, quantiles
from tallyhouse.operators.staging import stage

#: Cells into which the values of a group are cut.
CELLS = 256


def melt(df: DataFrame, keys: Sequence[str], columns: Sequence[str], kind: str) -> DataFrame:
    """(keys, column, value) rows of the given columns."""
    typed = df.select(*keys, *[F.col(c).cast(kind).alias(c) for c in columns])
    return typed.unpivot(list(keys), list(columns), "column", "value")


def spread(long: DataFrame, keys: Sequence[str], columns: Sequence[str], value: str) -> DataFrame:
    """Back to one column per name; the input holds one row per (keys, column)."""
    cells = [F.max(F.when(F.col("column") == c, F.col(value))).alias(c) for c in columns]
    return long.groupBy(*keys).agg(*cells)


def group_modes(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], default: str | None = "unknown"
) -> DataFrame:
    """Most frequent value per group; ties go to the smallest, an all-null group to ``default``."""
    counts = melt(df, keys, columns, "string").groupBy(*keys, "column", "value").agg(F.count("value").alias("n"))
    best = counts.groupBy(*keys, "column").agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("value"))
    if default is not None:
        best = best.withColumn("value", F.coalesce("value", F.lit(default)))
    return spread(best, keys, columns, "value")


def group_quantiles(df: DataFrame, keys: Sequence[str], columns: Sequence[str], probabilities: Sequence[float], buckets: int = CELLS) -> DataFrame:
    """Exact quantiles with linear interpolation: rows (keys, column, p, value), nulls skipped.

    Without keys, columns are selected from whole (see ``selection``), in a fixed number of
    passes over ``df``; with keys by ``buckets`` cells a group.
    """
    if not keys:
        found = quantiles(double_form(df, {c: c for c in columns}), probabilities)
        rows = [(c, p, v) for (c, p), v in found.items()]  # one row per column and probability
        return df.sparkSession.createDataFrame(rows, "column string, p double, value double")
    return _by_cells(df, keys, columns, probabilities, buckets)


def _by_cells(df: DataFrame, keys: Sequence[str], columns: Sequence[str], probabilities: Sequence[float], cells: int) -> DataFrame:
    """Selection inside groups of any size.

    Equal values of a group are counted first. Splitters from the whole column cut the values of
    every group into at most ``cells`` cells, so a hot group spreads over as many, and a cell holds
    about that part of the column's distinct values at most. Counts of cells, cumulated
    within a group, tell in which cells the wanted places lie; only these are ordered by value.
    """
    group = F.struct(*[F.col(f"`{k}`") for k in keys], F.col("column"))
    # All that follows reads these counts, with their number, so that one exchange serves it.
    counts = (
        melt(df, keys, columns, "double")
        .filter(F.col("value").isNotNull())
        .groupBy(group.alias("g"), (F.col("value") + 0.0).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    splits = counts.where("n > 0").groupBy(F.col("g.column").alias("of")).agg(_splits("value", cells).alias("splits"))
    dealt = counts.join(F.broadcast(splits), F.col("g.column") == F.col("of")).select("g", "value", "n", _place(F.col("splits"), F.col("value"), cells).alias("cell"))

    within = W.partitionBy("g")
    sizes = dealt.groupBy("g", "cell").agg(F.sum("n").alias("rows"))
    sizes = sizes.withColumn("upto", F.sum("rows").over(within.orderBy("cell"))).withColumn("total", F.sum("rows").over(within))
    at = [(F.col("total") - 1) * F.lit(float(p)) for p in probabilities]
    places = F.array(*[
        F.struct(F.lit(float(p)).alias("p"), a.alias("at"), (end(a) + 1).alias("place")) for p, a in zip(probabilities, at) for end in (F.floor, F.ceil)
    ])
    inside = F.filter(F.array_distinct(places), lambda w: (w["place"] > F.col("upto") - F.col("rows")) & (w["place"] <= F.col("upto")))
    hit = sizes.select("g", "cell", (F.col("upto") - F.col("rows")).alias("before"), inside.alias("inside")).where(F.size("inside") > 0)

    seen = F.col("before") + F.sum("n").over(W.partitionBy("g", "cell").orderBy("value"))
    met = dealt.join(hit, ["g", "cell"]).withColumn("seen", seen)
    met = met.select("g", "value", F.explode(F.filter("inside", lambda w: (w["place"] > F.col("seen") - F.col("n")) & (w["place"] <= F.col("seen")))).alias("w"))
    ends = met.groupBy("g", "w.p", "w.at").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    between = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("at") - F.floor("at")))
    return ends.select(*[F.col(f"g.`{k}`").alias(k) for k in keys], F.col("g.column").alias("column"), "p", between.alias("value"))


def _splits(value: Column | str, cells: int) -> Column:
    """Values that cut a column into ``cells`` cells of about even size."""
    shares = ", ".join(f"{k / cells}D" for k in range(1, cells)) or "0D"
    return F.percentile_approx(value, F.expr(f"array({shares})"), 4 * cells)


def _place(splits: Column, value: Column, cells: int) -> Column:
    """How many of the ascending splitters are below the value, by bisection."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(cells.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get(splits, at + step - 1) < value, step).otherwise(0))


def group_medians(df: DataFrame, keys: Sequence[str], columns: Sequence[str], **how) -> DataFrame:
    """One row per group that has any value; columns keep their names."""
    return spread(group_quantiles(df, keys, columns, [0.5], **how), keys, columns, "value")


def rank_within(df: DataFrame, within: Sequence[str], by: Key, name: str, cells: int = CELLS) -> DataFrame:
    """Add ``rank()`` of a numeric column within groups of any size.

    Rows with one rank are counted first, so a hot value is one row. Splitters from the whole column
    cut the values of a group into cells; a cell's first rank comes from the cumulated counts of
    the cells before it, and only values of one cell are ordered in one task. Equal values, nulls
    and NaN among them, always share a cell, so no run of ties has to be stitched. ``df`` runs once,
    into the shared folder.
    """
    key, value = F.struct(*[F.col(f"`{k}`") for k in within], F.col(f"`{by.name}`").alias("_value")), F.col("_key._value")
    frozen = stage(df.withColumn("_key", key), "ranked")
    number = value.cast("double")
    splits = frozen.agg(_splits(number, cells)).first()[0] or []  # at most ``cells`` numbers
    literal = F.expr("array(" + ", ".join(f"double('{x}')" for x in splits) + ")")
    cell = F.when(value.isNull(), -1).otherwise(_place(literal, number, cells))
    group = F.struct(*[F.col("_key").getField(k) for k in within])
    counts = frozen.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    dealt = counts.select("_key", "_n", group.alias("_g"), (-cell if by.descending else cell).alias("_cell"))

    before = F.coalesce(F.sum("_rows").over(W.partitionBy("_g").orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = dealt.groupBy("_g", "_cell").agg(F.sum("_n").alias("_rows")).select("_g", "_cell", before.alias("_before"))
    order = value.desc_nulls_last() if by.descending else value.asc_nulls_first()
    better = F.sum("_n").over(W.partitionBy("_g", "_cell").orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    ranks = dealt.join(starts, ["_g", "_cell"]).select("_key", (F.col("_before") + F.coalesce(better, F.lit(0)) + 1).alias(name))
    return frozen.join(ranks, "_key").select(*df.columns, name)


def latest_per_group(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per group, the greatest by ``newest_first`` with nulls last.

    ``max_by`` combines before the shuffle, so a hot group arrives as one row per task.
    A struct sorts null below every value, which is where nulls belong here.
    """
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*keep), F.struct(*newest_first)).alias("best"))
    return best.select(*keys, *[F.col(f"best.{c}").alias(c) for c in keep])
