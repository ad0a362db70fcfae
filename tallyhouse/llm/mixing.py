"""Mixing sources to target weights by weighted sampling without replacement.

Method (Efraimidis and Spirakis): every document draws a uniform number ``u`` from a hash of its
id and gets the exponential key ``-ln(u) / weight``; sorted by key within its source, documents
are taken until the words' prefix sum reaches the budget. A target above the size of a source
first takes whole epochs, only the remainder is sampled.

Everything is DataFrame functions. Prefix sums need no task that holds a source: keys map to a
monotone bucket that is nearly uniform for every weight, sums run inside fine buckets, over the
fine buckets of a coarse one, and over the coarse buckets of a source, so a source with a third of
all rows is spread like the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.llm.shared import WORD, column, free_name, stage

#: Least weight of a document; weights are between this and 1.
LEAST = 0.5
COARSE = 128
FINE = 128 * COARSE


def quality_weight(text: Column) -> Column:
    """1 for plain prose, less for a larger share of markup symbols, never below ``LEAST``."""
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    share = symbols / F.greatest(F.length(text), F.lit(1))
    return F.coalesce(F.greatest(F.lit(LEAST), 1 - 4 * share), F.lit(1.0))


def numbered(keys: DataFrame) -> DataFrame:
    """``keys`` (key) with its position from 0 in the order of code points, without a task that holds all."""
    parts = stage(keys.repartitionByRange(16, "key").withColumn("part", F.spark_partition_id()), "keys")
    inside = parts.withColumn("here", F.row_number().over(Window.partitionBy("part").orderBy("key")) - 1)
    totals = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    earlier = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("earlier"))  # a row per range
    return inside.join(earlier, "part").select("key", (F.col("here") + F.col("earlier")).alias("position"))


def targets(sized: DataFrame, weights: Sequence[float], total: float, most: float) -> DataFrame:
    """key, source_size, target of every source.

    The total is shared by weight, to a millionth of a word; what exceeds ``most`` times a source's size is shared again
    among the others until none is above. Each round is one aggregate of one row.
    """
    sources = sized.groupBy("key").agg(F.sum("size").alias("source_size"))
    sources = stage(sources, "sources")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.element_at(cycle, (F.col("position") % len(weights) + 1).cast("int"))
    sources = stage(sources.join(numbered(sources.select("key")), "key").withColumn("share", weight), "shares")
    cap = F.col("source_size") * F.lit(float(most))
    level, wanted = 0.0, None
    while True:
        free = F.col("share") * F.lit(level) < cap if wanted is not None else F.col("source_size") >= 0
        row = sources.agg(
            F.sum("source_size").alias("size"),
            F.sum(F.when(free, F.col("share"))).alias("share"),
            F.sum(F.when(~free, cap)).alias("full"),
        ).first()
        wanted = total * (row["size"] or 0)
        if not row["share"]:
            break
        higher = (wanted - (row["full"] or 0.0)) / row["share"]
        if higher <= level * (1 + 1e-12):
            break
        level = higher
    return sources.select("key", "source_size", F.round(F.least(F.col("share") * F.lit(level), cap), 6).alias("target"))


def prefix_cut(rows: DataFrame, budgets: DataFrame, nearest: bool) -> DataFrame:
    """``rows`` (key, id, size, draw, order ...) with ``picked``: whether the prefix sum by key stays within ``budget``.

    With ``nearest`` the row that crosses the budget is taken too if that comes closer.
    """
    place = F.least(F.lit(1.0) - F.pow(F.col("draw"), F.lit(LEAST) / F.col("weight")), F.lit(1.0 - 1e-12))
    placed = rows.withColumn("coarse", F.floor(place * COARSE)).withColumn("fine", F.floor(place * FINE))
    placed = placed.repartition("key", "fine")  # for the sums, the window and the join below, which else would stay dealt by source
    fine = placed.groupBy("key", "coarse", "fine").agg(F.sum("size").alias("n"))
    coarse = fine.groupBy("key", "coarse").agg(F.sum("n").alias("n"))
    over = lambda keys, by: F.sum("n").over(Window.partitionBy(*keys).orderBy(by)) - F.col("n")
    coarse = coarse.select("key", "coarse", over(["key"], "coarse").alias("before_coarse")).join(budgets, "key")
    coarse = coarse.repartition("key", "coarse")  # else the fine sums would be dealt by source alone
    fine = fine.select("key", "coarse", "fine", over(["key", "coarse"], "fine").alias("before_fine")).join(coarse, ["key", "coarse"])
    fine = fine.select("key", "fine", "budget", (F.col("before_coarse") + F.col("before_fine")).alias("earlier"))
    order = Window.partitionBy("key", "fine").orderBy(F.log("draw") / F.col("weight") * -1, "id", "size")
    running = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    end = F.col("earlier") + F.col("running")
    aim = end - F.col("size") / 2 if nearest else end
    return (
        placed.withColumn("running", running)
        .join(fine, ["key", "fine"])
        .withColumn("picked", aim <= F.col("budget"))
        .drop("coarse", "fine", "running", "earlier", "budget")
    )


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), total: float = 1.5, most: float = 2.0, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", id_value: Column | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies of every row.

    ``size`` is the number of words of the whole text (null: 0). Sources cycle through ``weights``
    in the order of code points, null last. A row of size 0 takes nothing. Equal ids draw equal
    keys and are ordered by size; fully equal rows are interchangeable. An empty table gives no
    rows. Extra columns are ignored. The draw depends on the id and the seed alone, so reruns agree.
    ``id_value`` is given back in place of the id, to tell rows of one id apart.
    """
    source, text = column(docs, source_col, "string"), column(docs, text_col, "string")
    ident = column(docs, id_col, "long")
    rows = docs.select(
        (ident if id_value is None else id_value).alias("id"),
        F.concat(F.coalesce(ident.cast("string"), F.lit("")), F.lit(f":{seed}")).alias("named"),
        F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source)).alias("key"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        quality_weight(text).alias("weight"),
    )
    hashed = F.conv(F.substring(F.md5(F.col("named").cast("binary")), 1, 13), 16, 10).cast("double")
    rows = stage(rows.withColumn("draw", (hashed + 0.5) / float(2**52)).drop("named"), "sizes")
    aims = stage(targets(rows, weights, total, most), "targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + F.lit(1e-9))).otherwise(F.lit(0))
    aims = aims.withColumn("epochs", epochs)
    budgets = aims.select("key", (F.col("target") - F.col("epochs") * F.col("source_size")).alias("budget"))

    # The prefix that fits; then, from the rows beyond it, those small enough for what is left, to the nearest.
    first = stage(prefix_cut(rows, budgets, nearest=False), "first")
    used = first.where("picked").groupBy("key").agg(F.sum("size").alias("used"))
    left = budgets.join(used, "key", "left").select("key", (F.col("budget") - F.coalesce("used", F.lit(0))).alias("budget"))
    left = stage(left, "left")  # a row per source, whose size Spark then knows
    beyond = first.where(~F.col("picked")).drop("picked")
    small = beyond.join(left.withColumnRenamed("budget", "left"), "key").withColumn("fits", F.col("size") <= 2 * F.col("left")).drop("left")
    second = prefix_cut(small.where("fits").drop("fits"), left, nearest=True)
    names = ["id", "key", "size", "picked"]
    picked = (
        first.where("picked").select(names)
        .unionByName(second.select(names))
        .unionByName(small.where(~F.col("fits")).withColumn("picked", F.lit(False)).select(names))
    )
    copies = F.when(F.col("size") > 0, F.col("epochs") + F.col("picked").cast("long")).otherwise(F.lit(0)).cast("long")
    return picked.join(aims, "key").select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies")
    )


def resample(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with the same columns."""
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    took = mix(keyed, id_value=keyed[key], **settings).groupBy(F.col("doc_id").alias(key)).agg(F.sum("copies").alias("copies"))
    times = free_name(keyed, "copies")
    took = took.where("copies > 0").withColumnRenamed("copies", times)
    once = keyed.dropDuplicates([key]).join(took, key)
    nth = free_name(once, "nth")
    return once.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(times)))).select([F.col(f"`{c}`") for c in docs.columns])
