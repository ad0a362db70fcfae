"""Order statistics of whole tables without sorting them: radix selection over histograms.

Values become longs in the same order. A pass counts, for every series at once, how many keys
have each value of their next 16 bits, cumulates these counts and keeps the digit in which each
wanted rank lies; the next pass looks only at keys that begin with the digits kept, and a digit that holds
at most 65 536 rows is then counted key by key. So there are at most four passes, and
as few as the histogram's size allows. What is shuffled is a histogram of at most 65 536 counts
per kept prefix, summed in the tasks first, and what reaches the driver is a row per wanted rank.

``add_tiles`` cuts a table into tiles along several orders at once in this way: the selection
finds the value at each edge of a tile, further selections over the ids find where the edge cuts a
run of equal values, and the tile of a row is then a comparison with the edges.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window as W, functions as F, types as T

from tallyhouse.operators.ranking import Key
from tallyhouse.operators.staging import stage

DIGIT = 16
LEAST, GREATEST = -(1 << 63), (1 << 63) - 1
#: Bytes of an id in one key; the rest of the key tells how many of them there are.
CHUNK = 7


def double_key(c: Column) -> Column:
    """A long for every double, in Spark's order: negative zero equals zero, NaN is greatest.

    Sign and magnitude as in the IEEE format, by arithmetic that is exact: dividing by a power of two.
    """
    return reduce(lambda so_far, step: step(so_far), _STEPS, {"value": c})["key"]


def _size(x: Mapping[str, Column]) -> dict[str, Column]:
    c = x["value"]
    odd = F.isnan(c) | (F.abs(c) == float("inf"))
    return {"value": c, "odd": odd, "size": F.when(odd, F.lit(1.0)).otherwise(F.abs(c))}


def _guess(x: Mapping[str, Column]) -> dict[str, Column]:
    return {**x, "guess": F.greatest(F.coalesce(F.floor(F.log2(x["size"])).cast("int"), F.lit(-1022)), F.lit(-1022))}


def _two(e: Column) -> Column:
    return F.pow(F.lit(2.0), e.cast("double"))


def _power(x: Mapping[str, Column]) -> dict[str, Column]:
    guess, size = x["guess"], x["size"]
    power = F.greatest(guess + (size >= _two(guess + 1)).cast("int") - (size < _two(guess)).cast("int"), F.lit(-1022))
    return {k: x[k] for k in ("value", "odd", "size")} | {"power": power}


def _key(x: Mapping[str, Column]) -> dict[str, Column]:
    c, odd, power = x["value"], x["odd"], x["power"]
    magnitude = F.shiftleft((power + 1022).cast("bigint"), 52) + (x["size"] / _two(power) * F.lit(2.0**52)).cast("bigint")
    greatest = F.lit(0x7FF << 52)
    return {"key": F.when(F.isnan(c), greatest + 1).when(odd, F.when(c > 0, greatest).otherwise(-greatest)).otherwise(F.when(c < 0, -1).otherwise(1) * magnitude)}


#: What a key is made of, each named from those before it.
_STEPS = (_size, _guess, _power, _key)


def double_of(key: int) -> float:
    """The double of a key."""
    size = struct.unpack(">d", (abs(key)).to_bytes(8, "big"))[0]
    return -size if key < 0 else size


def sort_key(df: DataFrame, name: str) -> Column:
    """An order-preserving long of a numeric column; null stays null."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.DecimalType):
        return (c * F.lit(10**kind.scale)).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return c.cast("bigint")
    if isinstance(kind, T.FractionalType):
        return F.when(c.isNotNull(), double_key(c.cast("double")))
    raise TypeError(f"{name} is {kind.simpleString()}, not a number")


@dataclass(frozen=True)
class Found:
    """The key at a rank: rows with a smaller key, with this key, and of the series."""

    key: int
    below: int
    here: int
    total: int


def select_ranks(long: DataFrame, wanted: Callable[[Column], Column], rows: int | None = None) -> dict[tuple[str, int], Found]:
    """The keys at the wanted ranks of every series of ``long`` (series: string, key: long, no nulls).

    ``wanted`` gives the ranks, from 1, as an array of longs for a series of so many rows; ranks
    beyond a series are skipped. ``long`` is read once a pass. ``rows`` is an upper bound of the rows of a series, if known.
    """

    def counted(by: list[str], digit: Column, source: DataFrame, ranks: Callable[[], Column], about: DataFrame | None = None) -> list:
        """``about`` has the wanted ranks of each group: they meet its counts, as arrays would keep the rows from being hashed."""
        counts = source.groupBy(*by, digit.alias("digit")).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        group = W.partitionBy(*by)
        counts = counts.withColumn("upto", F.sum("n").over(group.orderBy("digit"))).withColumn("total", F.sum("n").over(group))
        if about is not None:
            counts = counts.join(F.broadcast(about), by)
        inside = F.filter(ranks(), lambda r: (r > F.col("upto") - F.col("n")) & (r <= F.col("upto")))
        return counts.withColumn("inside", inside).where(F.size("inside") > 0).drop("ranks").collect()

    found: dict[tuple[str, int], Found] = {}
    # Kept digits: (series, digit) -> rows before it, wanted ranks, its rows, rows of the series.
    kept: dict[tuple[str, int], tuple[int, list[int], int, int]] = {}
    at = 0 if rows is not None and rows <= 1 << DIGIT else 64 - DIGIT
    got = [(0, r["total"], at, r) for r in counted(["series"], F.shiftright("key", at), long, lambda: wanted(F.col("total")))]
    while True:
        following = {}
        for before, total, shift, r in got:
            below, ranks = before + r["upto"] - r["n"], [before + x for x in r["inside"]]
            if r["lo"] == r["hi"]:
                found |= {(r["series"], rank): Found(r["lo"], below, r["n"], total) for rank in ranks}
            else:
                following[(r["series"], r["digit"])] = (below, ranks, r["n"], total)
        kept = following
        if not kept:
            return found
        active = long.sparkSession.createDataFrame(
            [(s, prefix, 0 if n <= 1 << DIGIT else at - DIGIT, [r - before for r in ranks]) for (s, prefix), (before, ranks, n, _) in kept.items()],
            "series string, prefix bigint, shift int, ranks array<bigint>",
        )
        near = long.withColumn("prefix", F.shiftright("key", at)).join(F.broadcast(active.drop("ranks")), ["series", "prefix"])
        digit = F.call_function("shiftright", F.col("key"), F.col("shift"))
        rows_ = counted(["series", "prefix"], digit, near, lambda: F.col("ranks"), active)
        got = [(kept[r["series"], r["prefix"]][0], kept[r["series"], r["prefix"]][3], r["shift"], r) for r in rows_]
        at -= DIGIT


def long_form(df: DataFrame, keys: Mapping[str, Column], *others: str) -> DataFrame:
    """(series, key, others) of every non-null key, one row each."""
    cells = [F.struct(F.lit(name).alias("series"), key.alias("key"), *others) for name, key in keys.items()]
    return df.select(F.inline(F.array(*cells))).where("key is not null")


def double_form(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """(series, key) of the columns ``names`` (series to column) as doubles, null cells left out."""
    cells = df.select(*[F.col(f"`{c}`").cast("double").alias(s) for s, c in names.items()]).unpivot([], list(names), "series", "value")
    long = cells.where("value is not null")
    for step in _STEPS:  # a projection each, as an expression named twice is computed twice inside a branch
        long = long.select("series", *[x.alias(name) for name, x in step({c: F.col(c) for c in long.columns[1:]}).items()])
    return long


def quantiles(long: DataFrame, probabilities: Sequence[float]) -> dict[tuple[str, float], float]:
    """Exact quantiles with linear interpolation of every series of double keys."""
    at = lambda n, p: (n - 1) * p

    def wanted(total: Column) -> Column:
        ends = [f(at(total, F.lit(float(p)))) + 1 for p in probabilities for f in (F.floor, F.ceil)]
        return F.array_distinct(F.array(*ends))

    found = select_ranks(long, wanted)
    out: dict[tuple[str, float], float] = {}
    for series, total in {(s, f.total) for (s, _), f in found.items()}:
        for p in probabilities:
            place = at(total, float(p))
            low = int(place)
            high = low + (place > low)
            lo, hi = (double_of(found[(series, k + 1)].key) for k in (low, high))
            out[(series, float(p))] = lo if lo == hi else lo + (hi - lo) * (place - low)
    return out


# ---- tiles -----------------------------------------------------------------------------


def tile_edges(total: Column, tiles: int) -> Column:
    """The last ranks of all tiles but the last; the first ``total % tiles`` tiles hold one row more."""
    ends = [F.lit(j) * F.floor(total / tiles) + F.least(F.lit(j), total % tiles) for j in range(1, tiles)]
    return F.filter(F.array_distinct(F.array(*ends)), lambda r: r > 0)


def chunk_key(id_: Column, known: int) -> Column:
    """The next bytes after the ``known`` ones as a long that orders like them."""
    part = F.substring(id_, known + 1, CHUNK)
    return F.shiftleft(F.coalesce(F.conv(F.rpad(F.hex(part), 2 * CHUNK, "0"), 16, 10).cast("bigint"), F.lit(0)), 3) + F.length(part)


@dataclass
class Edge:
    """Rows up to here are in a tile or before it: all with a smaller key, and of this key, where ids
    cut its run, those whose id begins with at most ``prefix`` (is at most that, if it is a ``whole`` id)."""

    axis: str
    key: int
    rank: int  # among the rows of the key whose id begins with the prefix
    here: int
    prefix: bytes | int = b""
    cut: bool = False
    whole: bool = False

    @property
    def settled(self) -> bool:
        return self.whole or self.rank == self.here

    def passed(self, key: Column, id_: Column) -> Column:
        if not self.cut:
            return key > self.key
        text = id_ if self.whole else F.substring(id_, 1, len(self.prefix))
        return (key > self.key) | ((key == self.key) & (text > F.lit(self.prefix)))


def add_tiles(df: DataFrame, axes: Mapping[str, Key], tiles: int, id_col: str) -> DataFrame:
    """One column per axis with the value of ``ntile(tiles)`` over (axis key, id) in a plain window.

    Axis columns are numbers; the id, a text or a whole number, makes each order total. ``df`` runs
    once, into the shared folder, as the selections read it several times. Nulls are first ascending
    and last descending; the least and the greatest long count as null there.
    """
    numeric = not isinstance(df.schema[id_col].dataType, (T.StringType, T.BinaryType))
    keys = {name: f"_key{k}" for k, name in enumerate(axes)}
    columns = {"_id": F.coalesce(sort_key(df, id_col), F.lit(LEAST)) if numeric else F.coalesce(F.col(f"`{id_col}`").cast("binary"), F.lit(b""))}
    for name, key in axes.items():
        c = sort_key(df, key.name)
        columns[keys[name]] = F.coalesce(F.bitwise_not(c) if key.descending else c, F.lit(GREATEST if key.descending else LEAST))
    seen = Observation()
    frozen = stage(df.withColumns(columns).observe(seen, F.count(F.lit(1)).alias("n"), F.min("_id").alias("least"), F.max("_id").alias("most")), "tiled")
    id_ = F.col("_id")

    cells = {name: F.col(key) for name, key in keys.items()}
    selected = select_ranks(long_form(frozen, cells), lambda total: tile_edges(total, tiles), seen.get["n"])
    edges = [Edge(axis, f.key, rank - f.below, f.here) for (axis, rank), f in selected.items()]
    if numeric:
        _cut_by_ids(frozen, cells, edges, id_, None)
    else:  # bytes that all ids share tell nothing
        known = os.path.commonprefix([bytes(seen.get["least"] or b""), bytes(seen.get["most"] or b"")])
        for e in edges:
            e.prefix = known
        while any(not e.settled for e in edges):
            _cut_by_ids(frozen, cells, edges, id_, len(known))
            known += b"?" * CHUNK
    out = {
        name: (F.lit(1) + reduce(Column.__add__, [e.passed(F.col(keys[name]), id_).cast("bigint") for e in edges if e.axis == name], F.lit(0))).cast("bigint") for name in axes
    }
    return frozen.withColumns(out).drop("_id", *keys.values())


def _cut_by_ids(frozen: DataFrame, cells: Mapping[str, Column], edges: Sequence[Edge], id_: Column, known: int | None) -> None:
    """Settle the open edges by whole numbers, or by the bytes of the ids after the ``known`` ones."""
    open_ = [e for e in edges if not e.settled]
    if not open_:
        return
    ranks: dict[tuple, set[int]] = {}
    for e in open_:
        ranks.setdefault((e.axis, e.key, e.prefix), set()).add(e.rank)
    of = {run: str(k) for k, run in enumerate(ranks)}
    begins = F.lit(0) if known is None else F.substring(id_, 1, known)
    rows = [(axis, key, 0 if known is None else bytearray(prefix), of[axis, key, prefix]) for axis, key, prefix in ranks]
    runs = frozen.sparkSession.createDataFrame(rows, f"axis string, at bigint, prefix {'int' if known is None else 'binary'}, run string")
    met = long_form(frozen, cells, "_id").join(F.broadcast(runs), (F.col("series") == F.col("axis")) & (F.col("key") == F.col("at")) & (begins == F.col("prefix")))
    wanted = F.create_map(*[x for run, own in ranks.items() for x in (F.lit(of[run]), F.array(*[F.lit(r).cast("bigint") for r in sorted(own)]))])
    key = id_ if known is None else chunk_key(id_, known)
    found = select_ranks(met.select(F.col("run").alias("series"), key.alias("key")), lambda total: wanted[F.col("series")], max(e.here for e in open_))
    for e in open_:
        f = found[of[e.axis, e.key, e.prefix], e.rank]
        e.rank, e.here, e.cut = e.rank - f.below, f.here, True
        if known is None:
            e.prefix, e.whole = f.key, True
        else:
            size = f.key & 7
            e.prefix, e.whole = e.prefix + (f.key >> 3).to_bytes(CHUNK, "big")[:size], size < CHUNK
