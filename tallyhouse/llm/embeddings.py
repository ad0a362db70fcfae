"""Near-duplicate vectors: an exact cosine join by subspace pigeonhole.

Two unit vectors with cosine ``least`` or more are within squared distance ``2 - 2 * least``. All
vectors are turned by one fixed rotation, which spreads their energy over the coordinates, and cut
into blocks of ``WIDTH`` coordinates. If every block exceeded its share of the squared distance, in
proportion to its coordinates, the sum would exceed the whole; so a pair that links is within the
share of at least one block. Each block is range-joined on its own: a grid over its first two
coordinates, as wide as the block's distance, brings together neighbouring cells, and the
distances in the block's coordinates pick the candidates. The union of the blocks' candidates is
verified by the exact cosine in doubles; a pair that several blocks find counts in the first.

Equal vectors are folded into one with its number before anything is compared. Cells are cut into
packs of about ``PACK`` vectors, so a crowded cell is the work of many tasks, and a pair of packs
gives back one row per vector with links, its number of links and the smallest vector that it
reaches inside the pair, never a row per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tallyhouse.llm.graphs import components
from tallyhouse.llm.shared import column, ship, stage

WIDTH = 16
PACK = 4096
_SLACK = 1e-9


def blocks(size: int, least: float) -> list[tuple[int, int, float]]:
    """(from, to, squared-distance budget) of every block of vectors of this size."""
    number = max(1, round(size / WIDTH))
    edges = [round(k * size / number) for k in range(number + 1)]
    return [(a, b, (2 - 2 * least) * (b - a) / size * (1 + _SLACK) + 1e-12) for a, b in zip(edges, edges[1:])]


def rotation(size: int, seed: int = 17) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.Generator(np.random.Philox(seed)).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def scaled(raw: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest component below one: exact, and no square overflows or vanishes."""
    return np.ldexp(raw, -np.frexp(np.abs(raw).max(1))[1][:, None])


def unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.sqrt((raw * raw).sum(1))[:, None]


def _cells(schema_kind: str, least: float):
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            lengths = np.array([len(x.as_buffer()) for x in batch.column(1)]) // np.dtype(schema_kind).itemsize
            for size in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == size)
                part = batch.take(pa.array(own))
                raw = np.frombuffer(b"".join(part.column(1).to_pylist()), schema_kind).reshape(len(own), size).astype(np.float64)
                turned = unit(scaled(raw)) @ turns.setdefault(size, rotation(size))
                for k, (a, b, budget) in enumerate(blocks(size, least)):
                    step = np.sqrt(budget) * (1 + 1e-6)
                    x = np.floor(turned[:, a] / step).astype(np.int32)
                    y = np.floor(turned[:, min(a + 1, b - 1)] / step).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(np.full(len(own), size, np.int32)), pa.array(np.full(len(own), k, np.int32)), pa.array(x), pa.array(y)],
                        ["node", "size", "block", "x", "y"],
                    )

    return cells


def _linked(kind: str, least: float):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}

        def opened(items: pa.Array, size: int):
            raw = scaled(np.frombuffer(b"".join(items.field("raw").to_pylist()), kind).reshape(len(items), size).astype(np.float64))
            lengths = np.sqrt((raw * raw).sum(1))
            return (
                items.field("rep").to_numpy(zero_copy_only=False), items.field("print").to_numpy(zero_copy_only=False),
                items.field("copies").to_numpy(zero_copy_only=False), raw, lengths, (raw / lengths[:, None]) @ turns.setdefault(size, rotation(size)),
            )

        for batch in batches:
            for i in range(batch.num_rows):
                size, block, same = batch.column("size")[i].as_py(), batch.column("block")[i].as_py(), batch.column("same")[i].as_py()
                cut = blocks(size, least)
                a, b, budget = cut[block]
                left = opened(batch.column("left")[i].values, size)
                right = left if same else opened(batch.column("right")[i].values, size)
                # One product gives minus half the squared distance: the lengths ride along as coordinates.
                x, y = (np.ascontiguousarray(side[5][:, a:b]) for side in (left, right))
                x = np.hstack([x, -(x * x).sum(1)[:, None] / 2, np.ones((len(x), 1))]).astype(np.float32)
                y = np.ascontiguousarray(np.hstack([y, np.ones((len(y), 1)), -(y * y).sum(1)[:, None] / 2]).T.astype(np.float32))
                least_score, found = np.float32(-(budget * 1.0001 + 1e-5) / 2), []
                for k in range(0, len(x), 512):
                    part = x[k : k + 512]
                    near = part @ y >= least_score
                    if same:
                        near &= np.arange(y.shape[1]) > np.arange(k, k + len(part))[:, None]
                    p, q = np.nonzero(near)
                    for s in range(0, len(p), 65536):
                        u, v = p[s : s + 65536] + k, q[s : s + 65536]
                        gaps = np.add.reduceat((left[5][u] - right[5][v]) ** 2, [c[0] for c in cut], axis=1)
                        within = gaps <= np.array([c[2] for c in cut])
                        here = within[:, block] & ~within[:, :block].any(1)
                        u, v = u[here], v[here]
                        cosine = (left[3][u] * right[3][v]).sum(1) / (left[4][u] * right[4][v])
                        good = cosine >= least
                        found.append((u[good], v[good]))
                u, v = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
                shift = 0 if same else len(x)
                rep, print_, copies = (left[k] if same else np.concatenate([left[k], right[k]]) for k in range(3))
                v = v + shift
                links = np.bincount(u, copies[v], len(rep)) + np.bincount(v, copies[u], len(rep))
                least_rep = _reach(rep, u, v)
                own = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rep[own]), pa.array(print_[own]), pa.array(links[own].astype(np.int64)), pa.array(least_rep[own])], ["rep", "print", "links", "to"]
                )

    return linked


def _reach(names: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest name that each place reaches over the links (u, v)."""
    out = names.copy()
    while len(u):
        before = out.copy()
        low = np.minimum(out[u], out[v])
        np.minimum.at(out, u, low)
        np.minimum.at(out, v, low)
        if (out == before).all():
            break
    return out


def near_duplicates(vectors: DataFrame, least: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    A vector that is null, empty, zero or holds null or non-finite components links with nothing and
    is its own component; so does a row without id, whose component is null and which is kept.
    Vectors of different sizes never link. Repeated rows are vectors of their own, and rows with
    one id share a component. Finite components of any size are compared alike, as a row's scale
    does not matter. An empty table gives no rows. Extra columns are ignored.
    """
    ship(vectors.sparkSession)
    element = vectors.schema[vector_col].dataType.elementType
    kind, type_name = ("<f4", "array<float>") if isinstance(element, T.FloatType) else ("<f8", "array<double>")
    vector = F.col(f"`{vector_col}`").cast(type_name)
    fine = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(vector, lambda x: x != 0)
    rows = vectors.select(column(vectors, id_col, "long").alias("vec_id"), F.when(F.coalesce(fine, F.lit(False)), vector).alias("vector"))
    usable = (F.col("vec_id").isNotNull()) & (F.col("vector").isNotNull())

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind) + 0.0  # a negative zero equals zero
            ends = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
            raw = [flat[a:b].astype(kind).tobytes() for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["vec_id", "raw"])

    all_rows = stage(rows.where(usable).mapInArrow(packed, "vec_id long, raw binary").withColumn("print", F.xxhash64("raw")), "vectors")
    reps = stage(all_rows.groupBy("print", "raw").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "reps")

    node = F.struct("rep", "print", "copies", "raw")
    placed = stage(reps.select(node.alias("node"), F.col("raw")).mapInArrow(
        _cells(kind, least), "node struct<rep: long, print: long, copies: long, raw: binary>, size int, block int, x int, y int"
    ), "cells")
    cell = ["size", "block", "x", "y"]
    number = placed.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / PACK).cast("int").alias("packs"))
    dealt = placed.join(number, cell).withColumn("pack", F.pmod(F.col("node.print"), F.col("packs")).cast("int"))
    packs = stage(dealt.groupBy(*cell, "pack").agg(F.collect_list("node").alias("items")), "packs")
    # Half of the neighbouring cells, so that each pair of cells meets once.
    steps = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    left = packs.select("*", F.explode(steps).alias("s")).select(
        "size", "block", (F.col("x") + F.col("s.dx")).alias("x"), (F.col("y") + F.col("s.dy")).alias("y"),
        ((F.col("s.dx") == 0) & (F.col("s.dy") == 0)).alias("own"), F.col("pack").alias("mine"), F.col("items").alias("left"),
    )
    pairs = left.join(packs, cell).where("not own or mine <= pack").select("size", "block", (F.col("own") & (F.col("mine") == F.col("pack"))).alias("same"), "left", F.col("items").alias("right"))
    met = stage(pairs.mapInArrow(_linked(kind, least), "rep long, print long, links long, to long"), "links")

    links = met.groupBy("rep", "print").agg(F.sum("links").alias("links"))
    of = components(met.select(F.col("rep").alias("a"), F.col("to").alias("b")).unionByName(_same_id(all_rows, reps)))
    named = reps.join(links, ["rep", "print"], "left").select("print", "raw", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    found = all_rows.join(named, ["print", "raw"]).join(of.withColumnRenamed("node", "rep"), "rep", "left")
    found = found.select("vec_id", F.col("n_links").cast("long").alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = found.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _same_id(all_rows: DataFrame, reps: DataFrame) -> DataFrame:
    """An id with several vectors links their representatives: edges (a, b)."""
    twice = all_rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("vec_id")
    return all_rows.join(twice, "vec_id", "left_semi").join(reps, ["print", "raw"]).select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
