"""Vectors of whole numbers: scaling, floors, and the sums by which centres move."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Integers beyond this count as this: squared distances of 64 components then always fit a long.
LIMIT = 1 << 27
GREATEST = (1 << 63) - 1


def finite(vector: Column) -> Column:
    """The vector is there and all its components are numbers."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def floors(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, within ``LIMIT``, as array<int>."""
    return F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * F.lit(float(scale)), F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("int"))


def matrix(lists: pa.Array, width: int, kind: type = np.int64) -> np.ndarray:
    """A row per list of ``width`` numbers."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(lists), width)


def sums_by(places: np.ndarray, values: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """How many rows are at each of ``number`` places, and their exact componentwise sums."""
    order = np.argsort(places, kind="stable")
    held, first = np.unique(places[order], return_index=True)
    total = np.zeros((number, values.shape[1]), np.int64)
    if len(held):
        total[held] = np.add.reduceat(values[order], first, axis=0)
    return np.bincount(places, minlength=number), total


def moved(partial: DataFrame, keys: Sequence[str], width: int) -> dict[tuple, list[int]]:
    """Floors of the means by key, from partial rows (keys, n, s: array<long>); one small row a key reaches the driver."""
    columns = [F.sum(F.col("s")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(width)]
    rows = partial.groupBy(*keys).agg(F.sum("n").alias("n"), *columns).collect()
    return {tuple(r[k] for k in keys): [int(r[f"s{k}"]) // r["n"] for k in range(width)] for r in rows}


def long_sum(name: str) -> Column:
    """A sum that ends at the greatest long instead of overflowing."""
    return F.least(F.sum(F.col(name).cast("decimal(38,0)")), F.lit(GREATEST).cast("decimal(38,0)")).cast("long")
