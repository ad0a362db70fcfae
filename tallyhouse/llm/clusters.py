"""Centroid clustering of integer vectors by scalar lookup tables.

A component of a vector is one of few integers. In every round a task tabulates, for each
dimension, the squared difference between every integer that occurs there and every centroid; the
distances of its vectors are then gathered from the tables and summed, without a multiplication a
vector. Tables cover the integers of one batch, so their size is bounded by the batch whatever
the range of values.

Centroids move by sums that tasks make for themselves and Spark adds up; only the centroids and
their sums, fixed in number by the parameters, pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.shared import column, ship, stage
from tallyhouse.llm.whole import GREATEST, finite, floors, long_sum, matrix, moved, sums_by

SIZE, CENTROIDS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2
#: Rows whose integers share one set of tables.
ROWS = 4096


def distances(values: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids."""
    total = np.zeros((len(values), len(centroids)), np.int64)
    for d in range(values.shape[1]):
        occurring, place = np.unique(values[:, d], return_inverse=True)
        table = (occurring[:, None] - centroids[:, d]) ** 2
        total += table[place]
    return total


def assign(values: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of every row, the smaller number where several are, and its squared distance."""
    found = [distances(values[k : k + ROWS], centroids) for k in range(0, len(values), ROWS)]
    places = [f.argmin(1) for f in found]
    return np.concatenate(places), np.concatenate([f[np.arange(len(f)), p] for f, p in zip(found, places)])


def _summed(centroids: np.ndarray):
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            if batch.num_rows:
                values = matrix(batch.column("values"), centroids.shape[1])
                more = sums_by(assign(values, centroids)[0], values, len(centroids))
                n += more[0]
                s += more[1]
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(n[held]), pa.array(list(s[held]), pa.list_(pa.int64()))], ["cluster", "n", "s"])

    return summed


def _assigned(centroids: np.ndarray):
    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                place, distance = assign(matrix(batch.column("values"), centroids.shape[1]), centroids)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(place.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return assigned


def cluster(
    vectors: DataFrame, size: int = SIZE, centroids: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every row with a usable vector.

    Rows whose vector is null, has another number of components or holds null or non-finite ones
    are dropped. Integers beyond 2^27 count as that bound, and sums beyond a long as the greatest
    long. A null id is hashed as an empty text; equal hashes, as of repeated ids, go by their
    vectors, and repeated rows are rows of their own. With fewer vectors than centroids there are
    as many centroids as vectors. An empty table gives no rows, extra columns are ignored.
    """
    spark = vectors.sparkSession
    ship(spark)
    vector = F.col(f"`{vector_col}`")
    usable = finite(vector) & (F.size(vector) == size)
    rows = vectors.select(column(vectors, id_col, "long").alias("vec_id"), F.when(usable, floors(vector, scale)).alias("values")).where("values is not null")
    placed = stage(rows, "integers")

    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = placed.withColumn("hash", hashed).orderBy("hash", "values").limit(centroids).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centres = np.array([r["values"] for r in first], np.int64)
    for _ in range(rounds):
        for (c,), mean in moved(placed.mapInArrow(_summed(centres), "cluster int, n long, s array<long>"), ["cluster"], size).items():
            centres[c] = mean

    found = stage(placed.mapInArrow(_assigned(centres), "vec_id long, cluster int, distance long"), "clusters")
    totals = {r["cluster"]: r["total"] for r in found.groupBy("cluster").agg(long_sum("distance").alias("total")).collect()}
    inertia = min(sum(totals.values()), GREATEST)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    per = F.array(*[F.struct(F.lit(totals.get(c, 0)).cast("long").alias("total"), F.lit(d).alias("digest")) for c, d in enumerate(digests)])[F.col("cluster")]
    return found.select(
        "vec_id", "cluster", "distance", per["total"].alias("cluster_inertia"), F.lit(inertia).cast("long").alias("inertia"), per["digest"].alias("centroid_sha256")
    )
