"""Vector codes: each part of a vector becomes the index of its nearest codebook entry.

The nearest entry is found by LAESA. A few pivots a part, spread over the first codebook, never
change; every part's distances to them are computed once and staged beside the vectors. In a round
only the distances between pivots and entries are new, and by the triangle inequality the largest
difference of the two is a lower bound of the distance to an entry. Entries are tried in ascending
order of that bound, in waves that double, with exact integer distances, until no bound is left
that could reach the best distance found: ties included, so the lowest index wins.

Codebooks move between rounds by sums that tasks make for themselves and Spark adds up; only the
codebooks, a number of integers fixed by the parameters, pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.shared import column, ship, stage
from tallyhouse.llm.whole import finite, floors, long_sum, matrix, moved, sums_by

PARTS, ENTRIES, ROUNDS, SCALE, PIVOTS = 4, 256, 4, 1024, 16
#: Rows of one step of the search, and shares of a label in the last join.
ROWS, SHARES = 256, 16
#: Distances are square roots in doubles; bounds are lowered by this share of the largest distance.
_SLACK = 1e-9


def squared(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all others."""
    return np.stack([((rows - o) ** 2).sum(1) for o in others], axis=1) if len(others) else np.zeros((len(rows), 0), np.int64)


def spread(entries: np.ndarray, number: int) -> np.ndarray:
    """Pivots: the first entry, then always the entry farthest from the ones chosen."""
    chosen = [0]
    away = squared(entries, entries[:1])[:, 0]
    while len(chosen) < min(number, len(entries)):
        chosen.append(int(away.argmax()))
        away = np.minimum(away, squared(entries, entries[chosen[-1:]])[:, 0])
    return entries[chosen]


def nearest(rows: np.ndarray, near: np.ndarray, entries: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of the nearest entry, its squared distance, and how many distances were evaluated.

    ``near`` holds the distances of rows to pivots and ``between`` those of entries to pivots.
    """
    low = np.abs(near[:, :1] - between[:, 0])
    for p in range(1, near.shape[1]):
        np.maximum(low, np.abs(near[:, p : p + 1] - between[:, p]), out=low)
    low -= _SLACK * max(near.max(initial=0.0), between.max(initial=0.0))
    order = np.argsort(low, axis=1)
    low = np.take_along_axis(low, order, axis=1)
    best = np.full(len(rows), np.iinfo(np.int64).max)
    code = np.full(len(rows), len(entries))
    open_, at, step, evaluated = np.arange(len(rows)), 0, 1, 0
    while len(open_) and at < len(entries):
        to = min(at + step, len(entries))
        tried = order[open_, at:to]
        i, j = np.nonzero(low[open_, at:to] <= np.sqrt(best[open_])[:, None])
        gaps = rows[open_[i]] - entries[tried[i, j]]
        found = np.full(tried.shape, np.iinfo(np.int64).max)
        found[i, j] = np.einsum("ij,ij->i", gaps, gaps)
        evaluated += len(i)
        least = found.min(1)
        index = np.where(found == least[:, None], tried, len(entries)).min(1)
        won = (least < best[open_]) | ((least == best[open_]) & (index < code[open_]))
        best[open_[won]], code[open_[won]] = least[won], index[won]
        at, step = to, step * 2
        if at < len(entries):
            open_ = open_[low[open_, at] <= np.sqrt(best[open_])]
    return code, best, evaluated


class Books:
    """The codebooks of one round and their distances to the fixed pivots."""

    def __init__(self, entries: np.ndarray, pivots: np.ndarray):
        self.entries, self.pivots = entries, pivots  # (part, entry, place) and (part, pivot, place)
        self.between = [np.sqrt(squared(e, p).astype(np.float64)) for e, p in zip(entries, pivots)]

    def near(self, cut: np.ndarray) -> np.ndarray:
        """Distances of every part to its pivots: (row, part, pivot)."""
        return np.stack([np.sqrt(squared(cut[:, p], self.pivots[p]).astype(np.float64)) for p in range(len(self.pivots))], axis=1)

    def assign(self, cut: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and squared distances: (row, part) each."""
        parts = [
            [nearest(cut[k : k + ROWS, p], near[k : k + ROWS, p], self.entries[p], self.between[p])[:2] for k in range(0, len(cut), ROWS)]
            for p in range(len(self.entries))
        ]
        return tuple(np.stack([np.concatenate([found[k] for found in part]) for part in parts], axis=1) for k in (0, 1))

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _cut(batch: pa.RecordBatch, name: str, books: Books) -> np.ndarray:
    parts, _, place = books.entries.shape
    return matrix(batch.column(name), parts * place).reshape(batch.num_rows, parts, place)


def _near(batch: pa.RecordBatch, books: Books) -> np.ndarray:
    parts, pivots, _ = books.pivots.shape
    return matrix(batch.column("near"), parts * pivots, np.float64).reshape(batch.num_rows, parts, pivots)


def _measured(books: Books):
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = books.near(_cut(batch, "values", books)).reshape(batch.num_rows, -1)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(near.ravel()), near.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "near"])

    return measured


def _summed(books: Books):
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, place = books.entries.shape
        n, s = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, place), np.int64)
        for batch in batches:
            if batch.num_rows:
                cut = _cut(batch, "values", books)
                code, _ = books.assign(cut, _near(batch, books))
                for p in range(parts):
                    more = sums_by(code[:, p], cut[:, p], entries)
                    n[p] += more[0]
                    s[p] += more[1]
        p, e = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(n[p, e]), pa.array(list(s[p, e]), pa.list_(pa.int64()))], ["part", "entry", "n", "s"]
        )

    return summed


def _coded(books: Books):
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                code, error = books.assign(_cut(batch, "values", books), _near(batch, books))
                text = ["".join(f"{c:02x}" for c in row) for row in code.tolist()]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()), pa.array(error.sum(1))], ["vec_id", "label", "code", "error"])

    return coded


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, pivots: int = PIVOTS,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row with a usable vector.

    A vector that is null or holds null or non-finite components is dropped. Where lengths differ
    or do not divide by the number of parts, a component that is missing at the end counts as
    zero. Integers beyond 2^27 count as that bound, and sums beyond a long as the greatest long.
    The first codebook takes null ids last and repeated ids by their vectors; with fewer vectors
    than entries it is as long as there are vectors. Repeated rows are rows of their own, null
    labels are one label, an empty table gives no rows, extra columns are ignored.
    """
    spark = vectors.sparkSession
    ship(spark)
    vector = F.col(f"`{vector_col}`")
    rows = vectors.select(column(vectors, id_col, "long").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), F.when(finite(vector), floors(vector, scale)).alias("values")).where("values is not null")
    kind = f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, "
    longest = rows.agg(F.max(F.size("values"))).first()[0]
    if longest is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    width = -(-longest // parts) * parts
    rows = rows.withColumn("values", F.concat("values", F.array_repeat(F.lit(0), F.lit(width) - F.size("values"))))

    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "values").limit(entries).collect()
    start = np.array([r["values"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    books = Books(start, np.stack([spread(e, pivots) for e in start]))
    placed = stage(rows.mapInArrow(_measured(books), kind + "values array<int>, near array<double>"), "parts")
    for _ in range(rounds):
        means = moved(placed.mapInArrow(_summed(books), "part int, entry int, n long, s array<long>"), ["part", "entry"], width // parts)
        entry = books.entries.copy()
        for (p, e), mean in means.items():
            entry[p, e] = mean
        books = Books(entry, books.pivots)

    coded = stage(placed.mapInArrow(_coded(books), kind + "code string, error long"), "codes")
    # A label may be that of a third of all rows: its rows meet its sum in as many shares.
    sums = coded.groupBy("label").agg(long_sum("error").alias("label_error"))
    sums = sums.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)))).withColumnRenamed("label", "of")
    dealt = coded.withColumn("share", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SHARES)).cast("int"))
    found = dealt.join(sums, F.col("label").eqNullSafe(F.col("of")) & (dealt["share"] == sums["share"]))
    return found.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
