"""Best-fit packing of tokenized documents into sequences of a fixed number of tokens.

Only how many pieces have each length matters for a packing, so the search runs over the
histogram of lengths, which has at most ``limit`` entries however many documents there are:

* Bin completion: take the largest remaining length, enumerate all undominated fillings of
  the room beside it by growing waste, apply one of them, and go on. Branches whose waste already
  rules out a better packing are pruned; the best-fit-decreasing packing is the first incumbent,
  and the search ends at the lower bound or after ``nodes`` steps.
* The plan is a short list of (filling, times). Every piece gets a gapless rank among the pieces
  of its length, spread over ``spread`` buckets or more so that no length has to fit in one task, and the
  plan's rank ranges give its sequence and place by one join with a table bounded by the plan.

Token ids are those that ``tokenizers`` gives for the vocabulary file; the merges themselves run
in ``tiktoken`` with the ranks read from that file, which is several times faster. The ranks
are only used after a check that the file's merges are in order of id, and a text that this
engine refuses goes through ``tokenizers``.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyhouse.llm import tokens
from tallyhouse.llm.shared import column, ship, stage

#: Steps of the search for a better packing than best fit, and pieces of one length that are ranked in one task, about.
NODES, SHARE = 5_000, 100_000
#: A filling: lengths from large to small, the largest piece first.
Filling = tuple[int, ...]


@lru_cache(maxsize=4)
def fast_encoder(path: str):
    """Text to ids (numpy) as ``tokenizers`` encodes without added special tokens."""
    import tiktoken

    slow = tokens.load(path)
    with open(path, encoding="utf-8") as f:
        held = json.load(f)
    vocab, merges = held["model"]["vocab"], held["model"]["merges"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in merges]
    special = {t["content"]: t["id"] for t in held["added_tokens"]}
    back = {c: b for b, c in enumerate(tokens.byte_alphabet())}
    ranks = {bytes(back[c] for c in entry): n for entry, n in vocab.items() if entry not in special}
    made = [vocab[a + b] for a, b in merges]
    ordered = made == sorted(made) and len(set(made)) == len(made) and len(ranks) == 256 + len(made)
    fast = tiktoken.Encoding("file", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens=special) if ordered else None

    def encode(text: str) -> np.ndarray:
        if fast is not None:
            try:
                return np.asarray(fast.encode_to_numpy(text, allowed_special="all"), dtype=np.uint32)
            except (ValueError, RuntimeError):
                pass
        return np.array(slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    return encode


def cut(docs: DataFrame, path: str, limit: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece; the first piece of a long document takes the remainder."""
    ship(docs.sparkSession)
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, tail = fast_encoder(path), np.array([end_id], np.uint32)
        for batch in batches:
            owner, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, value in enumerate(batch.column(1)):
                found = np.concatenate([encode(value.as_py() or ""), tail]).astype("<u4", copy=False)
                first = len(found) % limit or limit
                edges = [0, *range(first, len(found) + 1, limit)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    owner.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(found[a:b].tobytes()))
                    if keep_ids:
                        ids.append(found[a:b].astype(np.int32))
            columns = [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(column(docs, id_col, "long").alias("doc_id"), column(docs, text_col, "string").alias("text"))
    return rows.mapInArrow(pieces, kind)


# ---- the plan over the histogram -------------------------------------------------------


def lower_bound(counts: np.ndarray, limit: int) -> int:
    """Bins that any packing needs: the volume bound, raised by pieces that cannot share (Martello and Toth)."""
    sizes = np.arange(limit + 1, dtype=np.int64)
    best = -(-int((counts * sizes).sum()) // limit)
    number, volume = np.cumsum(counts), np.cumsum(counts * sizes)
    for k in range(0, limit // 2 + 1):
        big = int(number[limit] - number[limit - k]) if k else 0
        half = int(number[limit - k] - number[limit // 2])
        room = half * limit - int(volume[limit - k] - volume[limit // 2])
        small = int(volume[limit // 2] - (volume[k - 1] if k else 0))
        best = max(best, big + half + max(0, -(-(small - room) // limit)))
    return best


def best_fit(counts: np.ndarray, limit: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing over the histogram: bins with the same filling are one group with a number."""
    groups: dict[int, list[list]] = defaultdict(list)
    for size in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[size])
        while left:
            rooms = sorted(r for r, g in groups.items() if g and r >= size)
            if rooms:
                filling, number = groups[rooms[0]].pop()
                used = min(number, left)
                if number > used:
                    groups[rooms[0]].append([filling, number - used])
                groups[rooms[0] - size].append([(*filling, size), used])
                left -= used
            else:
                each = limit // size
                if left >= each:
                    groups[limit - each * size].append([(size,) * each, left // each])
                    left %= each
                else:
                    groups[limit - left * size].append([(size,) * left, 1])
                    left = 0
    return [(tuple(f), n) for g in groups.values() for f, n in g]


def _dilated(sums: int, width: int) -> int:
    """All sums (as bits) raised by 0 to ``width``."""
    out, done = sums, 0
    while done < width:
        step = min(done + 1, width - done)
        out |= out << step
        done += step
    return out


def dominated(chosen: Filling, waste: int, left: dict[int, int]) -> bool:
    """Whether one piece still ``left`` could take the place of some of ``chosen`` (or of none) and fill no less."""
    none, one, more = 1, 0, 0  # sums of no, one, and several of the chosen
    for size in chosen:
        more |= (one << size) | (more << size)
        one |= none << size
    free, held = 0, defaultdict(int)
    for size in chosen:
        held[size] += 1
    for size, n in left.items():
        if n > held[size]:
            free |= 1 << size
    if _dilated(none | more, waste) & free:
        return True
    return waste > 0 and bool(_dilated(one << 1, waste - 1) & free)


def fillings(counts: np.ndarray, largest: int, limit: int, most: int) -> Iterator[tuple[Filling, int]]:
    """All undominated fillings around one piece of the largest length with a waste of at most ``most``, by growing waste.

    Depth first over the sets of each sum, larger pieces first; the sums that the pieces from a size
    down can make, kept as bits, rule out branches that cannot reach the sum.
    """
    room = limit - largest
    left = {int(s): int(counts[s]) - int(s == largest) for s in np.flatnonzero(counts[: room + 1])[::-1]}
    left = {s: n for s, n in left.items() if n and s}
    if room in left:  # alone it dominates all others
        yield (largest, room), 0
        return
    sizes, full = list(left), (1 << (room + 1)) - 1
    reach = [1] * (len(sizes) + 1)
    for i in range(len(sizes) - 1, -1, -1):
        sums, n, k = reach[i + 1], min(left[sizes[i]], room // sizes[i]), 1
        while n:
            step = min(k, n)
            sums |= (sums << (step * sizes[i])) & full
            n, k = n - step, 2 * k
        reach[i] = sums

    def sets(i: int, rest: int) -> Iterator[Filling]:
        if not rest:
            yield ()
            return
        while i < len(sizes) and reach[i] >> rest & 1:
            size = sizes[i]
            for n in range(min(left[size], rest // size), 0, -1):
                if reach[i + 1] >> (rest - n * size) & 1:
                    for more in sets(i + 1, rest - n * size):
                        yield (size,) * n + more
            i += 1

    for waste in range(min(room, most) + 1):
        for chosen in sets(0, room - waste):
            if not dominated(chosen, waste, left):
                yield (largest, *chosen), waste


def complete(counts: np.ndarray, limit: int, nodes: int = NODES) -> list[tuple[Filling, int]]:
    """Fillings and how often each is used; together they use every piece exactly once.

    Depth first: around the largest piece left, every undominated filling is tried, as often as
    it goes at once and, on other branches, once. Bins around pieces of one length are made in the order of
    their fillings. ``nodes`` bounds the search; beyond it the best packing found so far stands, so
    the result is always complete and never worse than best fit.
    """
    best = best_fit(counts, limit)
    bins = sum(n for _, n in best)
    bound, volume = lower_bound(counts, limit), int((counts * np.arange(limit + 1)).sum())

    def children(left: np.ndarray, steps: tuple | None, used: int, waste: int, last: tuple) -> Iterator[tuple]:
        largest = int(np.flatnonzero(left)[-1])
        for filling, more in fillings(left, largest, limit, (bins - 1) * limit - volume - waste):
            order = (more, [-x for x in filling])
            if last and last[0] == largest and order < last[1]:
                continue
            need = defaultdict(int)
            for size in filling:
                need[size] += 1
            times = min(int(left[size]) // n for size, n in need.items())
            for t in {times: 0, 1: 0}:
                after = left.copy()
                for size, n in need.items():
                    after[size] -= n * t
                yield after, ((filling, t), steps), used + t, waste + t * more, (largest, order)

    stack = [children(counts.copy(), None, 0, 0, ())] if bins > bound and counts.any() else []
    while stack and nodes:
        node = next(stack[-1], None)
        if node is None:
            stack.pop()
            continue
        nodes -= 1
        left, steps, used, waste, _ = node
        if waste > (bins - 1) * limit - volume:
            continue
        if left.any():
            stack.append(children(*node))
            continue
        best, bins = [], used
        while steps is not None:
            best.append(steps[0])
            steps = steps[1]
        if bins <= bound:
            break
    return best


def segments(plan: list[tuple[Filling, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, uses, first sequence, first offset): which ranks of a length go where."""
    taken: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for filling, times in sorted(plan, key=lambda p: (-p[0][0], p[0])):
        offset = 0
        for size in sorted(set(filling), reverse=True):
            uses = filling.count(size)
            out.append((size, taken[size], uses * times, uses, sequence, offset))
            taken[size] += uses * times
            offset += uses * size
        sequence += times
    return out


def pack(docs: DataFrame, path: str, limit: int = 1024, end_id: int = 2, spread: int = 256, nodes: int = NODES, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every document with its sequence and place in it.

    Null and empty texts give one piece with the end id alone. Repeated rows and rows with a
    null id are packed one by one. An empty table gives no rows. Extra columns are ignored.
    """
    spark = docs.sparkSession
    pieces = stage(cut(docs, path, limit, end_id, id_col, text_col, keep_ids), "pieces")
    counts = np.zeros(limit + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most ``limit`` rows
        counts[row["length"]] = row["count"]
    spread = max(spread, int(counts.max()) // SHARE)
    table = segments(complete(counts, limit, nodes))
    plan = spark.createDataFrame(table, "size long, first long, ranks long, uses long, sequence long, at long")

    bucketed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(spread)))
    by_length = Window.partitionBy("length").orderBy("bucket")
    before = bucketed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "bucket", (F.sum("n").over(by_length) - F.col("n")).alias("earlier")
    )
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        bucketed.withColumn("rank", F.row_number().over(within) - 1)
        .join(before, ["length", "bucket"])
        .withColumn("rank", F.col("rank") + F.col("earlier"))
    )
    here = (F.col("length") == F.col("size")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("ranks"))
    nth = F.col("rank") - F.col("first")
    return ranked.join(F.broadcast(plan), here).select(  # the plan is bounded by ``limit`` and the search, not by the data
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequence") + F.floor(nth / F.col("uses"))).cast("long").alias("sequence_id"),
        (F.col("at") + (nth % F.col("uses")) * F.col("length")).cast("long").alias("offset"),
        *(["ids"] if keep_ids else []),
    )
