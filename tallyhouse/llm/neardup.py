"""Near-duplicate texts by BagMinHash signatures of five-word shingles.

Similarity is weighted Jaccard over multisets: a shingle counts as often as it occurs. The
weights are whole numbers, so the levels of the method are 1, 2, 4, 8, ...: a shingle of weight
``w`` owns the intervals [0, 1), [1, 2), [2, 4), ... below ``w``. Every interval has a Poisson
process of points over time whose rate is its length times the signature's slots; a point falls
on a slot and on a place of its interval, halved by levels, and counts if the place is below the
weight. The first point of a slot is its signature entry. Two texts agree in a slot with the
probability of their weighted Jaccard, without bias. Points are made in order of time for all
shingles of a batch of texts at once and only up to the time that fills the slots; texts that
still miss a slot go on to twice that time.

Equal texts are folded into one before anything is compared. Signatures are cut into bands; texts
that share a band meet. Within a band, members are first compared with one centre, the text that
meets most others. In bands whose members are then still in different classes, those outside the
centre's class are compared with all others block by block: pairs of different classes with enough
agreeing slots are verified. Every link is verified on the whole texts. A class is a connected component of links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tallyhouse.llm.graphs import components
from tallyhouse.llm.shared import column, free_name, runs, ship, stage
from tallyhouse.llm.textarrays import hashed_words, mix, shingles

SLOTS = 64
ROWS = 4
WORDS = 5
#: Members of a band that are compared as one block.
BLOCK = 256
#: Shingles of about one such block, or one longer text.
PACK = 200_000
#: Agreeing slots that a pair outside the centres needs for the exact comparison: of pairs at 0.8, fewer than one
#: in 10^8 agree in less, against two in 10^4 that meet in no band.
AGREE = 30
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _salt(n: int) -> np.uint64:
    return np.uint64(n * int(_GOLDEN) % 2**64)


def bag(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, owner) with their numbers, in any order."""
    both = mix(keys + (owner.astype(np.uint64) + np.uint64(1)) * _GOLDEN)
    order = np.argsort(both)
    ranked = both[order]
    first = np.ones(len(ranked), bool)
    first[1:] = ranked[1:] != ranked[:-1]
    at = np.flatnonzero(first)
    return keys[order[at]], owner[order[at]], np.diff(np.append(at, len(ranked)))


def signatures(keys: np.ndarray, owner: np.ndarray, weight: np.ndarray, texts: int, slots: int = SLOTS) -> np.ndarray:
    """BagMinHash signature (texts x slots, 32 bits) of weighted sets; a text without keys keeps zeros."""
    out = np.zeros((texts, slots), np.uint32)
    if not len(keys):
        return out
    # One row per owned interval: from ``low``, ``length`` long, counting below ``inside``.
    parts, low, length = [], 0, 1
    while True:
        own = np.flatnonzero(weight > low)
        if not len(own):
            break
        parts.append((owner[own], mix(keys[own] + _salt(low) + np.uint64(1)), np.full(len(own), length), np.minimum(weight[own] - low, length)))
        low, length = low + length, max(low + length, 1)
    who, key, long, inside = (np.concatenate(p) for p in zip(*parts))
    total = np.bincount(who, inside, texts)
    until = (np.log(slots) + 2.0) / np.maximum(total, 1e-300)
    todo = total > 0
    while todo.any():
        best = np.full(texts * slots, np.inf)
        mine = todo[who]
        w, k, n, limit = who[mine], key[mine], long[mine], inside[mine]
        t, times, places, names, r = np.zeros(len(w)), [], [], [], 0
        while len(w):
            draw = mix(k + _salt(2 * r + 1))
            t = t - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (slots * n)
            on = t < until[w]
            w, k, n, limit, t = w[on], k[on], n[on], limit[on], t[on]
            draw = mix(k + _salt(2 * r + 2))
            slot = w * slots + (draw & np.uint64(slots - 1)).astype(np.int64)
            place = ((draw >> np.uint64(8)) & (n - 1).astype(np.uint64)).astype(np.int64)
            hit = place < limit
            times.append(t[hit])
            places.append(slot[hit])
            names.append((draw[hit] >> np.uint64(32)).astype(np.uint32))
            r += 1
        times, places, names = np.concatenate(times), np.concatenate(places), np.concatenate(names)
        np.minimum.at(best, places, times)
        won = times == best[places]
        flat = out.reshape(-1)
        flat[places[won]] = names[won]
        full = np.isfinite(best).reshape(texts, slots).all(1)
        todo &= ~full
        until = until * 2
    return out


def sign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, whole (hash of the text), print1, print2 (of the words in order), n_shingles, signature of every row."""
    ship(docs.sparkSession)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in runs(batch.column(1)):
                hashes, words = hashed_words(batch.column(1)[lo:hi])
                texts = hi - lo
                nth = np.arange(len(hashes), dtype=np.uint64) - np.repeat(words[:-1], np.diff(words)).astype(np.uint64)
                prints = []
                for salt in (1, 2):
                    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes * np.uint64(2 * salt + 1) + (nth + np.uint64(salt)) * _GOLDEN))])
                    prints.append(pa.array((sums[words[1:]] - sums[words[:-1]]).view(np.int64)))
                keys, before = shingles(hashes, words, WORDS)
                counts = np.diff(before)
                found = signatures(*bag(keys, np.repeat(np.arange(texts), counts)), texts)
                raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * SLOTS), texts, [None, pa.py_buffer(found.astype("<u4").tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], batch.column(2)[lo:hi], *prints, pa.array(counts.astype(np.int64)), raw.cast(pa.binary())],
                    ["doc_id", "whole", "print1", "print2", "n_shingles", "signature"],
                )

    rows = docs.select(column(docs, id_col, "long").alias("doc_id"), column(docs, text_col, "string").alias("text")).withColumn("whole", F.xxhash64("text"))
    return rows.mapInArrow(signed, "doc_id long, whole long, print1 long, print2 long, n_shingles long, signature binary")


def overlaps(left: pa.Array, right: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that two texts share and that either has, as multisets, row by row."""
    sides = []
    for texts in (left, right):
        keys, before = shingles(*hashed_words(texts), WORDS)
        counts = np.diff(before)
        sides.append((keys, np.repeat(np.arange(len(texts)), counts), counts))
    (a, own_a, n_a), (b, own_b, n_b) = sides
    both = mix(np.concatenate([a, b]) + (np.concatenate([own_a, own_b]).astype(np.uint64) + np.uint64(1)) * _GOLDEN)
    kinds, which = np.unique(both, return_inverse=True)
    in_a, in_b = np.bincount(which[: len(a)], minlength=len(kinds)), np.bincount(which[len(a) :], minlength=len(kinds))
    owner = np.zeros(len(kinds), np.int64)
    owner[which[: len(a)]] = own_a
    owner[which[len(a) :]] = own_b
    shared = np.bincount(owner, np.minimum(in_a, in_b), len(left)).astype(np.int64)
    return shared, n_a + n_b - shared


def verify(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, most) whose texts (rep, text) overlap by at least ``percent`` of a hundred."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            joined = pc.binary_join_element_wise(batch.column(3), batch.column(4), "")
            for lo, hi in runs(joined):
                part = batch.slice(lo, hi - lo)
                shared, either = overlaps(part.column(3), part.column(4))
                yield part.select([0, 1, 2]).filter(pa.array(100 * shared >= percent * np.maximum(either, 1)))

    text_a = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    text_b = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(text_a, "a").join(text_b, "b").select("a", "b", "most", "text_a", "text_b")
    return both.mapInArrow(linked, "a long, b long, most long")


def _linked_blocks(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between members of different classes, of blocks of minors and blocks of their band.

    Signatures pick the candidates, the multisets decide. A pair that shares several bands is taken in
    the first. Of the links of a member to a class one is given.
    """

    def opened(items: pa.StructArray) -> tuple:
        signature = np.frombuffer(b"".join(items.field("signature").to_pylist()), np.uint32).reshape(len(items), SLOTS)
        return (*(items.field(name).to_numpy() for name in ("rep", "component", "n_shingles")), signature)

    def multisets(items: pa.StructArray, places: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Sorted shingles and their numbers of the texts at ``places``."""
        out, texts = {}, items.field("text").take(pa.array(places))
        for lo, hi in runs(texts):
            found, before = shingles(*hashed_words(texts[lo:hi]), WORDS)
            for k, a, b in zip(places[lo:hi].tolist(), before, before[1:]):
                out[k] = np.unique(found[a:b], return_counts=True)
        return out

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                left_items, right_items, nth = batch.column("left")[r].values, batch.column("right")[r].values, batch.column("nth")[r].as_py()
                (x_rep, x_of, x_n, x_sig), (y_rep, y_of, y_n, y_sig) = opened(left_items), opened(right_items)
                twice = batch.column("minor")[r].as_py()  # both sides are minors: each pair would come from either side
                candidates = {}
                for i in range(len(x_rep)):
                    equal = y_sig == x_sig[i]
                    first = equal.reshape(len(equal), -1, ROWS).all(2).argmax(1)
                    sizes = 100 * np.minimum(x_n[i], y_n) >= percent * np.maximum(x_n[i], y_n)
                    good = (equal.sum(1) >= AGREE) & (first == nth) & sizes & (y_of != x_of[i])
                    if twice:
                        good &= y_rep > x_rep[i]
                    if good.any():
                        candidates[i] = np.flatnonzero(good)
                a, b = [], []
                if candidates:
                    x_bags = multisets(left_items, np.array(list(candidates)))
                    y_bags = multisets(right_items, np.unique(np.concatenate(list(candidates.values()))))
                    for i, near in candidates.items():
                        own, own_times = x_bags[i]
                        keys, times = (np.concatenate([y_bags[j][k] for j in near.tolist()]) for k in (0, 1))
                        at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
                        both = np.where(own[at] == keys, np.minimum(own_times[at], times), 0)
                        shared = np.bincount(np.repeat(np.arange(len(near)), [len(y_bags[j][0]) for j in near.tolist()]), both, len(near)).astype(np.int64)
                        found = near[100 * shared >= percent * (x_n[i] + y_n[near] - shared)]
                        _, one = np.unique(y_of[found], return_index=True)
                        a += [x_rep[i]] * len(one)
                        b += y_rep[found[one]].tolist()
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return pairs.mapInArrow(linked, "a long, b long")


def classes(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id (smallest id of the class), kept (doc_id = class_id), n_shingles, one row per row of ``docs``.

    A text of fewer than five words is one shingle; texts without words, null among them, link
    with nothing. Rows with the same id are one document, whose texts are linked. A null id
    keeps a null class and is kept. An empty table gives no rows. Extra columns are ignored.
    """
    signed = stage(sign(docs, id_col, text_col), "signatures")
    some = signed.where("n_shingles > 0 and doc_id is not null")
    first = [F.first(c).alias(c) for c in ("signature", "n_shingles")]
    reps = some.groupBy("print1", "print2").agg(F.min(F.struct("doc_id", "whole")).alias("least"), *first)
    reps = stage(reps.withColumn("rep", F.monotonically_increasing_id()), "reps")  # numbers of distinct texts

    bands = F.array(*[F.xxhash64(F.substring("signature", 4 * ROWS * k + 1, 4 * ROWS), F.lit(k)) for k in range(SLOTS // ROWS)])
    met = reps.select("rep", "n_shingles", F.posexplode(bands).alias("nth", "band"))
    sizes = met.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # A text has one row a band, so the window's groups are bounded by the number of bands.
    met = met.join(sizes, "band").withColumn("centre", F.sum("n").over(Window.partitionBy("rep"))).drop("n")
    met = stage(met, "met")
    rows = docs.select(column(docs, id_col, "long").alias("doc_id"), column(docs, text_col, "string").alias("text")).withColumn("whole", F.xxhash64("text"))
    members = reps.join(met.select("rep").distinct(), "rep", "left_semi").select("rep", "least.doc_id", "least.whole", "signature", "n_shingles")
    texts = rows.join(members, ["doc_id", "whole"]).groupBy("rep").agg(F.max("text").alias("text"), *first)
    texts = stage(texts, "texts")

    # Every member of a band against its centre, the member that meets most texts in all bands.
    centre = met.groupBy("band").agg(F.max(F.struct("centre", (-F.col("rep")).alias("low"))).alias("c"))
    centre = centre.select("band", (-F.col("c.low")).alias("b"), F.col("c.centre").alias("most"))
    pairs = met.join(centre, "band").where("rep <> b").select(F.col("rep").alias("a"), "b", "most").distinct()
    star = stage(verify(pairs, texts, percent), "star")

    # Classes as far as the centres tell, over two steps. Bands that still hold several go on, but for
    # those of two members, whose only pair is tested.
    near = star.groupBy("a").agg(F.max(F.struct("most", (-F.col("b")).alias("low"))).alias("c")).select("a", (-F.col("c.low")).alias("b"))
    far = near.select(F.col("a").alias("b"), F.col("b").alias("c"))
    near = near.join(far, "b", "left").select(F.col("a").alias("rep"), F.coalesce("c", "b").alias("component"))
    placed = stage(met.join(near, "rep", "left").withColumn("component", F.coalesce("component", "rep")), "placed")
    main = F.max(F.struct("centre", (-F.col("rep")).alias("low"), "component")).alias("main")
    bands = placed.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"), main).where("x <> y and n > 2")
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("size") / PACK)).cast("int")
    bands = bands.select("band", F.col("main.component").alias("main"), blocks.alias("blocks"))

    # There, those outside the centre's class against all, in blocks, so that no band is one task's work.
    left = placed.join(bands, "band").withColumn("minor", F.col("component") != F.col("main"))
    left = left.select("band", "nth", "rep", "component", "minor", F.pmod(F.xxhash64("rep"), F.col("blocks")).alias("block"))
    member = F.struct("rep", "component", "n_shingles", "signature", "text")
    packs = left.join(texts, "rep").groupBy("band", "nth", "minor", "block").agg(F.collect_list(member).alias("items"))
    packs = stage(packs, "blocks")
    minors = packs.where("minor").select("band", "nth", F.col("items").alias("left"))
    pairs = minors.join(packs.select("band", "minor", F.col("items").alias("right")), "band")
    more = stage(_linked_blocks(pairs, percent), "links")

    # An id with several texts links them.
    several = some.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    twice = some.join(several, "doc_id", "left_semi").join(reps.select("print1", "print2", "rep"), ["print1", "print2"]).select("doc_id", "rep")
    twice = twice.join(twice.groupBy("doc_id").agg(F.min("rep").alias("b")), "doc_id").select(F.col("rep").alias("a"), "b")
    links = star.select("a", "b").unionByName(more).unionByName(twice)
    of = components(links).withColumnRenamed("node", "rep")
    named = reps.select("print1", "print2", "rep", "least.doc_id").join(of, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    named = stage(named, "named")
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    named = named.join(smallest, "component").select("print1", "print2", "class_id")
    classed = some.join(named, ["print1", "print2"]).select("doc_id", "class_id", "n_shingles")
    alone = signed.where("n_shingles = 0 or doc_id is null").select("doc_id", F.col("doc_id").alias("class_id"), "n_shingles")
    out = classed.unionByName(alone)
    return out.select("doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"), "n_shingles")


def keep_one(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without all but one document of each class, with the same columns."""
    other = free_name(docs, "gone_id")
    gone = classes(docs, percent, id_col, text_col).where(~F.col("kept")).select(F.col("doc_id").alias(other)).distinct()
    left = docs.join(gone, column(docs, id_col, "long") == F.col(other), "left_anti")
    nth = free_name(docs, "nth")
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    own = column(left, id_col, "long")
    one = Window.partitionBy(own, F.when(own.isNull(), whole)).orderBy(whole)
    return left.withColumn(nth, F.row_number().over(one)).where(F.col(f"`{nth}`") == 1).drop(nth)
