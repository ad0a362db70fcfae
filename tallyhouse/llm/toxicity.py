"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are words and their first 3 to 7 bytes, lower-cased, so that a family of word forms shares
terms. The vocabulary is every term whose presence depends on the label (chi squared of at least
``DEPENDS``, more frequent in toxic texts); document frequencies and weights come from the examples, a
bounded sample of labelled training rows: those with the ``EXAMPLES`` smallest hashes of
their ids.

The examples with any such term form an inverted index in blocks: for each term, its weights in a
block and the largest of them. A query adds up, block by block, the block maxima of its terms;
blocks are opened from the highest bound down until the bound is below the k-th best cosine, so
the neighbours are exactly those of a full scan. Votes are weighted by closeness, and an isotonic
map from left-out votes to observed labels calibrates them. A text without a term has no
neighbour and gets the share of toxic examples among such texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.shared import column, fold, runs, ship, stage, utf8
from tallyhouse.llm.textarrays import mix, word_hashes

EXAMPLES = 20_000
NEIGHBOURS = 25
BLOCK = 64
PREFIXES = (3, 4, 5, 6, 7)
#: Least chi squared of a term: about one in 10^8 by chance.
DEPENDS = 33.0
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def text_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of texts, and the text of each."""
    raw, at = utf8(pc.utf8_lower(texts))
    solid = _WORD[raw]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    begins, ends = at[:-1][at[:-1] < at[1:]], at[1:][at[:-1] < at[1:]] - 1
    first[begins], last[ends] = solid[begins], solid[ends]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    owner = np.repeat(np.arange(len(at) - 1), np.diff(np.searchsorted(starts, at)))
    terms, owners = [mix(word_hashes(raw, starts, stops))], [owner]
    for size in PREFIXES:
        long = stops - starts > size
        terms.append(mix(word_hashes(raw, starts[long], starts[long] + size) + np.uint64(size)))
        owners.append(owner[long])
    return np.concatenate(terms), np.concatenate(owners)


@dataclass
class Index:
    terms: np.ndarray  # sorted hashes
    idf: np.ndarray
    ids: np.ndarray  # of the examples, in blocks
    toxic: np.ndarray
    ends: np.ndarray  # of each block's weights, from 0
    row: np.ndarray  # example in its block, place and weight of every weight
    place: np.ndarray
    weight: np.ndarray
    most: np.ndarray  # blocks x terms
    empty: float  # probability without any term
    steps: np.ndarray  # calibration: votes and probabilities
    values: np.ndarray

    @property
    def weights(self) -> np.ndarray:
        """All weights as blocks x BLOCK x terms."""
        out = np.zeros((len(self.most), BLOCK, len(self.terms)))
        out[np.repeat(np.arange(len(self.most)), np.diff(self.ends)), self.row, self.place] = self.weight
        return out

    def vectors(self, hashes: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(text, places, unit TF-IDF weights) of every text with a term of the vocabulary."""
        if not len(self.terms):
            return
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        hit = self.terms[at] == hashes
        both, times = np.unique(owner[hit] * np.int64(len(self.terms)) + at[hit], return_counts=True)
        text, place = both // len(self.terms), both % len(self.terms)
        value = (1 + np.log(times)) * self.idf[place]
        starts = np.flatnonzero(np.diff(text, prepend=-1))
        for a, b in zip(starts, np.append(starts[1:], len(text))):
            yield int(text[a]), place[a:b], value[a:b] / np.sqrt(value[a:b] @ value[a:b])

    def nearest(self, place: np.ndarray, value: np.ndarray, k: int = NEIGHBOURS, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of highest cosine (above 0), ties by place; ``without`` leaves one example out."""
        bound = self.most[:, place] @ value
        query = np.zeros(len(self.terms))
        query[place] = value
        best, who, least = np.zeros(0), np.zeros(0, np.int64), 0.0
        for block in np.argsort(-bound, kind="stable"):
            if bound[block] <= 0 or (len(best) == k and bound[block] < least - 1e-9):
                break
            own = slice(self.ends[block], self.ends[block + 1])
            cosine = np.bincount(self.row[own], self.weight[own] * query[self.place[own]], BLOCK)
            own = np.flatnonzero(cosine > 0)
            best, who = np.append(best, cosine[own]), np.append(who, own + block * BLOCK)
            if without >= 0:
                best, who = best[who != without], who[who != without]
            order = np.lexsort((who, -best))[:k]
            best, who = best[order], who[order]
            least = best[-1] if len(best) == k else 0.0
        return best, who

    def vote(self, cosine: np.ndarray, who: np.ndarray) -> float:
        """Share of toxic neighbours, each by 1 / (distance + 0.05), with one vote of the prior."""
        weight = 1 / (1.05 - np.minimum(cosine, 1.0))
        return float((weight @ self.toxic[who] + self.empty) / (weight.sum() + 1))

    def probability(self, vote: float) -> float:
        if not len(self.steps):
            return self.empty
        return float(np.interp(vote, self.steps, self.values))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nondecreasing least-squares fit (pool adjacent violators): mean x and value of each pool."""
    pools: list[list[float]] = []
    for a, b in sorted(zip(x.tolist(), y.tolist())):
        pools.append([a, b, 1.0])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    sums = np.array(pools).reshape(-1, 3)
    # One pseudo-case of each label keeps the ends away from 0 and 1.
    return sums[:, 0] / sums[:, 2], (sums[:, 1] + 0.5) / (sums[:, 2] + 1)


def build(ids: np.ndarray, toxic: np.ndarray, hashes: list[np.ndarray], terms: np.ndarray, seen: np.ndarray) -> Index:
    """The index over examples given by the term hashes (with repeats) of each."""
    order = np.argsort(terms)
    terms, idf = terms[order], np.log((1 + len(ids)) / (1 + seen[order])) + 1
    index = Index(terms, idf, ids, toxic, np.zeros(1, np.int64), *[np.zeros(0, np.int64)] * 2, np.zeros(0), np.zeros((0, len(terms))), 0.0, np.zeros(0), np.zeros(0))
    owner = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
    found = list(index.vectors(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), owner))
    # Examples with the same heaviest term lie together, so that block maxima tell blocks apart.
    found.sort(key=lambda f: (int(f[1][np.argmax(f[2])]), len(f[1]), f[0]))
    number = -(-len(found) // BLOCK)
    if found:
        example = np.repeat(np.arange(len(found)), [len(place) for _, place, _ in found])
        index.row, index.place, index.weight = example % BLOCK, np.concatenate([f[1] for f in found]), np.concatenate([f[2] for f in found])
        index.ends = np.searchsorted(example, np.arange(number + 1) * BLOCK)
        index.most = np.zeros((number, len(terms)))
        np.maximum.at(index.most, (example // BLOCK, index.place), index.weight)
    mine = [text for text, _, _ in found]
    index.ids, index.toxic = ids[mine], toxic[mine].astype(float)
    rest = np.setdiff1d(np.arange(len(ids)), mine)
    index.empty = float((toxic[rest].sum() + 0.5) / (len(rest) + 1)) if len(ids) else 0.0
    if found:
        votes = [index.vote(*index.nearest(place, value, without=k)) for k, (_, place, value) in enumerate(found)]
        index.steps, index.values = isotonic(np.array(votes), index.toxic)
    return index


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, parts: int = 5, held: int = 0, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index of a bounded sample of labelled rows outside the held-out fold.

    Conflicting labels of an id count as toxic if any is; labels other than 0 and 1 are ignored.
    """
    ship(docs.sparkSession)
    known = labels.select(column(labels, "doc_id", "long").alias("id"), column(labels, "toxic", "int").alias("toxic")).where("toxic in (0, 1) and id is not null")
    known = known.where(fold(F.col("id"), parts) != held).groupBy("id").agg(F.max("toxic").alias("toxic")).withColumn("draw", F.xxhash64("id", F.lit(19)))
    least = known.select("draw").orderBy("draw").limit(examples).agg(F.max("draw")).first()[0]
    known = known.where(F.col("draw") <= F.lit(least)) if least is not None else known.where(F.lit(False))
    rows = docs.select(column(docs, id_col, "long").alias("id"), F.coalesce(column(docs, text_col, "string"), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(known), "id")  # at most ``examples`` rows
    rows = stage(rows.groupBy("id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")), "examples")

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi in runs(batch.column(0)):
                terms, owner = text_terms(batch.column(0)[lo:hi])
                order = np.lexsort((terms, owner))
                terms, owner = terms[order], owner[order]
                new = np.ones(len(terms), bool)
                new[1:] = (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1])
                kinds, which = np.unique(terms[new], return_inverse=True)
                bad = np.bincount(which, toxic[lo:hi][owner[new]], len(kinds)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(bad), pa.array(np.bincount(which, minlength=len(kinds)))], ["term", "bad", "seen"])

    sums = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("bad")).first()
    n, p = float(sums["n"]), float(sums["bad"] or 0)
    a, b = F.col("bad").cast("double"), (F.col("seen") - F.col("bad")).cast("double")
    c, d = F.lit(p) - a, F.lit(n - p) - b
    chi = F.lit(n) * F.pow(a * d - b * c, F.lit(2)) / F.greatest((a + b) * (c + d) * (a + c) * (b + d), F.lit(1e-9))
    counted = rows.select("text", "toxic").mapInArrow(presence, "term long, bad long, seen long").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("seen").alias("seen"))
    top = counted.withColumn("chi", chi).where((F.col("chi") >= DEPENDS) & (a * F.lit(n) > F.col("seen") * F.lit(p))).orderBy(F.desc("chi"), "term").collect()  # bounded by the examples
    terms = np.array([r["term"] for r in top], np.int64).view(np.uint64)
    seen = np.array([r["seen"] for r in top], np.float64)
    held_terms = np.sort(terms)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in runs(batch.column(2)):
                found, owner = text_terms(batch.column(2)[lo:hi])
                keep = np.isin(found, held_terms)
                found, owner = found[keep], owner[keep]
                order = np.argsort(owner, kind="stable")
                ends = np.searchsorted(owner[order], np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], batch.column(1)[lo:hi], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found[order].view(np.int64)))], ["id", "toxic", "terms"]
                )

    got = rows.select("id", F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(hits, "id long, toxic int, terms array<long>").toArrow()  # at most ``examples`` rows
    ids, toxic = got["id"].to_numpy(), got["toxic"].to_numpy()
    lists = [x.values.to_numpy().view(np.uint64) for x in got["terms"]]
    order = np.argsort(ids)
    return build(ids[order], toxic[order], [lists[k] for k in order], terms, seen)


def score(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (ids of the nearest examples) of every row.

    Null, empty and term-less texts get the share of toxic examples among term-less texts and no
    evidence. Without any training label the score is 0. Repeated rows give repeated results, a
    null id counts as the empty text for its fold, an empty table gives no rows. Extra columns are
    ignored, and no column but the text goes into a score.
    """
    index = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, examples, id_col=id_col, text_col=text_col))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = index.value
        for batch in batches:
            for lo, hi in runs(batch.column(2)):
                scores, evidence = np.full(hi - lo, model.empty), [[] for _ in range(hi - lo)]
                for text, place, value in model.vectors(*text_terms(batch.column(2)[lo:hi])):
                    cosine, who = model.nearest(place, value)
                    scores[text] = model.probability(model.vote(cosine, who))
                    evidence[text] = model.ids[who[:5]].tolist()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], batch.column(1)[lo:hi], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), pa.array(evidence, pa.list_(pa.int64()))],
                    ["doc_id", "held_out", "score", "predicted", "evidence"],
                )

    ident = column(docs, id_col, "long")
    rows = docs.select(ident.alias("doc_id"), (fold(ident, 5) == 0).alias("held_out"), F.coalesce(column(docs, text_col, "string"), F.lit("")).alias("text"))
    return rows.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int, evidence array<long>")
