"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Every whole text becomes counts of its hashed 1- to 3-grams of lower-case letters, where any run
of other characters counts as one blank. A bounded sample of labelled training rows, of each language those
with the smallest hashes of their ids and texts, is turned into vectors by Spark; the model is trained on the driver
by follow-the-regularised-leader with L1 and L2 penalties, and a temperature fitted on a part
of the sample that training has not seen turns its outputs into probabilities. Scoring is a
map over all rows with the model broadcast; its size is bounded by ``buckets`` times the
languages of the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyhouse.llm.shared import column, fold, ship

BUCKETS = 1 << 14
#: Training rows in all and of one language, and languages: the most frequent ones.
SAMPLE, EACH, LANGUAGES = 6000, 750, 50
#: Shares in which a language's rows are ranked.
SHARES = 256
UNKNOWN = "und"
_PART = 1 << 20
_A, _B, _C = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Each code point's own number if it is a letter, else that of a blank."""
    table = np.full(0x110000, 32, np.uint32)
    own = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
    table[own] = own
    return table


def gram_counts(text: str, buckets: int = BUCKETS) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text; None if it has no letter."""
    points = _letters()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")]
    if not len(points) or (points == 32).all():
        return None
    blank = points == 32
    if len(points) > 1:
        points = points[np.concatenate([[True], ~(blank[1:] & blank[:-1])])]
    out = np.zeros(buckets, np.int64)
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    for k in range(0, len(points), _PART):
        for size in (1, 2, 3):
            part = points[max(0, k - size + 1) : k + _PART]
            n = len(part) - size + 1
            if n < 1:
                continue
            h = part[:n] * _A + np.uint32(size)
            for j in range(1, size):
                h = (h ^ (h >> np.uint32(15))) * _B + part[j : j + n] * _C
            h = (h ^ (h >> np.uint32(13))) * _A
            out += np.bincount(h >> shift, minlength=buckets)
    return out


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float

    def outputs(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf[at]
        return (x / max(np.sqrt(x @ x), 1e-12)) @ self.weights[at] + self.bias


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray, str]], buckets: int = BUCKETS, epochs: int = 3, rate: float = 1.0, l1: float = 0.002, l2: float = 0.0005, seed: int = 3) -> Model:
    """FTRL-proximal over sparse rows (buckets, counts, language), then the temperature on every fifth row."""
    languages = sorted({lang for _, _, lang in rows})
    seen = np.zeros(buckets)
    for at, _, _ in rows:
        seen[at] += 1
    idf = np.log((1 + len(rows)) / (1 + seen)) + 1
    one_hot = np.eye(len(languages))
    data = []
    for at, counts, lang in rows:
        x = np.log1p(counts) * idf[at]
        data.append((np.append(at, buckets), np.append(x / max(np.sqrt(x @ x), 1e-12), 1.0), one_hot[languages.index(lang)]))
    held, own = data[::5], [d for k, d in enumerate(data) if k % 5] or data
    z, n = np.zeros((buckets + 1, len(languages))), np.zeros((buckets + 1, len(languages)))

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((1.0 + np.sqrt(ni)) / rate + l2))

    order = np.random.Generator(np.random.Philox(seed))
    for _ in range(epochs):
        for k in order.permutation(len(own)):
            at, x, y = own[k]
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            g = x[:, None] * (softmax(x @ w) - y)
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / rate * w
            n[at] = ni + g * g
    w = weights(z, n)
    outputs = np.array([x @ w[at] for at, x, _ in held])
    truth = np.array([y.argmax() for _, _, y in held])
    loss = lambda t: -np.log(softmax(outputs / t)[np.arange(len(truth)), truth] + 1e-12).mean()
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 200))
    temperature = float(grid[np.argmin([loss(t) for t in grid])])
    return Model(languages, idf, w[:-1].copy(), w[-1].copy(), temperature)


def fit(docs: DataFrame, sample: int = SAMPLE, parts: int = 4, held: int = 2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """The model of a bounded sample of rows outside the held-out fold with a language; None without such rows.

    The ``LANGUAGES`` most frequent languages are learned, each from as many rows as all get of
    ``sample``, but ``EACH`` at most: those with the smallest hashes of id and text, so a rare language is learned
    like a common one, repeated rows count once and reruns agree.
    """
    ship(docs.sparkSession)
    ident, text, lang = column(docs, id_col, "long"), column(docs, text_col, "string"), column(docs, lang_col, "string")
    rows = docs.select(ident.alias("id"), text.alias("text"), lang.alias("lang")).where(fold(F.col("id"), parts) != held).where("lang is not null and text is not null")
    rows = rows.select("text", "lang", F.xxhash64("id", F.lit(11)).alias("draw"), F.xxhash64("text").alias("print"))
    common = [r["lang"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()]
    if not common:
        return None
    each = min(EACH, sample // len(common))
    nth = lambda *by: F.row_number().over(Window.partitionBy("lang", *by).orderBy("draw", "print"))
    # First within shares of a language, so that no task holds more of it than one share or what all shares leave.
    drawn = rows.where(F.col("lang").isin(common)).select("lang", "draw", "print").distinct().withColumn("share", F.pmod("draw", F.lit(SHARES)))
    for by in (["share"], []):
        drawn = drawn.withColumn("nth", nth(*by)).where(F.col("nth") <= each).drop("nth")
    drawn = drawn.drop("share")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, prints, at, counts, langs = [], [], [], [], []
            for value, lang, draw, print_ in zip(*batch.columns):
                found = gram_counts(value.as_py())
                if found is not None:
                    own = np.flatnonzero(found)
                    ids.append(draw.as_py())
                    prints.append(print_.as_py())
                    at.append(own.astype(np.int32))
                    counts.append(found[own].astype(np.int32))
                    langs.append(lang.as_py())
            lists = [pa.array(x, pa.list_(pa.int32())) for x in (at, counts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(prints, pa.int64()), *lists, pa.array(langs, pa.string())], ["draw", "print", "at", "counts", "lang"])

    same = ["lang", "draw", "print"]
    chosen = rows.join(F.broadcast(drawn), same, "left_semi")  # at most ``sample`` rows, and what repeats them
    chosen = chosen.groupBy(*same).agg(F.min("text").alias("text")).select("text", "lang", "draw", "print")
    got = chosen.mapInArrow(vectors, "draw long, print long, at array<int>, counts array<int>, lang string").toArrow()
    data = sorted(zip(*(got[c].to_pylist() for c in ("draw", "lang", "print")), (x.values.to_numpy() for x in got["at"]), (x.values.to_numpy() for x in got["counts"])), key=lambda r: r[:3])
    return train([(at, counts, lang) for _, lang, _, at, counts in data]) if data else None


def best(model: Model | None, text: str | None) -> tuple[str, float]:
    """The likeliest language of a whole text and its calibrated probability."""
    counts = gram_counts(text) if text and model is not None else None
    if counts is None:
        return UNKNOWN, 0.0
    at = np.flatnonzero(counts)
    p = softmax(model.outputs(at, counts[at]) / model.temperature)
    return model.languages[int(p.argmax())], float(p.max())


def identify(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score (calibrated probability of lang_pred) of every row.

    Null, empty and letterless texts give ``und`` with score 0, as does every text when no row has a
    language to learn from. Repeated rows give repeated results, a null id counts as the empty text
    for its fold, ties go to the language first by code point, an empty table gives no rows.
    """
    model = fit(docs, sample, id_col=id_col, text_col=text_col, lang_col=lang_col)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [best(held.value, text.as_py()) for text in batch.column(2)]
            named = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *named], ["doc_id", "held_out", "lang_pred", "score"])

    ident, text = column(docs, id_col, "long"), column(docs, text_col, "string")
    rows = docs.select(ident.alias("doc_id"), (fold(ident, 4) == 2).alias("held_out"), text.alias("text"))
    return rows.mapInArrow(predicted, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, least: float = 0.4, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows whose language is known with a score of at least ``least``, with the same columns."""
    model = fit(docs, sample, id_col=id_col, text_col=text_col, lang_col=lang_col)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        return pd.Series([(b := best(held.value, text))[0] != UNKNOWN and b[1] >= least for text in texts], dtype=bool)

    return docs.where(known(column(docs, text_col, "string")))
