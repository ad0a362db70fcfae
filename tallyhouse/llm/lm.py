"""Language-model scores of whole texts by a log-bilinear model over word classes.

Statistics of the whole corpus: every training text's words are hashed and counted inside the
tasks, summed by Spark into one row per distinct word, and staged. Nothing of that table is
collected but its ``HEAD`` most frequent words, chosen by a histogram of counts.

Model: every word has a class. The end of a text and the most frequent words are classes of their
own; every other word of the head shares a class with words that follow the same class most tellingly, from
corpus-wide counts of (class before, word); words outside the head, unseen ones among them, are the
last class. The log-bilinear network predicts a class from the two before it: the context vectors,
each scaled by its position, are added and multiplied with the vectors of all classes. It is
trained by noise-contrastive estimation on all training texts: (context, class) pairs are counted
inside the tasks, summed by Spark and staged as one row per context of two classes, and every step
adds up the gradient over all of them in one Spark job. The classes' unigram distribution is the
noise; its expectation is exact, no noise is drawn. Afterwards batched matrix products over all pairs
of context classes give exact normalisers, so the scores are proper log-probabilities. Within its class
a word of the head has its share of the class's count; in the last class all unseen words share
one more count: P(word | last) = (c + 1) / (N_last + V_last + 1).

Scoring: frequent words are looked up in the broadcast head; only words outside it leave a text,
as (word, times) rows that meet the count table in one join and come back as one sum a text.
Words are known by a 64-bit hash of their bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.shared import column, fold, runs, ship, stage, utf8
from tallyhouse.llm.textarrays import word_hashes, word_spans

#: Most frequent words that are broadcast; 20 bytes each.
HEAD = 1 << 20
CLASSES = 512
DIMENSION = 24
#: Gradient steps of an epoch, each over all contexts.
STEPS = 8
#: Parts into which a task's gradient is cut, so that no group holds more of it than one part a task.
CUTS = 32
#: Contexts of one dense block.
_BLOCK = 512
#: Hash that stands for the end of a text.
END = np.uint64(0x5E0D5E0D5E0D5E0D)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of texts, A-Z lower-cased, one end behind each, and the tokens before each text."""
    raw, at = utf8(texts)
    raw = _LOWER[raw]
    starts, stops, words = word_spans(raw, at)
    before = words + np.arange(len(words))
    out = np.full(before[-1], END, np.uint64)
    nth = np.arange(len(starts)) + np.repeat(np.arange(len(words) - 1), np.diff(words))
    out[nth] = word_hashes(raw, starts, stops)
    return out, before


def count_words(rows: DataFrame) -> DataFrame:
    """word (hash), n of every token of the texts of ``rows`` (one text column)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            words, which = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
            return words, np.bincount(which, np.concatenate([n for _, n in held])).astype(np.int64)

        def out() -> pa.RecordBatch:
            words, n = merged()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])

        for batch in batches:
            for lo, hi in runs(batch.column(0), 8_000_000):
                words, n = np.unique(token_hashes(batch.column(0)[lo:hi])[0], return_counts=True)
                held.append((words, n))
                if sum(len(w) for w, _ in held) > 2_000_000:
                    held[:] = [merged()]
                    if len(held[0][0]) > 1_000_000:
                        yield out()
        if held:
            yield out()

    return rows.mapInArrow(counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    words: np.ndarray  # head: sorted hashes
    counts: np.ndarray
    classes: np.ndarray  # of each head word; the last class is that of all others
    total: int  # N
    distinct: int  # V
    rare: int  # N_last + V_last + 1
    first: np.ndarray  # [class before last, class]
    second: np.ndarray  # [class before, class], with the class's own weight
    normaliser: np.ndarray  # [class before last, class before]
    share: np.ndarray = field(default_factory=lambda: np.zeros(0))  # log10 of P(word | class) of each head word

    @cached_property
    def starts(self) -> np.ndarray:
        """Where in the head the hashes with given first bits begin."""
        bits = max(1, len(self.words).bit_length())
        return np.searchsorted(self.words, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash in the head, and whether it is there. Hashes spread evenly, so their first bits lead next to it."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        last = len(self.words) - 1
        at = np.minimum(self.starts[(hashes >> np.uint64(64 - (len(self.starts).bit_length() - 1))).astype(np.int64)], last)
        below = np.flatnonzero((self.words[at] < hashes) & (at < last))
        while len(below):
            at[below] += 1
            below = below[(self.words[at[below]] < hashes[below]) & (at[below] < last)]
        return at, self.words[at] == hashes

    @property
    def size(self) -> int:
        """Number of classes."""
        return len(self.first)

    def numbers(self, hashes: np.ndarray, found: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Class of each token; ``found`` is what ``look_up`` gave."""
        at, there = found or self.look_up(hashes)
        others = np.where(hashes == END, 0, self.size - 1)
        return np.where(there, self.classes[at], others) if len(self.words) else others

    def class_logs(self, classes: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Natural log-probability of each token's class in its text; classes outside a text are the end."""
        end = np.int64(0)
        one, two = np.full(len(classes), end), np.full(len(classes), end)
        one[1:], two[2:] = classes[:-1], classes[:-2]
        starts = before[:-1][np.diff(before) > 0]
        one[starts] = end
        two[starts] = end
        second = starts + 1
        two[second[second < len(two)]] = end
        return self.first[two, classes] + self.second[one, classes] - self.normaliser[two, one]


def contexts(classes: np.ndarray, before: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (class before last, class before, class) of texts as one number each, and how often; the end pads the front."""
    starts = before[:-1][np.diff(before) > 0]
    one, two = np.zeros(len(classes), np.int64), np.zeros(len(classes), np.int64)
    one[1:], two[2:] = classes[:-1], classes[:-2]
    one[starts] = two[starts] = 0
    two[starts[starts + 1 < len(two)] + 1] = 0
    return np.unique((two * size + one) * size + classes, return_counts=True)


def gradient(parameters: list[np.ndarray], noise: np.ndarray, context: np.ndarray, owner: np.ndarray, target: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Gradient of the contrastive loss over contexts; ``owner``, ``target``, ``n``: the classes counted behind each.

    ``noise`` is the expected number of noise words of each class for one token.
    """
    r, q, scale, b = parameters
    out = [np.zeros_like(x) for x in parameters]
    starts = np.searchsorted(owner, np.arange(0, len(context) + _BLOCK, _BLOCK))
    vectors, bias, noise = q.astype(np.float32), (b - np.log(noise)).astype(np.float32), noise.astype(np.float32)
    for k, lo, hi in zip(range(0, len(context), _BLOCK), starts[:-1], starts[1:]):
        c2, c1 = np.divmod(context[k : k + _BLOCK], len(b))
        seen = np.zeros((len(c2), len(b)), np.float32)
        seen[owner[lo:hi] - k, target[lo:hi]] = n[lo:hi]
        predicted = (scale[0] * r[c2] + scale[1] * r[c1]).astype(np.float32)
        # With x = exp(score) / noise: every noise word pushes down by x / (1 + x), every seen one up by 1 / (1 + x).
        push = predicted @ vectors.T
        push += bias
        np.clip(push, -60, 60, out=push)
        np.exp(push, out=push)
        down = seen.sum(1)[:, None] * noise
        down *= push
        down -= seen
        push += 1
        down /= push
        back = (down @ vectors).astype(np.float64)
        out[1] += down.T @ predicted
        out[3] += down.sum(0)
        np.add.at(out[0], c2, back * scale[0])
        np.add.at(out[0], c1, back * scale[1])
        out[2] += np.stack([(back * r[c2]).sum(0), (back * r[c1]).sum(0)])
    return out


def descend(share: np.ndarray, summed: Callable[[list[np.ndarray], np.ndarray], list[np.ndarray]], dimension: int = DIMENSION, noise: int = 8, epochs: int = 3, rate: float = 0.1, seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-bilinear parameters by noise-contrastive estimation, as tables of both positions, and the normalisers.

    ``share`` is the distribution of classes; ``summed`` gives the mean gradient over all tokens.
    """
    rng, classes = np.random.Generator(np.random.Philox(seed)), len(share)
    parameters = [rng.normal(0, 0.1, (classes, dimension)), rng.normal(0, 0.1, (classes, dimension)), np.ones((2, dimension)), np.log(share)]
    mean, square = [np.zeros_like(x) for x in parameters], [np.zeros_like(x) for x in parameters]
    for step in range(1, epochs * STEPS + 1):
        for x, m, v, g in zip(parameters, mean, square, summed(parameters, noise * share)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    r, q, scale, b = parameters
    first, second = (scale[0] * r) @ q.T, (scale[1] * r) @ q.T + b
    normaliser = np.empty((classes, classes))
    for k in range(classes):  # one product-sized block per class before last
        x = first[k][None, :] + second
        top = x.max(1)
        normaliser[k] = top + np.log(np.exp(x - top[:, None]).sum(1))
    return first, second, normaliser


def learn(streams: list[np.ndarray], classes: int, **options) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``descend`` over texts in memory, given as class numbers, each with its end (class 0)."""
    flat = np.concatenate([np.zeros(0, np.int64), *streams])
    keys, n = contexts(flat, np.cumsum([0, *map(len, streams)]), classes)
    context, owner = np.unique(keys // classes, return_inverse=True)
    share = (np.bincount(keys % classes, n, classes) + 1.0) / (len(flat) + classes)
    return descend(share, lambda p, noise: [g / max(len(flat), 1) for g in gradient(p, noise, context, owner, keys % classes, n)], **options)


def telling(rows: DataFrame, held: Broadcast) -> tuple[np.ndarray, np.ndarray]:
    """For words of the head in the last class of the model: place in the head, and the class that is before them most often beyond chance.

    Counts of (class before, word) are summed over all texts; a word's row has an entry per class at most.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, kept = held.value, []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, which = np.unique(np.concatenate([k for k, _ in kept]), return_inverse=True)
            return keys, np.bincount(which, np.concatenate([n for _, n in kept])).astype(np.int64)

        def out() -> pa.RecordBatch:
            keys, n = merged()
            kept.clear()
            return pa.RecordBatch.from_arrays([pa.array((keys // model.size).astype(np.int32)), pa.array((keys % model.size).astype(np.int32)), pa.array(n)], ["place", "before", "n"])

        for batch in batches:
            for lo, hi in runs(batch.column(0), 8_000_000):
                hashes, before = token_hashes(batch.column(0)[lo:hi])
                at, there = model.look_up(hashes)
                numbers = model.numbers(hashes, (at, there))
                one = np.zeros(len(numbers), np.int64)
                one[1:] = numbers[:-1]
                one[before[:-1][np.diff(before) > 0]] = 0
                own = there & (numbers == model.size - 1)
                kept.append(np.unique(at[own] * model.size + one[own], return_counts=True))
                if sum(len(k) for k, _ in kept) > 2_000_000:
                    kept[:] = [merged()]
                    if len(kept[0][0]) > 1_000_000:
                        yield out()
        if kept:
            yield out()

    pairs = stage(rows.mapInArrow(counted, "place int, before int, n long").groupBy("place", "before").agg(F.sum("n").alias("n")), "neighbours")
    size = held.value.size
    shares = np.ones(size)
    for row in pairs.groupBy("before").agg(F.sum("n").alias("n")).collect():
        shares[row["before"]] = row["n"]
    shares /= shares.sum()
    share = F.element_at(F.expr("array(" + ", ".join(f"{x!r}D" for x in shares.tolist()) + ")"), F.col("x.before") + 1)
    listed = pairs.groupBy("place").agg(F.sum("n").alias("total"), F.collect_list(F.struct("before", "n")).alias("seen"))
    expected = F.col("total") * share
    best = listed.select("place", "total", F.explode("seen").alias("x")).groupBy("place").agg(
        F.max_by("x.before", F.struct(((F.col("x.n") - expected) / F.sqrt(expected)).alias("excess"), (-F.col("x.before")).alias("low"))).alias("before")
    )
    got = best.toArrow()  # at most a row per word of the head
    return got["place"].to_numpy(), got["before"].to_numpy()


def count_contexts(rows: DataFrame, held: Broadcast) -> DataFrame:
    """context, seen (class, n) of the texts of ``rows`` (one text column), staged."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = held.value.size
        kept: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, which = np.unique(np.concatenate([k for k, _ in kept]), return_inverse=True)
            return keys, np.bincount(which, np.concatenate([n for _, n in kept])).astype(np.int64)

        def out() -> pa.RecordBatch:
            keys, n = merged()
            kept.clear()
            return pa.RecordBatch.from_arrays([pa.array((keys // size).astype(np.int32)), pa.array((keys % size).astype(np.int32)), pa.array(n)], ["context", "class", "n"])

        for batch in batches:
            for lo, hi in runs(batch.column(0), 8_000_000):
                hashes, before = token_hashes(batch.column(0)[lo:hi])
                kept.append(contexts(held.value.numbers(hashes), before, size))
                if sum(len(k) for k, _ in kept) > 2_000_000:
                    kept[:] = [merged()]
                    if len(kept[0][0]) > 1_000_000:
                        yield out()
        if kept:
            yield out()

    summed = rows.mapInArrow(counted, "context int, class int, n long").groupBy("context", "class").agg(F.sum("n").alias("n"))
    # A context has at most as many rows as there are classes.
    return stage(summed.groupBy("context").agg(F.collect_list(F.struct("class", "n")).alias("seen")).sortWithinPartitions("context"), "contexts")


def gradients(found: DataFrame, total: int) -> Callable[[list[np.ndarray], np.ndarray], list[np.ndarray]]:
    """The ``summed`` of ``descend`` over staged contexts."""

    def unpacked(context: pa.Array, seen: pa.Array) -> tuple[np.ndarray, ...]:
        owner = np.repeat(np.arange(len(seen)), np.diff(seen.offsets.to_numpy()))
        return context.to_numpy(), owner, *(x.to_numpy() for x in seen.flatten().flatten())

    def summed(parameters: list[np.ndarray], noise: np.ndarray) -> list[np.ndarray]:
        held = found.sparkSession.sparkContext.broadcast((parameters, noise))

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = None
            for batch in batches:
                own = gradient(*held.value, *unpacked(*batch.columns))
                sums = own if sums is None else [a + b for a, b in zip(sums, own)]
            if sums is not None:
                cut = np.array_split(np.concatenate([x.ravel() for x in sums]), CUTS)
                task = pa.array([TaskContext.get().partitionId()] * CUTS, pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(range(CUTS), pa.int32()), task, pa.array([c.tobytes() for c in cut])], ["cut", "task", "sums"])

        def added(key: tuple, table: pa.Table) -> pa.Table:
            """One part over all tasks, in the order of the tasks, so that reruns agree to the last bit."""
            rows = table.sort_by("task")["sums"].to_pylist()
            return pa.table({"cut": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([np.sum([np.frombuffer(r) for r in rows], axis=0).tobytes()])})

        parts = found.mapInArrow(partial, "cut int, task int, sums binary").groupBy("cut").applyInArrow(added, "cut int, sums binary")
        got = parts.toArrow().sort_by("cut")["sums"].to_pylist()  # the parameters once, however many tasks there are
        held.destroy()
        flat = np.concatenate([np.frombuffer(x) for x in got]) / total
        ends = np.cumsum([x.size for x in parameters])
        return [x.reshape(p.shape) for x, p in zip(np.split(flat, ends[:-1]), parameters)]

    return summed


def fit(training: DataFrame, head: int = HEAD, classes: int = CLASSES, sample: int | None = None) -> tuple[Model, DataFrame]:
    """The model and the staged counts (word, n) of ``training`` (id, text).

    A ``sample`` is for trials: the network then learns only from the texts with so many of the smallest hashes of ids.
    """
    ship(training.sparkSession)
    counts = stage(count_words(training.select("text")), "words")
    sums = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = int(sums["n"] or 0), int(sums["v"])
    # The least count whose words fit in the head, from a histogram of at most a few hundred rows.
    step = F.floor(F.log2("n") * 8)
    taken, least = 0, None
    for row in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("v"), F.min("n").alias("least")).orderBy(F.desc("step")).collect():
        if taken + row["v"] > head:
            break
        taken, least = taken + row["v"], row["least"]
    own = F.col("word") == F.lit(int(END.view(np.int64)))
    head_words = counts.where((F.col("n") >= (least if least is not None else 2**62)) | own).toArrow()  # at most ``head`` rows and the end
    words, n = head_words["word"].to_numpy().view(np.uint64), head_words["n"].to_numpy()
    order = np.argsort(words)
    words, n = words[order], n[order]
    # Classes: the end, frequent words, as many groups of other words of the head, all words outside it.
    alone = (classes - 2) // 2
    groups = classes - 2 - alone
    number = np.full(len(words), classes - 1, np.int64)
    frequent = np.lexsort((words, -n))
    frequent = frequent[words[frequent] != END][:alone]
    number[frequent] = np.arange(1, len(frequent) + 1)
    number[words == END] = 0
    rare = (total - int(n.sum())) + (distinct - len(words)) + 1
    within = np.zeros(len(words))
    context = training.sparkSession.sparkContext
    if (number == classes - 1).any():
        place, before = telling(training.select("text"), context.broadcast(Model(words, n, number.copy(), total, distinct, rare, *[np.zeros((classes, 0))] * 3)))
        number[place] = 1 + alone + np.minimum(before, alone + 1) % groups
        grouped = number > alone
        held = np.bincount(number[grouped], n[grouped], classes)
        within[grouped] = np.log10(n[grouped]) - np.log10(held[number[grouped]])
    model = Model(words, n, number, total, distinct, rare, *[np.zeros((classes, 0))] * 3, within)

    texts = training
    if sample is not None:
        draw = F.xxhash64("id", F.lit(13))
        drawn = [r[0] for r in training.select(draw.alias("draw")).orderBy("draw").limit(sample).collect()]
        texts = training.where(draw <= drawn[-1]) if drawn else training
    found = count_contexts(texts.select("text"), context.broadcast(model))
    share = np.zeros(classes)
    for row in found.select(F.inline("seen")).groupBy("class").agg(F.sum("n").alias("n")).collect():
        share[row["class"]] = row["n"]
    tokens = int(share.sum())
    share = (share + 1.0) / (tokens + classes)
    first, second, normaliser = descend(share, gradients(found, tokens)) if tokens else learn([], classes)
    return Model(words, n, number, total, distinct, rare, *(x.astype(np.float32) for x in (first, second, normaliser)), within), counts


def score(docs: DataFrame, head: int = HEAD, classes: int = CLASSES, sample: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Null and empty texts have one token, their end. Repeated rows count and are scored one by
    one. With an empty training set N and V are 0 and every token is unseen; the network is then
    at its start. An empty table gives no rows. Extra columns are ignored.
    """
    ident, text = column(docs, id_col, "long"), column(docs, text_col, "string")
    rows = docs.select(ident.alias("id"), F.coalesce(text, F.lit("")).alias("text"), (fold(ident, 7) == 2).alias("held_out"))
    model, counts = fit(rows.where(~F.col("held_out")), head, classes, sample)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, logs = held.value, np.log10(held.value.counts + 1.0)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for lo, hi in runs(batch.column(1), 4_000_000):
                hashes, before = token_hashes(batch.column(1)[lo:hi])
                at, there = model.look_up(hashes)
                numbers, log = model.numbers(hashes, (at, there)), np.where(there, logs[at], 0.0) if len(model.words) else np.zeros(len(hashes))
                own = np.where(numbers == classes - 1, -np.log10(model.rare), 0.0)
                if len(model.words):
                    own = np.where(there, model.share[at], own)
                by = model.class_logs(numbers, before).astype(np.float64) / np.log(10) + own
                owner = np.repeat(np.arange(hi - lo), np.diff(before))
                add = lambda x: pa.array(np.bincount(owner, x, hi - lo))
                # Words outside the head, as (text, word) with their number.
                out = np.flatnonzero(~there)
                order = out[np.lexsort((hashes[out], owner[out]))]
                new = np.ones(len(order), bool)
                new[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(order)))
                ends = np.searchsorted(owner[order[first]], np.arange(hi - lo + 1))
                tail = pa.StructArray.from_arrays([pa.array(hashes[order[first]].view(np.int64)), pa.array(times)], ["word", "times"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + hi - lo)), batch.column(0)[lo:hi], batch.column(2)[lo:hi], pa.array(np.diff(before)),
                        add(there).cast(pa.int64()), add(log), add(by), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tail),
                    ],
                    ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "tail"],
                )
                row += hi - lo

    kind = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, tail array<struct<word: long, times: long>>"
    parts = stage(rows.mapInArrow(scored, kind), "scored")
    tail = parts.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.times")
    met = tail.join(counts, "word").groupBy("row").agg(F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"))
    none, unseen = F.lit(0.0), float(np.log10(model.total + model.distinct + 1))
    return parts.drop("tail").join(met, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", none) - F.col("n_tokens") * F.lit(unseen)).alias("base_score"),
        (F.col("score") + F.coalesce("more", none)).alias("score"),
    )
