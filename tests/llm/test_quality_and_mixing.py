"""Quality rules and mixing against plain Python."""

import math
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import mixing, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def features(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


@pytest.fixture(scope="module")
def texts(prose):
    made = [prose(i, 60 + i % 40) for i in range(400)]
    made += [" | ".join(prose(1000 + i, 80).split()) for i in range(60)]
    made += [prose(2000 + i, 30) + "\n" + "\n".join([prose(i, 8)] * 4) for i in range(10)]
    return made + ["a b c a b c\x0ba b c", "x\ny\nx\n\n \nx", "** $a$ 漢字|漢字  "]


def test_features_by_hand(documents, spark, texts, odd):
    rows = [*odd, *[(100 + i, t) for i, t in enumerate(texts)]]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.quality_rules(documents(rows), labels).collect()
    expected = Counter((d, *features(t)) for d, t, *_ in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == expected
    for r in got:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed) and r.cutoff is None


def tail(n, k, p):
    p = Fraction(p).limit_denominator()
    return float(sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))


def test_binomial_tail_is_exact(spark):
    cases = [(n, k) for n in (0, 1, 50, 400, 1000) for k in (0, 1, 3, 9) if k <= n]
    df = spark.createDataFrame(cases, "n long, k long")
    for p in (0.01, 0.1):
        for r in df.withColumn("t", quality.binomial_tail(F.col("n"), F.col("k"), p)).collect():
            expected = 1.0 if r.k > r.n * p else tail(r.n, r.k, p)
            assert r.t == pytest.approx(expected, rel=1e-9)


def test_cutoffs_are_certified_per_stratum(spark):
    scored, labels = [], []
    for stratum, base, good, bad in (("+a", 0, 2000, 50), ("+b", 10_000, 30, 30), ("-", 20_000, 2000, 50)):
        for i in range(good + bad):
            severity = (i % 400 == 0) * 12 if i < good else 15
            if stratum == "-":
                severity = i % 20 if i < good else 15
            scored.append((base + i, stratum, severity))
            labels.append((base + i, int(i < good), 0))
    scored = spark.createDataFrame(scored, "doc_id long, stratum string, severity int")
    labels = spark.createDataFrame([*labels, (0, None, 1), (1, 7, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.stratum: r.cutoff for r in quality.cutoffs(scored, labels, alpha=0.01, delta=0.05).collect()}
    # Enough good documents in "+a"; too few in "+b"; in "-" every cutoff would reject too many.
    assert got == {"+a": 15}
    assert tail(2000, 0, 0.01) * 3 <= 0.05 < tail(30, 0, 0.01) * 3


def test_repeated_labels_certify_nothing(spark):
    """Trials are distinct documents: repeating rows or labels changes no cutoff, and the worst of an id counts."""
    rows = [(i, "+a", 0) for i in range(300)] + [(1000 + i, "+a", 15) for i in range(30)]
    labels = [(i, int(i < 1000)) for i, _, _ in rows]
    made = lambda scored, known: {r.stratum: r.cutoff for r in quality.cutoffs(spark.createDataFrame(scored, "doc_id long, stratum string, severity int"), spark.createDataFrame(known, "doc_id long, quality int")).collect()}
    few = [r for r in rows if r[0] < 200 or r[0] >= 1000]
    assert made(rows, labels) == {"+a": 15} and made(few, labels) == {}
    assert made(few * 3, labels * 40) == {}
    assert made(rows + [(0, "+a", 15)] * 50, labels) == made(rows[1:] + [(0, "+a", 15)], labels) == {}
    assert made(rows, labels + [(i, 0) for i in range(10)]) == {}


def test_junk_goes_and_prose_stays(documents, spark, texts):
    rows = [(i, t) for i, t in enumerate(t for t in texts for _ in range(3))]
    labels = spark.createDataFrame([(i, int(" | " not in t), 0) for i, t in rows], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality.keep_good(documents(rows), labels, alpha=0.02).collect()}
    assert not [i for i, t in rows if " | " in t and i in kept]
    assert sum(" | " not in t and features(t)[0] >= 50 and i not in kept for i, t in rows) <= 30
    assert quality.keep_good(documents(rows), labels).columns == documents([]).columns


def water(sizes, weights, total, most):
    """Targets by repeated resharing of the excess."""
    wanted, capped = total * sum(sizes.values()), {}
    while True:
        left = {s: w for s, w in weights.items() if s not in capped}
        if not left:
            return capped
        rest = wanted - sum(capped.values())
        share = {s: rest * w / sum(left.values()) for s, w in left.items()}
        over = {s: most * sizes[s] for s in left if share[s] > most * sizes[s]}
        if not over:
            return capped | share
        capped |= over


def test_targets_and_limits(documents, prose, odd):
    rows = [*odd, *[(100 + i, prose(i, 20 + i % 60), "en", ["a", "b", None, "big", "é", "Z"][min(i % 9, 5)]) for i in range(500)]]
    got = mixing.mix(documents(rows)).collect()
    again = mixing.mix(documents(rows[::-1]).repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, features(t)[0]) for d, t, *_ in rows)
    source = lambda r: r[3] if len(r) > 3 else "web"
    sizes = Counter()
    for r in rows:
        sizes[source(r)] += features(r[1])[0]
    for r in rows:
        sizes[source(r)] += 0
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    expected = water(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, 1.5, 2)
    sized = {sizes[s]: expected[s] for s in names}
    assert {r.source_size for r in got} == set(sized)
    for r in got:
        assert r.target == pytest.approx(sized[r.source_size], rel=1e-9) and r.taken <= 2 * r.size and r.taken == r.copies * r.size
    for size, target in sized.items():
        taken = sum(r.taken for r in got if r.source_size == size)
        largest = max((r.size for r in got if r.source_size == size), default=0)
        assert abs(taken - target) <= max(80, largest if size < 10 * largest else 0)


def test_low_weights_are_taken_less(documents, prose):
    rows = [(i, prose(i, 40) if i % 2 else " | ".join(prose(i, 20).split()), "en", "s") for i in range(2000)]
    rows += [(10_000 + i, prose(i, 40), "en", "t") for i in range(2000)]
    got = {r.doc_id: r.copies for r in mixing.mix(documents(rows), weights=(1, 3), total=0.8).collect()}
    plain, marked = (sum(got[i] for i in range(k, 2000, 2)) for k in (1, 0))
    assert plain > 1.2 * marked > 0


def test_resample_repeats_rows(documents, odd, prose):
    docs = documents([*odd, *[(100 + i, prose(i, 50), "en", "abc"[i % 3]) for i in range(60)]])
    out = mixing.resample(docs)
    assert out.columns == docs.columns
    copies = Counter()
    for r in mixing.mix(docs).collect():
        copies[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in out.collect()) == +copies


def test_empty_tables(documents, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.quality_rules(documents([]), labels).collect() == []
    assert mixing.mix(documents([])).collect() == []
    assert mixing.resample(documents([])).collect() == []
