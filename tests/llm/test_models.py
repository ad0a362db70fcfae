"""Language, toxicity, language-model and extraction operators: held-out accuracy and plain Python."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyhouse.llm import extraction, language, lm, textarrays, toxicity
from tallyhouse.llm.shared import fold

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def part(doc_id, parts):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts


def test_fold_is_crc_of_the_text(spark):
    df = spark.createDataFrame([(i,) for i in [*range(200), None, -5, 2**40]], "doc_id long")
    for r in df.select("doc_id", fold(df.doc_id, 7).alias("f")).collect():
        assert r.f == part(r.doc_id, 7)


# ---- words as arrays ----------------------------------------------------------------


def test_words_of_odd_texts(prose, monkeypatch):
    monkeypatch.setattr(textarrays, "_STEP", 64)
    monkeypatch.setattr(textarrays, "_powers", {})
    texts = ["", None, " \t ", "a", " a b  a\n", "ü\x0bß\x0cü", prose(1, 400), "x" * 500 + " y", "\x1fa\xa0b c"]
    hashes, words = textarrays.hashed_words(pa.array(texts))
    found = [WORD.findall(t or "") for t in texts]
    assert np.diff(words).tolist() == [len(f) for f in found]
    by = {}
    for word, h in zip([w for f in found for w in f], hashes.tolist()):
        assert by.setdefault(word, h) == h
    assert len(set(by.values())) == len(by)
    keys, before = textarrays.shingles(hashes, words, 3)
    grams = [[tuple(f[i : i + 3]) for i in range(len(f) - 2)] or ([tuple(f)] if f else []) for f in found]
    assert np.diff(before).tolist() == [len(g) for g in grams]
    by = {}
    for gram, h in zip([g for own in grams for g in own], keys.tolist()):
        assert by.setdefault(gram, h) == h
    assert len(set(by.values())) == len(by)


# ---- language -----------------------------------------------------------------------

TONGUES = {"aa": "ba ke lu".split(), "bb": "öst räk ungt".split(), "cc": "qui xo zé".split()}


def spoken(tongue, seed, n=40):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(TONGUES[tongue]) for _ in range(rng.randint(1, 3))) for _ in range(n)).capitalize()


def test_language_of_held_out_texts(documents, odd):
    rows = [(100 + i, spoken(t, i), t if i % 17 else None, None) for i, t in enumerate(list(TONGUES) * 80)]
    got = language.identify(documents([*odd, *rows]), sample=200).collect()
    truth = {100 + i: t for i, t in enumerate(list(TONGUES) * 80)}
    own = [r for r in got if r.doc_id in truth]
    assert len(got) == len(odd) + len(rows) and all(r.held_out == (part(r.doc_id, 4) == 2) for r in got)
    assert sum(r.held_out for r in own) > 30 and all(r.lang_pred == truth[r.doc_id] for r in own)
    assert all(r.score > 0.9 for r in own)
    for r in got:
        if r.doc_id in (1, 2, 3, 9):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in {*TONGUES, "en", "es"} and 0 < r.score <= 1
    kept = language.keep_known(documents([*odd, *rows]), sample=200)
    assert {1, 2, 3, 9}.isdisjoint(r.doc_id for r in kept.collect()) and set(truth) <= {r.doc_id for r in kept.collect()}


def test_a_rare_language_is_learnt(documents):
    """One row in two hundred, and an id that is repeated more often than the sample is large."""
    rows = [(i, spoken("aa", i), "aa") for i in range(1600)] + [(5000 + i, spoken("bb", i), "bb") for i in range(12)] + [(7, spoken("aa", 7), "aa")] * 300
    got = {r.doc_id: r.lang_pred for r in language.identify(documents(rows), sample=60).collect()}
    assert all(got[5000 + i] == "bb" for i in range(12)) and all(got[i] == "aa" for i in range(1600))


def test_long_texts_count_in_parts(monkeypatch):
    text = spoken("aa", 1, 500) + "..." + spoken("cc", 2, 300)
    whole = language.gram_counts(text)
    monkeypatch.setattr(language, "_PART", 37)
    assert (language.gram_counts(text) == whole).all()
    assert language.gram_counts("") is None and language.gram_counts("1 2 ?") is None
    assert language.gram_counts("a").sum() == 1


def test_language_without_labels(documents):
    got = language.identify(documents([(1, "abc", None), (2, None, None)])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2
    assert language.identify(documents([])).collect() == []


# ---- toxicity ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def judged(prose):
    rng, rows, labels = random.Random(8), [], []
    for i in range(900):
        words = prose(i, 60).split()
        bad = i % 9 == 0
        if bad:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(["Zonk!", "blarg,", "wuffel" + rng.choice("aeiou") * 2])
        rows.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, 1, int(bad)))
        elif bad:
            labels.append((i, 0, 1))
    return rows, labels


def test_toxic_texts_are_told(documents, spark, judged, odd):
    rows, labels = judged
    labels = spark.createDataFrame([*labels, (None, 1, 1), (10**6, 1, 1), (4, 1, None)], "doc_id long, quality int, toxic int")
    odd = [(None if d is None else d + 5000, *r) for d, *r in odd]
    got = toxicity.score(documents([*rows, *odd]), labels).collect()
    assert len(got) == len(rows) + len(odd)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == (part(r.doc_id, 5) == 0)
        if r.doc_id is not None and r.doc_id < 900:
            assert r.predicted == int(r.doc_id % 9 == 0)
        else:
            assert r.predicted == 0
        assert all(part(e, 5) for e in r.evidence)


def test_neighbours_equal_a_full_scan(judged):
    rng = np.random.default_rng(3)
    n, m = 700, 40
    terms = np.sort(rng.integers(1, 2**62, m).astype(np.uint64))
    lists = [rng.choice(terms, rng.integers(0, 8)) for _ in range(n)]
    index = toxicity.build(np.arange(n), rng.integers(0, 2, n), lists, terms, np.array([sum(t in x for x in lists) for t in terms], float))
    dense = index.weights.reshape(-1, m)
    for _, place, value in list(index.vectors(np.concatenate(lists), np.repeat(np.arange(n), [len(x) for x in lists])))[:150]:
        query = np.zeros(m)
        query[place] = value
        cosine, who = index.nearest(place, value, k=10)
        full = dense @ query
        order = np.lexsort((np.arange(len(full)), -full))[:10]
        assert np.allclose(cosine, full[order][: len(cosine)]) and (full[order] > 0).sum() == len(cosine)
        without = index.nearest(place, value, k=10, without=int(who[0]))[1]
        assert who[0] not in without


def test_every_telling_term_is_kept(documents, spark, prose):
    ids = [i for i in range(1500) if part(i, 5)][:1000]
    words = [f"zq{k:03d}" for k in range(320)]
    rows = [(d, prose(d, 12) + " " + " ".join(words[(i // 10 * 20 + j) % 320] for j in range(20)) if i % 10 == 0 else prose(d, 30)) for i, d in enumerate(ids)]
    labels = spark.createDataFrame([(d, 1, int(i % 10 == 0)) for i, d in enumerate(ids)], "doc_id long, quality int, toxic int")
    index = toxicity.fit(documents(rows), labels)
    hashes = toxicity.text_terms(pa.array([" ".join(words)]))[0]
    assert np.isin(hashes[: len(words)], index.terms).all()


def test_isotonic_is_monotone():
    x, y = isotonic = toxicity.isotonic(np.array([0.1, 0.2, 0.3, 0.3, 0.8, 0.9]), np.array([0, 1, 0, 0, 1, 1.0]))
    assert (np.diff(x) > 0).all() and (np.diff(y) >= 0).all() and len(isotonic) == 2


def test_toxicity_without_labels(documents, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in toxicity.score(documents([(1, "a"), (2, None)]), labels).collect()] == [0.0, 0.0]
    assert toxicity.score(documents([]), labels).collect() == []


# ---- language model ------------------------------------------------------------------


@pytest.mark.parametrize("head", [1 << 20, 40])
def test_base_scores_by_hand(documents, odd, head):
    rows = [*odd, *[(100 + i, spoken(t, i, 30)) for i, t in enumerate(list(TONGUES) * 40)]]
    got = lm.score(documents(rows), head=head, classes=32, sample=60).collect()
    tokens = {d: [*WORD.findall((t or "").translate(LOWER)), ""] for d, t, *_ in rows}
    counts = Counter(w for d, t, *_ in rows if part(d, 7) != 2 for w in tokens[d])
    total, distinct = counts.total(), len(counts)
    assert len(got) == len(rows)
    for r in got:
        own = tokens[r.doc_id]
        base = sum(math.log10((counts[w] + 1) / (total + 1 * (distinct + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (part(r.doc_id, 7) == 2, len(own), sum(w in counts for w in own), total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    held = [r for r in got if r.held_out and r.doc_id and r.doc_id >= 100]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(6)
    streams = [np.append(rng.integers(1, 12, 50), 0) for _ in range(30)]
    first, second, normaliser = lm.learn(streams, 12)
    logs = first[:, None, :] + second[None, :, :] - normaliser[:, :, None]
    assert np.allclose(np.exp(logs).sum(2), 1)
    model = lm.Model(*[np.zeros(0)] * 3, 0, 0, 1, first, second, normaliser)
    texts = [[3, 4, 0], [0], [5, 0]]
    flat, before = np.concatenate(texts).astype(int), np.array([0, 3, 4, 6])
    expected = [logs[0, 0, 3], logs[0, 3, 4], logs[3, 4, 0], logs[0, 0, 0], logs[0, 0, 5], logs[0, 5, 0]]
    assert np.allclose(model.class_logs(flat, before), expected)


def test_learning_finds_a_pattern():
    streams = [np.array([1, 2, 3] * 20 + [0]) for _ in range(40)]
    first, second, normaliser = lm.learn(streams, 5, epochs=6)
    logs = first[1] + second[2] - normaliser[1, 2]
    assert np.exp(logs[3]) > 0.9


def test_every_training_text_is_learnt_from(documents, spark):
    ids = [i for i in range(1800) if part(i, 7) != 2]
    drawn = {r.id: r.draw for r in spark.createDataFrame([(i,) for i in ids], "id long").selectExpr("id", "xxhash64(id, 13) draw").collect()}
    late = set(sorted(ids, key=drawn.get)[1200:])
    assert len(late) > 300
    rows = [(i, "la li lu " * 4 if i in late else "lu li la " * 4) for i in ids]
    model, _ = lm.fit(documents(rows).selectExpr("doc_id id", "text"), classes=6)
    la, li, lu = model.classes[model.look_up(lm.token_hashes(pa.array(["la li lu"]))[0])[0]][:3]
    after = np.exp(model.first[la] + model.second[li] - model.normaliser[la, li])
    assert after[lu] > 0.8


@pytest.mark.parametrize("head", [1 << 20, 20])
def test_scores_by_hand(documents, head):
    """Token by token: the class given the two classes before, then the word given its class."""
    words = [f"w{k}" for k in range(40)]
    rng = random.Random(1)
    texts = [" ".join(w for _ in range(12) for w in (rng.choice(words[:6]), rng.choice(words[6 + 2 * (i % 3) :: 6]))) for i in range(200)]
    rows = [*enumerate(texts), (500, "w1 new W2 NEW"), (501, ""), (502, None)]
    training = documents([r for r in rows if part(r[0], 7) != 2]).selectExpr("doc_id id", "coalesce(text, '') text")
    model, _ = lm.fit(training, head, 10)
    counts = Counter(w for i, t in rows if part(i, 7) != 2 for w in [*WORD.findall((t or "").translate(LOWER)), ""])
    known = lm.token_hashes(pa.array([" ".join(w for w in counts if w)]))[0]
    name = dict(zip([*(w for w in counts if w), ""], known))
    place = {w: int(model.look_up(np.array([h]))[0][0]) for w, h in name.items() if model.look_up(np.array([h]))[1][0]}
    last, tail = 9, [w for w in counts if w not in place]
    assert place and (head > 100) == (not tail)
    shares = Counter()
    for w in place:
        shares[int(model.classes[place[w]])] += 10 ** model.share[place[w]]
    assert all(v == pytest.approx(1) for v in shares.values()) and len(shares) > 6

    def by_hand(text):
        total, two, one = 0.0, 0, 0
        for w in [*WORD.findall((text or "").translate(LOWER)), ""]:
            c = int(model.classes[place[w]]) if w in place else last
            total += (model.first[two, c] + model.second[one, c] - model.normaliser[two, one]) / math.log(10)
            total += model.share[place[w]] if w in place else math.log10((counts[w] + 1) / (sum(counts[t] for t in tail) + len(tail) + 1))
            two, one = one, c
        return total

    got = {r.doc_id: r.score for r in lm.score(documents(rows), head, 10).collect()}
    assert all(got[i] == pytest.approx(by_hand(t), rel=1e-4) for i, t in rows)


def test_words_are_grouped_by_what_is_before_them(documents):
    rows = [(i, " ".join(f"left a{(i * 7 + k) % 30} right b{(i * 5 + k) % 30}" for k in range(10))) for i in range(150)]
    model, _ = lm.fit(documents(rows).selectExpr("doc_id id", "text"), classes=6)
    of = lambda w: int(model.classes[model.look_up(lm.token_hashes(pa.array([w]))[0])[0][0]])
    assert len({of(f"a{k}") for k in range(30)}) == len({of(f"b{k}") for k in range(30)}) == 1 and of("a1") != of("b1")
    assert {of("left"), of("right")} == {1, 2}


def test_no_texts_to_learn_from(documents):
    only = [i for i in range(60) if part(i, 7) == 2][:3]
    got = lm.score(documents([(i, "a b") for i in only]), classes=8).collect()
    assert len(got) == 3 and all((r.train_tokens, r.n_known, r.base_score) == (0, 0, 0.0) for r in got)
    assert lm.score(documents([]), classes=8).collect() == []


# ---- extraction ----------------------------------------------------------------------


def texts_of(page):
    return [b.text for b in extraction.parse(page)]


def test_blocks_of_broken_markup():
    assert texts_of("") == [] and texts_of("<p></p><br>") == []
    assert texts_of("a &amp; b&copy <b>c</b>d<p>e<p>f &lt;g&gt;") == ["a & b© cd", "e", "f <g>"]
    assert texts_of("<script>var a='<p>no';</script><style>x</style>yes<!-- <p>no --><script>no") == ["yes"]
    assert texts_of("<P CLASS=x>one\n\t two&nbsp;three</P>4 < 5 <div title='a>b'>six<div") == ["one two three", "4 < 5", "six"]
    assert texts_of("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    blocks = extraction.parse("<article><p>x<p>y</article><footer>z</footer>")
    assert [b.path for b in blocks] == [("article", "p"), ("article", "p"), ("footer",)]
    linked = extraction.parse("<p>ab<a href=x>cd</a></p>")[0]
    assert (linked.text, linked.linked) == ("abcd", 2)


def test_drawings_and_formulas():
    assert texts_of("<p>one</p><svg viewBox='0'/><p>two</p><p>three</p>") == ["one", "two", "three"]
    assert texts_of("<p>a<svg><text>no</text></svg>b</p><svg><p>c</p>") == ["ab", "c"]
    assert texts_of("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p><math/><p>d</p>") == ["so x=2 holds", "d"]
    assert texts_of("<template><p>no</p></template><p>yes</p>") == ["yes"]


def test_a_very_long_page_among_short_ones():
    """Memory grows with the blocks that are there, not with padding or kept states."""
    import tracemalloc

    long = [extraction.parse("<article>" + "<p>some words here.</p>" * 20_000 + "</article>")]
    short = [extraction.parse("<nav>a</nav><article><p>b c d.</p></article>")] * 63
    pages, network = extraction.featured(short + long), extraction.Network()
    alone = network.label(pages[:1])[0]
    tracemalloc.start()
    got = network.label(pages)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got[-1]) == 20_000 and (got[0] == alone).all() and most < 200e6


def test_gradients_are_right(prose):
    rng = np.random.default_rng(0)
    blocks = [extraction.parse(extraction.compose(rng, [prose(i, 12) for i in range(30)])) for _ in range(4)]
    pages = extraction.featured(blocks)
    for page, own in zip(pages, blocks):
        page.labels = np.array([extraction._MARK in b.text for b in own], float)
        page.counted = np.ones(len(own))
    network = extraction.Network()
    _, gradient = network.gradients(pages)
    for name, value in network.p.items():
        flat, k, step = value.reshape(-1), int(np.argmax(np.abs(gradient[name]))), 1e-5
        flat[k] += step
        up = network.gradients(pages)[0]
        flat[k] -= 2 * step
        down = network.gradients(pages)[0]
        flat[k] += step
        assert gradient[name].reshape(-1)[k] == pytest.approx((up - down) / (2 * step), rel=1e-4)


@pytest.fixture(scope="module")
def pages(spark, prose):
    def page(i):
        body = "".join(f"<p>{prose(10 * i + k, 25)}.</p>" for k in range(3))
        return f'<html><head><title>t</title></head><body><nav><ul><li><a href="/">{prose(i, 2)}</a></li></ul></nav><div class="ad">{prose(i + 1, 8)}</div><article><h1>{prose(i, 6)}</h1>{body}</article><footer>&copy; {prose(i, 5)}</footer></body></html>'

    rows = [(i, f"u{i}", page(i), "x") for i in range(60)] + [(100, None, None, "x"), (101, "u", "", None), (None, "v", "<nav>a</nav>", "x"), (5, "u5", page(5), "x"), (102, "w", page(7) * 20, "x")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string")


def test_articles_are_extracted(pages):
    got = extraction.extract(pages, sample=40).collect()
    truth = Counter()
    for r in pages.collect():
        blocks = extraction.parse(r.html or "")
        text = "\n".join(b.text for b in blocks if "article" in b.path)
        truth[(r.page_id, r.url, text, len(text))] += 1
    found = Counter(map(tuple, got))
    assert sum((found & truth).values()) >= truth.total() - 1
    assert {(100, None, "", 0), (101, "u", "", 0)} <= set(found)


def test_unseen_composed_pages():
    rng = np.random.default_rng(77)
    said = [" ".join(f"w{rng.integers(500)}" for _ in range(15)) for _ in range(200)]
    network = extraction.Network()

    def made(n):
        blocks = [extraction.parse(extraction.compose(rng, said)) for _ in range(n)]
        labels = [[extraction._MARK in b.text for b in own] for own in blocks]
        for own in blocks:
            for b in own:
                b.text = b.text.replace(extraction._MARK, "").strip() or "x"
        out = extraction.featured(blocks)
        for page, own in zip(out, labels):
            page.labels, page.counted = np.array(own, float), np.ones(len(own))
        return out

    network.train(made(600), epochs=6)
    test = made(150)
    assert np.mean(np.concatenate([p.labels == got for p, got in zip(test, network.label(test))])) > 0.97


def test_no_pages(spark):
    assert extraction.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
