"""Near-duplicate texts and vectors against all pairs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tallyhouse.llm import embeddings, graphs, neardup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def components(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(3)
    edges = {
        "path": [(i, i + 1) for i in range(0, 200) if i % 50],
        "star": [(0, i) for i in range(1, 300)] + [(500, 500)],
        "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(300)],
        "none": [],
    }[shape]
    got = {r.node: r.component for r in graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    assert got == components(nodes, [e for e in edges if e[0] != e[1]])


def test_signatures_are_unbiased():
    rng, gaps, spread = np.random.default_rng(1), [], []
    for _ in range(400):
        keys = rng.integers(1, 2**60, 40).astype(np.uint64)
        a, b = rng.integers(0, 6, 40), rng.integers(0, 6, 40)
        b = np.where(rng.random(40) < rng.random(), a, b)
        on_a, on_b = a > 0, b > 0
        s = neardup.signatures(
            np.concatenate([keys[on_a], keys[on_b]]), np.repeat([0, 1], [on_a.sum(), on_b.sum()]), np.concatenate([a[on_a], b[on_b]]), 2
        )
        true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        gaps.append((s[0] == s[1]).mean() - true)
        spread.append(true * (1 - true) / neardup.SLOTS)
    assert abs(np.mean(gaps)) < 4 * math.sqrt(np.mean(spread) / 400)
    assert np.std(gaps) == pytest.approx(math.sqrt(np.mean(spread)), rel=0.15)


def shingles(text):
    words = WORD.findall(text or "")
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)] if words else [])


def expected_classes(rows):
    bags = [(d, shingles(t)) for d, t, *_ in rows if d is not None]
    edges = []
    for i, (a, x) in enumerate(bags):
        for b, y in bags[:i]:
            shared = sum((x & y).values())
            if shared and 100 * shared >= 80 * (x.total() + y.total() - shared):
                edges.append((a, b))
    return components({d for d, _ in bags}, edges)


@pytest.fixture(scope="module")
def family(prose):
    """Texts without relation, copies, a chain and a cloud of edits around a few centres, repeated words."""
    rng, rows, n = random.Random(5), [], 1000
    for seed in range(60):
        rows.append((n := n + 1, prose(seed, rng.choice([3, 4, 5, 30, 200]))))
    for centre in range(3):
        words = prose(900 + centre, 150).split()
        for _ in range(70):
            own = list(words)
            for _ in range(rng.randrange(0, 6)):
                own[rng.randrange(len(own))] = f"w{rng.randrange(10**6)}"
            rows.append((n := n + 1, " ".join(own)))
    chain = prose(950, 120).split()
    for k in range(20):
        chain = [*chain[2:], f"c{k}", f"d{k}"]
        rows.append((n := n + 1, "  ".join(chain)))
    rows += [(n + 1, "la la la la la la la la " * 9), (n + 2, "la la la la la la la la " * 10), (n + 3, "la la la la la la la la " * 20)]
    rows += [(n + 10 + k, rows[5][1] if k % 2 else rows[7][1] + "\n") for k in range(40)]
    rng.shuffle(rows)
    return rows


def test_classes_equal_all_pairs(documents, family, odd):
    rows = [*family, *odd, (11, family[0][1]), (11, family[1][1])]
    got = neardup.classes(documents(rows).repartition(5)).collect()
    expected = expected_classes(rows)
    assert Counter(r.doc_id for r in got) == Counter(d for d, *_ in rows)
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == expected
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.class_id) for r in got)
    empty = {r.doc_id for r in got if r.n_shingles == 0}
    assert empty == {1, 2, 3}


def test_one_of_each_stays(documents, family, odd):
    docs = documents([*family, *odd])
    out = neardup.keep_one(docs)
    expected = {d for d, c in expected_classes([*family, *odd]).items() if d == c}
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({None: 1, **{d: 1 for d in expected}})


def test_overlap_of_whole_texts(prose):
    import pyarrow as pa

    texts = [prose(1, 50), prose(1, 50) + " x", "a b", "a b", "", "la " * 30, "la " * 60, None]
    pairs = [(x, y) for x in texts for y in texts]
    shared, either = neardup.overlaps(pa.array([x for x, _ in pairs]), pa.array([y for _, y in pairs]))
    for (x, y), s, e in zip(pairs, shared, either):
        a, b = shingles(x), shingles(y)
        assert (s, e) == ((a & b).total(), (a | b).total())


def test_no_documents(documents):
    assert neardup.classes(documents([])).collect() == []
    assert neardup.keep_one(documents([(1, None), (2, None)])).count() == 2


# ---- vectors -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def vectors():
    rng, rows = np.random.default_rng(2), []
    for k in range(300):
        rows.append((k, rng.normal(size=32).tolist()))
    for k in range(200):  # around a few centres, from nearly equal to just out of reach
        base = np.array(rows[k % 5][1])
        rows.append((1000 + k, (base + rng.normal(size=32) * 0.6 * rng.random()).tolist()))
    rows += [(2000 + k, rows[7][1]) for k in range(30)] + [(2100, (2.5 * np.array(rows[7][1])).tolist()), (2101, [-x for x in rows[7][1]])]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 32), (3003, [None] + [1.0] * 31), (3004, [float("nan")] * 32), (3005, [float("inf")] * 32), (None, rows[7][1])]
    rows += [(4000, [1.0, 2.0]), (4001, [2.0, 4.0]), (4002, [1.0]), (4003, [3.0]), (7, rows[7][1]), (8, rows[250][1])]
    return rows


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("pack", [4096, 40])
def test_links_equal_all_pairs(spark, vectors, kind, pack, monkeypatch):
    monkeypatch.setattr(embeddings, "PACK", pack)
    df = spark.createDataFrame([(i, v, 0, "x", "x") for i, v in vectors], f"vec_id long, embedding array<{kind}>, label int, raw string, print string")
    got = embeddings.near_duplicates(df).collect()
    assert Counter(r.vec_id for r in got) == Counter(i for i, _ in vectors)
    usable = [(i, np.array(v, np.float32 if kind == "float" else np.float64).astype(np.float64)) for i, v in vectors if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    edges, links = [], Counter()
    for a, (i, x) in enumerate(usable):
        for b, (j, y) in enumerate(usable[:a]):
            if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.9:
                edges.append((i, j))
                links[a] += 1
                links[b] += 1
    expected = components({i for i, _ in vectors if i is not None}, edges)
    assert Counter((usable[k][0], links[k]) for k in range(len(usable))) + Counter((i, 0) for i, _ in vectors if not any(i == u for u, _ in usable) or i is None) == Counter((r.vec_id, r.n_links) for r in got)
    for r in got:
        assert r.component_id == expected.get(r.vec_id) and r.kept == (r.vec_id is None or r.vec_id == r.component_id)


def test_a_close_pair_is_within_a_share():
    rng = np.random.default_rng(4)
    turn = embeddings.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    for _ in range(200):
        x = rng.normal(size=64)
        y = x + rng.normal(size=64) * rng.random() * 0.5
        x, y = x / np.linalg.norm(x), y / np.linalg.norm(y)
        gap = ((x - y) @ turn) ** 2
        near = any(gap[a:b].sum() <= budget for a, b, budget in embeddings.blocks(64, 0.9))
        assert near or x @ y < 0.9


def test_components_of_any_finite_size(spark):
    """From 1e-320 to 1e300: as scaled rows by all pairs; no square overflows or vanishes."""
    rng, rows = np.random.default_rng(8), [(0, [1e200, 0.0, 1e200]), (1, [2e200, 0.0, 2e200]), (2, [1e-200, 2e-200, 0.0]), (3, [5e-324, 0.0, 5e-324]), (4, [1.7e308, 1.7e308, -1.7e308])]
    for k in range(60):
        base = rng.normal(size=3)
        rows += [(100 + 2 * k, (base * 10.0 ** rng.integers(-300, 300)).tolist()), (101 + 2 * k, ((base + 0.1 * rng.normal(size=3)) * 10.0 ** rng.integers(-300, 300)).tolist())]
    got = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    unit = [np.array(v) / np.abs(v).max() for _, v in rows]
    unit = [v / np.linalg.norm(v) for v in unit]
    near = lambda x, y: x @ y >= 0.9
    for k, (i, _) in enumerate(rows):
        assert got[i].n_links == sum(near(unit[k], unit[j]) for j in range(len(rows)) if j != k)
    assert got[1].component_id == got[3].component_id == 0


def test_no_vectors(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
