import random
"""Token counts and packing against the library and exhaustive search."""

import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from hypothesis import given, settings, strategies as st

from tallyhouse.llm import packing, tokens
from tallyhouse.llm.queries import vocabulary


def test_whole_tokens_are_single(path):
    proved = tokens.prove_whole_tokens(path)
    library = tokens.load(path)
    assert len(proved) > 45_000
    sample = sorted(proved)[::97]
    assert all(len(e.ids) == 1 for e in library.encode_batch(sample, add_special_tokens=False))


def test_counts_match_the_library(documents, odd, path):
    got = tokens.count_tokens(documents(odd), path, limit=100).collect()
    expected = Counter()
    for doc_id, text, *_ in odd:
        n = len(tokens.load(path).encode(text or "", add_special_tokens=False).ids)
        expected[(doc_id, len((text or "").encode()), n, n > 100)] += 1
    assert Counter(tuple(r) for r in got) == expected


WHOLE = tokens.prove_whole_tokens(vocabulary())


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_fast_ids_equal_the_library(text):
    path = vocabulary()
    expected = tokens.load(path).encode(text, add_special_tokens=False).ids
    assert packing.fast_encoder(path)(text).tolist() == expected
    merger = tokens.Merger(path, WHOLE)
    parts = text.split("<|endoftext|>")
    assert sum(merger.count(regex.findall(tokens.PATTERN, p)) for p in parts) + len(parts) - 1 == len(expected)


def fewest(items, limit):
    """Bins of an optimal packing, by trying every placement."""
    best = [len(items)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for room in set(b for b in bins if b + items[k] <= limit):
            i = bins.index(room)
            place(k + 1, [*bins[:i], room + items[k], *bins[i + 1 :]])
        place(k + 1, [*bins, items[k]])

    items = sorted(items, reverse=True)
    place(0, [])
    return best[0]


@settings(max_examples=120, deadline=None)
@given(st.integers(5, 40).flatmap(lambda limit: st.tuples(st.just(limit), st.lists(st.integers(1, limit), max_size=9))))
def test_completion_against_every_packing(case):
    limit, items = case
    counts = np.bincount(items, minlength=limit + 1) if items else np.zeros(limit + 1, np.int64)
    plan = packing.complete(counts, limit)
    used = Counter()
    for filling, times in plan:
        assert sum(filling) <= limit
        for size in filling:
            used[size] += times
    assert used == Counter(items)
    bins = sum(t for _, t in plan)
    assert packing.lower_bound(counts, limit) <= fewest(items, limit) <= bins <= sum(t for _, t in packing.best_fit(counts, limit))
    assert bins == fewest(items, limit)


def test_segments_cover_every_rank_once():
    plan = [((7, 2, 2), 3), ((5, 5), 2), ((2,), 4)]
    seen, fill = defaultdict(set), defaultdict(list)
    for size, first, ranks, uses, sequence, at in packing.segments(plan):
        for r in range(first, first + ranks):
            assert r not in seen[size]
            seen[size].add(r)
            fill[sequence + (r - first) // uses].append((at + (r - first) % uses * size, size))
    assert {s: len(v) for s, v in seen.items()} == {7: 3, 2: 10, 5: 4}
    for places in fill.values():
        assert [a for a, _ in sorted(places)] == list(itertools.accumulate([0, *[s for _, s in sorted(places)]]))[:-1]


@pytest.mark.parametrize("limit", [64, 1024])
def test_pieces_round_trip(documents, odd, path, limit):
    got = packing.pack(documents(odd), path, limit=limit, keep_ids=True).collect()
    by_place = sorted((r.sequence_id, r.offset, r.length) for r in got)
    for _, group in itertools.groupby(by_place, key=lambda r: r[0]):
        group = list(group)
        assert [o for _, o, _ in group] == list(itertools.accumulate([0, *[n for *_, n in group]]))[:-1]
        assert sum(n for *_, n in group) <= limit
    assert {s for s, *_ in by_place} == set(range(len({s for s, *_ in by_place})))
    pieces = defaultdict(list)
    for r in got:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        pieces[r.doc_id].append(r)
    for doc_id, text, *_ in odd:
        ids = [*tokens.load(path).encode(text or "", add_special_tokens=False).ids, 2]
        copies = sum(d == doc_id for d, *_ in odd)
        own = sorted(pieces[doc_id], key=lambda r: r.start)[::copies]
        assert [t for r in own for t in r.ids] == ids and len(pieces[doc_id]) == copies * len(own)
        assert [r.piece for r in own] == list(range(len(own))) and all(r.length == limit for r in own[1:])


def test_empty_tables(documents, path):
    assert tokens.count_tokens(documents([]), path).collect() == []
    assert packing.pack(documents([]), path).collect() == []


def fewest(sizes, limit):
    """Bins of a best packing, by trying every place for every piece."""
    best, bins = len(sizes), []

    def go(i):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins) if b + sizes[i] <= limit}.values():
            bins[k] += sizes[i]
            go(i + 1)
            bins[k] -= sizes[i]
        bins.append(sizes[i])
        go(i + 1)
        bins.pop()

    go(0)
    return best


def test_bin_completion_finds_the_optimum():
    rng, better = random.Random(5), 0
    for _ in range(300):
        limit = rng.choice([10, 20, 50, 100])
        sizes = sorted((rng.randint(1, limit if rng.random() < 0.5 else max(1, limit // 2)) for _ in range(rng.randint(3, 11))), reverse=True)
        counts = np.bincount(sizes, minlength=limit + 1)
        plan = packing.complete(counts, limit)
        assert (sum(n * np.bincount(f, minlength=limit + 1) for f, n in plan) == counts).all() and all(sum(f) <= limit for f, _ in plan)
        assert sum(n for _, n in plan) == fewest(sizes, limit)
        better += sum(n for _, n in packing.best_fit(counts, limit)) > fewest(sizes, limit)
    assert better


def test_every_undominated_filling_is_there():
    counts = np.bincount([90, 5, 4, 3, 2], minlength=101)
    found = [f for f, _ in packing.fillings(counts, 90, 100, 100)]
    assert found[0] == (90, 5, 3, 2) and (90, 4, 3, 2) not in found
    for seed in range(30):
        rng = random.Random(seed)
        sizes = [rng.randint(1, 20) for _ in range(7)]
        counts = np.bincount([30, *sizes], minlength=51)
        got = {tuple(f[1:]): w for f, w in packing.fillings(counts, 30, 50, 50)}
        sets = {tuple(sorted((s for k, s in enumerate(sizes) if m >> k & 1), reverse=True)) for m in range(1 << len(sizes))}
        left = {s: sizes.count(s) for s in sizes}
        fitting = {s: 20 - sum(s) for s in sets if sum(s) <= 20}
        if 20 in left:
            assert got == {(20,): 0}
        else:
            assert got == {s: w for s, w in fitting.items() if not packing.dominated(s, w, left)}
