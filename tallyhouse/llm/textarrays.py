"""Words of whole texts as numpy arrays: spans and 64-bit hashes, a batch at a time.

The hash of a word is a polynomial over a table of random byte values, taken from prefix
sums, so the cost is a few array passes per byte and no Python call per word.
"""

from __future__ import annotations

import numpy as np

from tallyhouse.llm.shared import utf8

_SEED = np.random.Generator(np.random.Philox(20240229))
_BYTE = _SEED.integers(1, 2**63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 2**64)
_STEP = 1 << 20
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every bit of a 64-bit number over all others."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, _STEP + 1), base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        _powers[base] = known
    return known


def word_spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the words before each text (one more entry for the end)."""
    solid = ~_SPACE[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    begins = at[:-1][at[:-1] < at[1:]]
    first[begins] = solid[begins]
    ends = at[1:][at[:-1] < at[1:]] - 1
    last[ends] = solid[ends]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, stops, np.searchsorted(starts, at)


def word_hashes(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        base = starts[lo]
        hi = max(lo + 1, int(np.searchsorted(stops, base + _STEP, "right")))
        part = raw[base : stops[hi - 1]]
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[part] * _power(_BASE, len(part))[: len(part)], out=sums[1:])
        a, b = starts[lo:hi] - base, stops[lo:hi] - base
        out[lo:hi] = mix((sums[b] - sums[a]) * _power(_BACK, len(part))[a] + (b - a).astype(np.uint64))
        lo = hi
    return out


def hashed_words(texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of an Arrow array of texts, and the words before each text."""
    raw, at = utf8(texts)
    starts, stops, words = word_spans(raw, at)
    return word_hashes(raw, starts, stops), words


def shingles(hashes: np.ndarray, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words, and the windows before each text.

    A text of fewer words has one window, all its words; a text without words has none.
    """
    counts = np.diff(words)
    salts = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)
    total = np.zeros(max(len(hashes) - size + 1, 0), np.uint64)
    for k in range(size):
        total += hashes[k : k + len(total)] * salts[k]
    total = mix(total)
    windows = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    before = np.concatenate([[0], np.cumsum(windows)])
    owner = np.repeat(np.arange(len(counts)), windows)
    out_at = words[:-1][owner] + (np.arange(before[-1]) - before[:-1][owner])
    out = np.zeros(before[-1], np.uint64)
    full = counts[owner] >= size
    out[full] = total[out_at[full]]
    for k in np.flatnonzero((counts > 0) & (counts < size)):
        own = hashes[words[k] : words[k + 1]]
        out[before[k]] = mix(np.array([(own * salts[: len(own)]).sum() + np.uint64(len(own))], np.uint64))[0]
    return out, before
