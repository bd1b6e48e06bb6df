"""Word-shingle sets of whole Arrow batches, in numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case.  A word's 64-bit hash is a
polynomial over random values of its bytes; a shingle's mixes the hashes of its words in
order.  A document's set is its distinct shingle hashes in ascending order, which
is a random order of the shingles and the same for all documents.  Two different shingles of the
documents that are compared share a hash with probability below ``n**2 / 2**64``
for sets of ``n`` shingles.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
_SEED = np.random.default_rng(0x5EED)
_BYTE = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_BASE = 0xD1342543DE82EF95  # odd: it has an inverse modulo 2**64
_PLACE = _SEED.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}
_PIECE = 1 << 18  # bytes handled at once: their tables take about 60 times that


def mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and its inverse modulo 2**64 for i < n."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, _PIECE + 1)
        for name, b in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of one run of bytes."""
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    up, down = _powers(len(data) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[:-1], dtype=np.uint64)))
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)), start


def _shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words; fewer words are one run."""
    k = min(k, len(words))
    if not k:
        return words
    n = len(words) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = mix(out + words[i : i + n] * _PLACE[i])
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = WORDS):
    """``(index, sorted distinct shingle hashes)`` of each text with words, in
    pieces of about ``_PIECE`` bytes; a longer text is one piece."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _PIECE, "right")) - 1)
        a, b = int(offsets[i]), int(offsets[j])
        own = np.asarray(offsets[i : j + 1]) - a
        # a space between texts keeps their words apart
        piece = np.insert(data[a:b], own[1:-1], 32) if j > i + 1 else data[a:b]
        starts = own + np.arange(j - i + 1)
        hashes, at = word_hashes(piece)
        cut = np.searchsorted(at, starts)
        count = np.diff(cut)
        if len(hashes) >= k:
            every = _shingles(hashes, k)
            for t in np.flatnonzero(count):
                x = every[cut[t] : cut[t + 1] - k + 1] if count[t] >= k else _shingles(hashes[cut[t] : cut[t + 1]], k)
                yield i + int(t), np.unique(x)
        else:
            for t in np.flatnonzero(count):
                yield i + int(t), np.unique(_shingles(hashes[cut[t] : cut[t + 1]], k))
        i = j
