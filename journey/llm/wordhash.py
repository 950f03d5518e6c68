"""64-bit word hashes of a text, computed for all words at once with numpy.

A word's hash is a polynomial in a fixed odd base over a fixed byte table,
taken from prefix sums modulo 2**64 and shifted back to power zero, then
mixed.  It depends on the word's bytes only, so it is the same in every
process and at every place in a text.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: bytes of a text that are hashed at once; longer texts go piece by piece, cut between words
_PIECE = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer (wraps around by design)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def reach(cls, n: int) -> None:
        if len(cls.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                a = np.full(size, base, np.uint64)
                a[0] = 1
                setattr(cls, name, np.cumprod(a, dtype=np.uint64))


def word_hashes(data: bytes, is_word: np.ndarray) -> np.ndarray:
    """Hashes of the runs of bytes ``b`` with ``is_word[b]``, in order."""
    raw = np.frombuffer(data, np.uint8)
    if len(raw) <= _PIECE:
        return _hash_piece(raw, is_word)
    out, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + _PIECE)
        while end < len(raw) and is_word[raw[end]] and is_word[raw[end - 1]]:
            end += 1
        out.append(_hash_piece(raw[at:end], is_word))
        at = end
    return np.concatenate(out)


def _hash_piece(raw: np.ndarray, is_word: np.ndarray) -> np.ndarray:
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = is_word[raw]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    _Powers.reach(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * _Powers.up[:len(raw)], dtype=np.uint64, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _Powers.down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive words, order kept; shorter inputs give none."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, k, np.uint64)
    for i in range(k):
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + words[i:i + n])
    return h
