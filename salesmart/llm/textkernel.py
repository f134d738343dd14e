"""Vectorised word and shingle hashes of one text's UTF-8 bytes (numpy, inside Spark tasks)."""

from __future__ import annotations

import numpy as np

_MASK = (1 << 64) - 1
_rng = np.random.Generator(np.random.PCG64(7))
_CODE = _rng.integers(1, _MASK, 256, dtype=np.uint64, endpoint=True)
_PLACE = _rng.integers(1, _MASK, 64, dtype=np.uint64, endpoint=True) | np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_BLOCK = 1 << 20
_powers: dict[int, np.ndarray] = {}

#: Lower case for A-Z only; every other byte is itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of a word where words are `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
#: Bytes of a word where punctuation separates too: ASCII letters, digits, and all beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n mod 2**64."""
    have = _powers.get(base)
    if have is None or have.size <= n:
        size = max(n + 1, _BLOCK + 1)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = _powers[base] = np.multiply.accumulate(have)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_sums(buf: np.ndarray, base: int = BASE, code: np.ndarray = _CODE) -> np.ndarray:
    """P with P[e] - P[s] = base**s times the polynomial hash of buf[s:e]."""
    out = np.zeros(buf.size + 1, dtype=np.uint64)
    np.cumsum(code[buf] * powers(base, buf.size)[: buf.size], out=out[1:])
    return out


def spans(buf: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the words."""
    edge = np.zeros(buf.size + 2, dtype=np.int8)
    edge[1:-1] = is_word[buf]
    step = np.diff(edge)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def hash_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, in blocks so that a very long text needs no long sums."""
    out = np.empty(starts.size, dtype=np.uint64)
    i = 0
    while i < starts.size:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _BLOCK, side="right")))
        at = starts[i]
        sums = prefix_sums(buf[at: ends[j - 1]])
        s, e = starts[i:j] - at, ends[i:j] - at
        out[i:j] = (sums[e] - sums[s]) * powers(INVERSE, int(s[-1]))[s]
        i = j
    return mix(out)


def text_words(data: bytes | None, is_word: np.ndarray = NOT_SPACE) -> np.ndarray:
    """Hashes of a text's words in order, A-Z lower-cased; empty for null."""
    if not data:
        return np.empty(0, dtype=np.uint64)
    buf = LOWER[np.frombuffer(data, dtype=np.uint8)]
    return hash_words(buf, *spans(buf, is_word))


def shingles(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Hash of each run of k words, or of the whole sequence if it is shorter; none without words."""
    n = words.size
    if n == 0:
        return words
    if n < k:
        return mix((words * _PLACE[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
    out = words[: n - k + 1] * _PLACE[0]
    for i in range(1, k):
        out += words[i: n - k + 1 + i] * _PLACE[i]
    return mix(out + np.uint64(k))


def shingle_set(data: bytes | None, k: int = 5, is_word: np.ndarray = NOT_SPACE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return np.unique(shingles(text_words(data, is_word), k))
