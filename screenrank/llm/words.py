"""Words, shingles and MinHash values as numpy arrays (used inside Spark tasks).

A word is a maximal run of characters that are not ASCII punctuation, blanks or
control characters, in lower case; ``WORD_PATTERN`` is the same rule as a
regular expression for lower-cased text. A shingle is ``SHINGLE_WORDS``
consecutive words; a shorter, non-empty text has one shingle of all its words;
a null text, or one without words, has none.
"""

from __future__ import annotations

import numpy as np

SHINGLE_WORDS = 5
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[:128] = [chr(c).isalnum() for c in range(128)]
_IS_INK = np.ones(256, dtype=bool)
_IS_INK[[ord(c) for c in " \t\n\x0b\x0c\r"]] = False
_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_P_INV = pow(_P, -1, 2 ** 64)
_U = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=_U)


class _Powers:
    """Powers of the base and its inverse, grown on demand (one copy a process)."""

    up = _powers(_P, 1024)
    down = _powers(_P_INV, 1024)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            size = 1 << (n - 1).bit_length()
            cls.up, cls.down = _powers(_P, size), _powers(_P_INV, size)
        return cls.up, cls.down


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def word_hashes(text: str | None) -> np.ndarray:
    """One 64-bit hash per word, in text order."""
    return _runs(text.lower(), _IS_WORD)[2] if text else np.empty(0, dtype=_U)


def blank_words(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) per run of characters other than blanks, as it stands;
    places are counted in bytes of UTF-8."""
    return _runs(text or "", _IS_INK)


def rolling(items: np.ndarray, size, base: int = _P, start: np.ndarray | None = None) -> np.ndarray:
    """Hashes of ``size`` (a number, or one per start) items from each start on,
    by default from every start that has so many."""
    if start is None:
        start = np.arange(max(len(items) - size + 1, 0))
    total = np.zeros(len(items) + 1, dtype=_U)
    np.cumsum(items * _powers(base, len(items)), out=total[1:])
    return mix((total[start + size] - total[start]) * _powers(pow(base, -1, 2 ** 64), len(items) + 1)[start])


def _runs(text: str, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    word = np.zeros(len(raw) + 2, dtype=np.int8)
    word[1:-1] = kind[raw]
    edge = np.diff(word)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _Powers.upto(len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=_U)
    np.cumsum((raw.astype(_U) + _U(1)) * up[:len(raw)], out=total[1:])
    return start, end, mix((total[end] - total[start]) * down[start])


def shingles(text: str | None, k: int = SHINGLE_WORDS) -> np.ndarray:
    """One 64-bit hash per word ``k``-gram, in text order, repeats kept."""
    w = word_hashes(text)
    if not len(w):
        return w
    n = min(k, len(w))
    acc = np.zeros(len(w) - n + 1, dtype=_U)
    for i in range(n):
        acc = mix(acc + _U(i + 1)) + w[i:len(w) - n + 1 + i]
    return mix(acc + _U(n))


class MinHash:
    """``size`` independent min-wise values of a set of 64-bit hashes."""

    def __init__(self, size: int, seed: int = 7) -> None:
        self.mul = np.random.default_rng(seed).integers(1, 2 ** 63, size, dtype=_U) * _U(2) + _U(1)

    def signature(self, items: np.ndarray, step: int = 2048) -> np.ndarray:
        """Top 32 bits of the least product, by slices so that memory stays small."""
        best = np.full(len(self.mul), 2 ** 64 - 1, dtype=_U)
        for i in range(0, len(items), step):
            np.minimum(best, (items[i:i + step, None] * self.mul).min(axis=0), out=best)
        return (best >> _U(32)).astype(np.uint32)
