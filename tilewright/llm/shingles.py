"""Hashes of words and word shingles of a text, by whole-array arithmetic."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_RNG = np.random.default_rng(20240229)
_LETTER = _RNG.integers(1, 2**63, 256, dtype=_U)
_LETTER[65:91] = _LETTER[97:123]  # A-Z count as a-z
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_CHUNK = 1 << 20
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        _powers[:] = [np.cumprod(np.concatenate(([_U(1)], np.full(size, b, _U)))) for b in (_U(_BASE), _U(_INVERSE))]
    return _powers


def _chunks(data: bytes):
    """Pieces of about a megabyte that end between words, so that tables stay small for very long texts."""
    at = 0
    while at < len(data):
        end = min(len(data), at + _CHUNK)
        while end < len(data) and not _BLANK[data[end]]:
            end += 1
        yield data[at:end]
        at = end


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word, A-Z lower-cased."""
    out = []
    for data in _chunks(text.encode("utf-8", "surrogatepass")):
        b = np.frombuffer(data, np.uint8)
        step = np.diff(np.concatenate(([0], (~_BLANK[b]).astype(np.int8), [0])))
        start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        power, inverse = _tables(len(b) + 1)
        sums = np.concatenate(([_U(0)], np.cumsum(_LETTER[b] * power[: len(b)], dtype=_U)))
        out.append(mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(_U) * _U(0xD6E8FEB86659FD93)))
    return np.concatenate(out) if out else np.zeros(0, _U)


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all ``width``-word windows; fewer words count as one window, no words as none."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    n = max(1, len(words) - width + 1)
    total = np.full(n, _U(min(len(words), width) * 0xA0761D6478BD642F % 2**64), _U)
    for j in range(min(width, len(words))):
        total = mix(total + words[j:j + n] * _U((0xE7037ED1A0B428DB + 2 * j * 0x8EBC6AF09C88C6E3) % 2**64 | 1))
    return np.unique(total)
