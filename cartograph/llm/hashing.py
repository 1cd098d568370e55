"""Vectorised 64-bit hashes of words (numpy), the same on every machine."""

from __future__ import annotations

import numpy as np

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of the 64-bit numbers that scatters neighbours (multiply and shift)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_LETTER = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
STEP = _U(0x2545F4914F6CDD1D)


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of words that are separated by single spaces (``text`` has one at least).

    Two different words collide with a chance of about 2^-64.
    """
    letters = np.frombuffer(text, dtype=np.uint8)
    gaps = np.flatnonzero(letters == 32)
    starts = np.concatenate([[0], gaps + 1])
    sizes = np.diff(np.append(starts, len(text) + 1)) - 1
    powers = np.multiply.accumulate(np.full(int(sizes.max()) + 1, STEP, dtype=_U))
    place = np.arange(len(letters)) - np.repeat(starts, sizes + 1)[: len(letters)]
    value = _LETTER[letters] * powers[place]
    value[gaps] = 0
    return mix(np.add.reduceat(value, starts) + sizes.astype(_U))


_FOLD = bytes(32 if b in b" \t\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, first three bytes as a number, words in each text) of texts in UTF-8.

    A-Z are lower-cased and words split at the six ASCII blanks; the hashes are
    those of ``word_hashes``.
    """
    joined = b" ".join([b"", *texts, b""]).translate(_FOLD)
    letters = np.frombuffer(joined, dtype=np.uint8)
    inside = letters != 32
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    sizes = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1 - starts
    ends = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, ends, side="right"), prepend=0)
    if not len(starts):
        return np.empty(0, dtype=_U), np.empty(0, dtype=_U), counts
    full = letters[inside]
    begin = np.cumsum(sizes) - sizes
    powers = np.multiply.accumulate(np.full(int(sizes.max()), STEP, dtype=_U))
    value = _LETTER[full]
    value *= powers[np.arange(len(full), dtype=np.int32) - np.repeat(begin.astype(np.int32), sizes)]
    hashes = mix(np.add.reduceat(value, begin) + sizes.astype(_U))
    padded = np.append(letters, np.zeros(2, dtype=np.uint8))
    head = np.zeros(len(starts), dtype=_U)
    for i in range(3):
        head = head * _U(257) + np.where(sizes > i, padded[starts + i], np.uint8(0))
    return hashes, head, counts
