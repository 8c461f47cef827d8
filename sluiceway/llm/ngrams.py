"""Character n-grams of a text as hashed buckets, in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

from sluiceway.llm.text import mix64

_STEP = np.uint64(0x9E3779B97F4A7C15)
# Whether a code point belongs to a word: exact for Latin scripts, and everything above but spaces and punctuation.
_LATIN = np.array([chr(i).isalnum() for i in range(0x250)])
_GAPS = (
    (0x2000, 0x206F), (0x2190, 0x2BFF), (0x3000, 0x3004), (0x3008, 0x3020), (0x302A, 0x3030), (0x3036, 0x3037), (0x303D, 0x303F),
    (0xFF00, 0xFF0F), (0xE000, 0xF8FF),
)
PIECE = 200_000  # characters worked on at a time
_CUT = re.compile("[\\t-\\r \u3001\u3002]")  # never part of a word


def pieces(text: str) -> Iterator[str]:
    """The text cut between words: n-grams lie within words, so those of the pieces are those of the text."""
    at = 0
    while len(text) - at > PIECE:
        gap = _CUT.search(text, at + PIECE)
        if not gap:
            break
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:] if at else text


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)


def word_mask(points: np.ndarray) -> np.ndarray:
    mask = points >= 0x250
    mask[~mask] = _LATIN[points[~mask]]
    high = points >= 0x2000
    if high.any():
        for first, last in _GAPS:
            mask &= ~((points >= first) & (points <= last))
    return mask


def word_stream(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points with one boundary (0) around and between words; and the word number of each place."""
    points = code_points(text)
    mask = word_mask(points)
    keep = mask.copy()
    keep[1:] |= mask[:-1] & ~mask[1:]
    stream = np.where(mask, points, 0)[keep]
    first, last = not len(stream) or stream[0] != 0, len(stream) and stream[-1] != 0
    stream = np.concatenate((np.zeros(int(first), np.uint32), stream, np.zeros(int(last), np.uint32)))
    return stream, np.cumsum(stream == 0) - 1


def grams(text: str, low: int, high: int, bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bucket, word number) of all n-grams of `low` to `high` characters, and the number of words.

    An n-gram lies within one word; the word's boundary counts as a character at either end.  Takes some hundred
    bytes a character: give long texts in `pieces`.
    """
    stream, words = word_stream(text)
    count = int(words[-1]) if len(words) else 0
    if count == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), 0
    codes, size = stream.astype(np.uint64) + np.uint64(1), len(stream)
    edges = np.concatenate(([0], np.cumsum(stream == 0)))
    found, owners = [], []
    value = codes
    for n in range(1, high + 1):
        if n > 1:
            if size < n:
                break
            value = value[: size - n + 1] * _STEP + codes[n - 1 :]
        if n < low:
            continue
        starts = np.arange(size - n + 1)
        # no boundary strictly inside; a single boundary alone is no n-gram
        inner = edges[starts + n - 1] - edges[starts + 1] if n > 1 else (stream == 0).astype(np.int64)
        good = np.flatnonzero(inner == 0)
        if n == 2:
            good = good[(stream[good] != 0) | (stream[good + 1] != 0)]
        hashed = mix64(value[good] + np.uint64(n * 0x5851F42D4C957F2D % 2**64)) >> np.uint64(64 - bits)
        found.append(hashed.astype(np.int64))
        owners.append(words[good])
    return np.concatenate(found), np.concatenate(owners), count
