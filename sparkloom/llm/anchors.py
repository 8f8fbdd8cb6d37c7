"""Content-defined stretches: which long windows of bytes, or of words, can be equal at all.

Every window of ``length`` symbols has an anchor, the gram of smallest hash in it (the leftmost of equals), which
depends on the window's symbols alone; equal windows have equal anchors at equal offsets. The symbols before an anchor
fall into three classes of equal width; all windows of an anchor and class cover the same core, ``length`` less one
width. Consecutive windows with one anchor and class make a stretch: at most a width, the core, at most a width. Equal
windows are in stretches with equal cores, so the core's hash says where to look for them.

Symbols are bytes (grams of GRAM) or words as they are written, each given by its hash (grams of GRAM_WORDS).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash

from sparkloom.llm.tokens import hashed, mix, runs_of

GRAM, GRAM_WORDS = 16, 15
CHUNK = 1 << 19
_PLACE_BITS = np.uint64(20)


def width_of(length: int, gram: int = GRAM) -> int:
    if length <= gram or (length - gram) % 3:
        raise ValueError(f"the length must be {gram} plus a multiple of 3")
    return (length - gram) // 3


def _leftmost_least(grams: np.ndarray, wide: int) -> np.ndarray:
    """The place of the smallest of each wide neighbours, the leftmost of equals; at most 2 ** 20 grams."""
    windows = len(grams) - wide + 1
    least = ((grams >> _PLACE_BITS) << _PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while 2 * span <= wide:
        least = np.minimum(least[: len(least) - span], least[span:])
        span *= 2
    least = np.minimum(least[:windows], least[wide - span : wide - span + windows])
    return (least & np.uint64((1 << 20) - 1)).astype(np.int64)


def word_hashes(data: bytes) -> np.ndarray:
    """A hash of each word as it is written."""
    return hashed(data)[0]


def word_places(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The bytes at which each word begins and ends."""
    return hashed(data)[1:]


def _cut(n: int, length: int, gram: int, grams: Callable[[int, int], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, size, symbols before the core) of the stretches of n symbols; grams(at, m) are the hashes of m grams from at on."""
    wide, width = length - gram + 1, width_of(length, gram)
    starts, sizes, leads = [], [], []
    for at in range(0, n - length + 1, CHUNK):
        windows = min(CHUNK, n - length + 1 - at)
        place = _leftmost_least(grams(at, windows + wide - 1), wide)
        kind = np.minimum((place - np.arange(windows)) // width, 2)
        first = np.flatnonzero(np.diff(place * 4 + kind, prepend=-1))
        starts.append(first + at)
        sizes.append(np.diff(np.append(first, windows)) + length - 1)
        leads.append(place[first] - width * kind[first] - first)
    return tuple(map(np.concatenate, (starts, sizes, leads))) if starts else (np.zeros(0, np.int64),) * 3


def _digests(data: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    view = memoryview(data)
    return np.fromiter((xxhash.xxh3_64_intdigest(view[i:k]) for i, k in zip(begin.tolist(), end.tolist())), np.uint64, len(begin))


def stretches(data: bytes, length: int):
    """(start, size, bytes before the core, hash of the core, hash of the stretch) arrays over all windows of data."""

    def grams(at: int, m: int) -> np.ndarray:
        part = data[at : at + m + GRAM - 1]
        words = np.ndarray((len(part) - 7,), "<u8", part, strides=(1,))
        return mix(mix(words[:m]) + words[8 : 8 + m])

    start, size, lead = _cut(len(data), length, GRAM, grams)
    core = start + lead
    return start, size, lead, _digests(data, core, core + length - width_of(length)), _digests(data, start, start + size)


def word_stretches(hashes: np.ndarray, length: int):
    """The same in words, given by their hashes."""
    if len(hashes) < length:
        return stretches(b"", length=GRAM + 3)
    all_of = runs_of(hashes, GRAM_WORDS)
    start, size, lead = _cut(len(hashes), length, GRAM_WORDS, lambda at, m: all_of[at : at + m])
    cores = runs_of(hashes, length - width_of(length, GRAM_WORDS))
    return start, size, lead, cores[start + lead], _digests(hashes.tobytes(), 8 * start, 8 * (start + size))
