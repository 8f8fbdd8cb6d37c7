"""Hashes of all words of many texts at once, without an object for each word.

A word's hash is a polynomial over its bytes modulo 2 ** 64, read off prefix sums over the whole buffer, and mixed.
Words of over LONG bytes are hashed one by one instead, so that a sum never reaches far.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash

CHUNK, LONG = 1 << 20, 512
_SPACE = b" \t\n\x0b\x0c\r"
_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Tables:
    """Powers of an odd base and of its inverse, a number for each byte, and which bytes are in words."""

    def __init__(self):
        base = 0xA24BAED4963EE407
        self.powers, self.inverses = (np.cumprod(np.full(CHUNK + LONG, b, np.uint64)) for b in (base, pow(base, -1, 1 << 64)))
        self.powers, self.inverses = (np.concatenate([np.ones(1, np.uint64), x[:-1]]) for x in (self.powers, self.inverses))
        self.of_byte = mix(np.arange(1, 257, dtype=np.uint64))
        self.in_word = np.ones(256, bool)
        self.in_word[list(_SPACE)] = False


_tables: list[_Tables] = []


def _ready() -> _Tables:
    """The tables, made once for each process."""
    if not _tables:
        _tables.append(_Tables())
    return _tables[0]


def hashed(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, byte after the last) of each word of data, as it is written."""
    t, x = _ready(), np.frombuffer(data, np.uint8)
    inside = np.zeros(len(x) + 2, bool)
    inside[1:-1] = t.in_word[x]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edges[::2], edges[1::2]
    out = np.zeros(len(begin), np.uint64)
    for at in range(0, len(x), CHUNK):
        i, k = np.searchsorted(begin, (at, at + CHUNK))
        if i == k:
            continue
        part = x[at : at + CHUNK + LONG]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(t.of_byte[part] * t.powers[: len(part)], out=sums[1:])
        first = begin[i:k] - at
        out[i:k] = (sums[np.minimum(end[i:k] - at, len(part))] - sums[first]) * t.inverses[first]
    for i in np.flatnonzero(end - begin > LONG):
        out[i] = xxhash.xxh3_64_intdigest(data[begin[i] : end[i]])
    return mix(out), begin, end


def words_of_texts(texts: Iterable[str | None], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of all texts in turn, number of words of each text); A-Z lower-cased if asked for; null has none."""
    found = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    data = b"\n".join(found)
    hashes, begin, _ = hashed(data.translate(_UPPER) if lower else data)
    stops = np.cumsum(np.array([len(t) + 1 for t in found], np.int64))
    return hashes, np.diff(np.searchsorted(begin, stops, "left"), prepend=0)


def runs_of(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k neighbours (LONG at most), in their order: the same polynomial over hashes, read off prefix sums."""
    t, out = _ready(), np.empty(max(0, len(hashes) - k + 1), np.uint64)
    for at in range(0, len(out), CHUNK):
        part = hashes[at : at + CHUNK + k - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * t.powers[: len(part)], out=sums[1:])
        n = len(part) - k + 1
        out[at : at + n] = (sums[k:] - sums[:n]) * t.inverses[:n]
    return mix(out)


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, heads): the places of the keys sorted by key, and where in that order each distinct key begins.

    Key and place are sorted as one integer; keys that differ in their low bits alone are put right afterwards.
    """
    n = len(keys)
    bits = np.uint64(max(1, n.bit_length()))
    packed = ((keys >> bits) << bits) | np.arange(n, dtype=np.uint64)
    packed.sort()
    order = (packed & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    found = keys[order]
    for k in np.flatnonzero(found[1:] < found[:-1]):
        low, high = (int(np.searchsorted(packed >> bits, packed[k] >> bits, side)) for side in ("left", "right"))
        order[low:high] = order[low:high][np.argsort(keys[order[low:high]], kind="stable")]
        found[low:high] = keys[order[low:high]]
    return order, np.flatnonzero(np.concatenate([np.ones(min(n, 1), bool), found[1:] != found[:-1]]))


def numbered(order: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """The number of each place's key among the distinct keys."""
    marks = np.zeros(len(order), np.int32)
    marks[heads] = 1
    out = np.empty(len(order), np.int32)
    out[order] = np.cumsum(marks, dtype=np.int32) - 1
    return out
