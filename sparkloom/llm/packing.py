"""Packing documents into training sequences by minimum bin slack.

A document's ids (with its end id) fill whole windows of ``capacity`` first; what is left, 1 to capacity - 1 ids, is
a remainder. The remainders of a block of documents form a multiset of lengths. For each next window a subset-sum
dynamic programme over a bitset (one Python integer, bit s: sum s can be reached) finds the sum closest to the
capacity, walks back to the count of each length, and the pattern is used as often as the counts allow. A window that
no multiset fills exactly takes a cut piece of one more remainder, so only the last window of a block can stay short;
that one is split at powers of two, which are not padded.

A block is an input split (bounded by spark.sql.files.maxPartitionBytes); blocks need no shuffle and no common state,
so any lost task is redone alone. Null texts count as empty and give one piece: the end id. Repeated ids are packed
like any other rows. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sparkloom.llm.common import give_back, ship

MAX_CACHED_STRETCHES, MAX_CACHED_WORDS = 400_000, 200_000
#: Lower-cased Latin-1: letters, numbers, and the contractions and runs of the word-level pre-tokenizer.
_LETTERS, _NUMBERS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}\t\n\r\x0b\x0c \x85\xa0]+")
_ODD = re.compile("[\x00-\x08\x0e-\x1f\x7f-\x9fĀ-\U0010ffff]")


class _Learnt(dict):
    """Values by key, made when a key is first asked for; emptied when full."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


class WordIds:
    """Ids of texts by a vocabulary file, cached by stretch between white space."""

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.model = self.whole.model
        self.special = [x.content for x in self.whole.get_added_tokens_decoder().values()]
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        table = {b: chr(b) for b in visible}
        table |= {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in table)}
        self.as_bytes = {c: "".join(table[b] for b in chr(c).encode()) for c in range(256)}
        self.end = np.array([end_id], "<u4").tobytes()
        self.bytes_of = [np.array([i], "<u4").tobytes() for i in range(self.whole.get_vocab_size())]
        self.words = _Learnt(self._word, MAX_CACHED_WORDS)
        self.stretches = _Learnt(self._stretch, MAX_CACHED_STRETCHES)

    def _word(self, word: str) -> bytes:
        return b"".join([self.bytes_of[t.id] for t in self.model.tokenize(word if word.isascii() else word.translate(self.as_bytes))])

    def _stretch(self, stretch: str) -> bytes:
        if stretch.isalpha():  # in Latin-1 these are the letters of _PIECE
            return self.words[stretch]
        return b"".join([self.words[w] for w in _PIECE.findall(stretch)])

    def __call__(self, text: str | None) -> bytes:
        """The ids of a whole text and the end id, little-endian, four bytes each."""
        if not text:
            return self.end
        if any(x in text for x in self.special) or _ODD.search(text):  # anything whose normal form or cut may depend on more than Latin-1
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes() + self.end
        return b"".join(map(self.stretches.__getitem__, text.lower().split())) + self.end


@lru_cache(maxsize=2)
def word_ids(path: str, end_id: int) -> WordIds:
    """One for each worker process."""
    return WordIds(path, end_id)


def closest_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, within counts, whose sum is closest to capacity from below.

    Longer lengths come first; the programme stops as soon as the capacity is reached. Of the lengths over half the
    capacity only one can be used, so their sums are themselves.
    """
    mask, reach, steps = (1 << (capacity + 1)) - 1, 1, []
    for length in counts:
        if capacity < 2 * length <= 2 * capacity and counts[length] > 0:
            reach |= 1 << length
    short = () if reach >> capacity & 1 else sorted([n for n in counts if 2 * n <= capacity], reverse=True)
    for length in short:
        left, take = min(counts[length], capacity // length), 1
        while left > 0:  # binary parts of the count
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            take *= 2
        if reach >> capacity & 1:
            break
    at, used = reach.bit_length() - 1, defaultdict(int)
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            used[length] += take
            at -= length * take
    if at:
        used[at] += 1
    return dict(used)


def fill_windows(lengths: list[int], capacity: int) -> Iterator[list[tuple[int, int, int]]]:
    """Windows over items of 1 to capacity - 1 ids: lists of (item, start in the item, length). All but the last few are full."""
    of: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for item, n in enumerate(lengths):
        of[n].append((item, 0))
    while of:
        pattern = closest_fill({n: len(x) for n, x in of.items()}, capacity)
        total = sum(n * k for n, k in pattern.items())
        times = min(len(of[n]) // k for n, k in pattern.items()) if total == capacity else 1
        for _ in range(times):
            window = [(*of[n].pop(), n) for n, k in pattern.items() for _ in range(k)]
            for n in pattern:
                if not of[n]:
                    del of[n]
            if (slack := capacity - total) and of:  # nothing that is left fits whole: cut a piece of the longest
                n = max(of)
                item, start = of[n].pop()
                if not of[n]:
                    del of[n]
                window.append((item, start, slack))
                of[n - slack].append((item, start + slack))
                slack = 0
            if not slack:
                yield window
            else:
                yield from _powers(window)
            if not of:
                return


def _powers(window: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The same ids in sequences whose lengths are the powers of two of their sum."""
    total, rest = sum(n for _, _, n in window), list(reversed(window))
    for bit in range(total.bit_length() - 1, -1, -1):
        need, out = total & (1 << bit), []
        while need:
            item, start, n = rest.pop()
            take = min(n, need)
            out.append((item, start, take))
            if n > take:
                rest.append((item, start + take, n - take))
            need -= take
        if out:
            yield out


SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """One row for each piece of a document: where its ids stand in the document and in the sequences.

    with_ids adds ``ids array<int>``. sequence_id is the block's number times 2**32 plus the sequence's in the block.
    """
    ship(docs.sparkSession)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = word_ids(vocabulary, end_id)
        first, number, rows = TaskContext.get().partitionId() << 32, 0, []
        rests: list[tuple[int, int, int, bytes]] = []  # doc_id, start, tokens of the document, its last ids

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows))
            names, types = [x.split()[0] for x in SCHEMA.split(", ")], [pa.int64()] * 7
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            if with_ids:
                names, arrays = [*names, "ids"], [*arrays, pa.array([np.frombuffer(x, "<i4") for x in columns[7]], pa.list_(pa.int32()))]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py())
                n = len(ids) // 4
                whole = n - n % capacity
                for at in range(0, whole, capacity):
                    piece = ids[4 * at : 4 * (at + capacity)]
                    rows.append((doc, at, capacity, zlib.crc32(piece), n, first + number, 0, piece))
                    number += 1
                if n > whole:
                    rests.append((doc, whole, n, ids[4 * whole :]))
            if len(rows) > 5000:
                yield out()
            give_back()
        for window in fill_windows([r[2] - r[1] for r in rests], capacity):
            offset = 0
            for item, at, n in window:
                doc, start, tokens, ids = rests[item]
                piece = ids[4 * at : 4 * (at + n)]
                rows.append((doc, start + at, n, zlib.crc32(piece), tokens, first + number, offset, piece))
                offset += n
            number += 1
            if len(rows) > 5000:
                yield out()
        if rows:
            yield out()
        rests.clear()
        give_back()

    return docs.select("doc_id", "text").mapInArrow(over, SCHEMA + ", ids array<int>" * with_ids)
