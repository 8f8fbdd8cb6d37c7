"""BPE encoding and decoding over a trie of distinct words.

The encoding of a word's prefix of n bytes is fixed by its last token: a token t that ends at n is the last one
exactly if the prefix without t ends in a token after which t can stand, that is, no merge runs across their border
before both are complete. So one state (the last token) for each trie node is enough. The distinct words of a batch
go into a trie, a depth-first walk sets the state of each node once, and words that share a prefix share its states.
A word's tokens follow by walking its states back.

Cutting a text into words is left to the tokenizer file's own pre-tokenizer, but for stretches of plain letters or
digits and signs; each distinct stretch between ASCII white space is cut once. Null texts count as empty: no tokens, the digest of the empty string.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import filterfalse
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sparkloom.llm.common import arrow_map

#: Stretches that the byte-level pre-tokenizer cuts apart whatever stands around them, if all white space is ASCII.
_STRETCH = re.compile(r" ?[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+(?![^ \t\n\r\x0b\x0c])|[ \t\n\r\x0b\x0c]+")
#: White space and separators beyond the six ASCII ones; texts with any of them are cut as a whole.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")

#: Stretches whose cut needs no pre-tokenizer: Latin-1 letters or ASCII digits, and ASCII signs without the apostrophe.
_PLAIN = re.compile("( ?(?:[A-Za-zªµºÀ-ÖØ-öø-ÿ]+|[0-9]+))([!-&(-/:-@[-`{-~]*)")
#: Characters of neighbouring words that are compared for all words at once.
_WIDE = 32

#: Bounds of a worker's memory, in entries; reaching one only costs repeated work.
MAX_CACHED_WORDS, MAX_CACHED_PAIRS, MAX_TRIE_WORDS, MAX_GROUP_CHARS = 1_000_000, 1_000_000, 20_000, 1_000_000


class TrieBPE:
    """Encoder and decoder of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.pre = Tokenizer.from_file(path).pre_tokenizer
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.born, self.left, self.right = [-1] * size, [0] * size, [0] * size
        self.pairs: dict[tuple[int, int], int] = {}
        made = set()
        for order, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            t = vocab[a + b]
            self.pairs.setdefault((vocab[a], vocab[b]), order)
            if t not in made:
                made.add(t)
                self.born[t], self.left[t], self.right[t] = order, vocab[a], vocab[b]
        self.ids = {w: i for w, i in vocab.items() if len(w) == 1 or i in made}
        self._automaton()
        byte = _byte_alphabet()
        self.names, self.bytes_of = [str(i) for i in range(size)], [b""] * size
        for w, i in vocab.items():
            self.bytes_of[i] = bytes(byte[c] for c in w)
        for w, i in self.special.items():
            self.bytes_of[i] = w.encode()
        self.size = [len(x) for x in self.bytes_of]
        self.fits_after: dict[tuple[int, int], bool] = {}
        self.words: dict[str, tuple[str, bytes]] = {}  # a pre-tokenizer's word -> its piece: ids in decimal, joined by commas, and their bytes
        self.stretches: dict[str, tuple[str, bytes]] = {}

    def fits(self, a: int, b: int) -> bool:
        """Whether token b can stand right after token a: undo the later merge at the border, again and again."""
        known = self.fits_after.get((a, b))
        if known is not None:
            return known
        key, before_a, before_b, good = (a, b), 1 << 60, 1 << 60, True
        while True:
            order = self.pairs.get((a, b))
            if order is not None and order < before_a and order <= before_b:
                good = False
                break
            if self.born[a] < 0 and self.born[b] < 0:
                break
            if self.born[a] > self.born[b]:
                before_a, a = self.born[a], self.right[a]
            else:
                before_b, b = self.born[b], self.left[b]
        if len(self.fits_after) >= MAX_CACHED_PAIRS:
            self.fits_after.clear()
        self.fits_after[key] = good
        return good

    def _automaton(self) -> None:
        """Nodes for the beginnings of tokens, the node each falls back to, and the tokens (with lengths) that end there, the longest first."""
        self.moves, self.fallback, self.ending = [{}], [0], [()]
        whole: dict[int, int] = {}
        for word, token in self.ids.items():
            node = 0
            for c in word:
                below = self.moves[node].get(c)
                if below is None:
                    below = self.moves[node][c] = len(self.moves)
                    self.moves.append({})
                node = below
            whole[node] = token
        self.fallback, self.ending = [0] * len(self.moves), [()] * len(self.moves)
        level, depth = [0], 0
        while level:  # a node falls back to one of less depth
            depth, above, level = depth + 1, level, []
            for node in above:
                for c, below in self.moves[node].items():
                    at = self.fallback[node]
                    while at and c not in self.moves[at]:
                        at = self.fallback[at]
                    self.fallback[below] = at = self.moves[at].get(c, 0) if node else 0
                    self.ending[below] = ((whole[below], depth), *self.ending[at]) if below in whole else self.ending[at]
                    level.append(below)

    def _step(self, node: int, c: str) -> int:
        """The node of the longest beginning of a token at the end of node's string and c; kept for the next time."""
        at = node
        while at and c not in self.moves[at]:
            at = self.fallback[at]
        self.moves[node][c] = below = self.moves[at].get(c, 0)
        return below

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of each distinct word, by one depth-first walk over the trie of all of them.

        Sorted words are the paths of the trie in the order of the walk: the nodes a word shares with the one before stay.
        """
        moves, ending, known, size = self.moves, self.ending, self.fits_after, self.size
        words = sorted(words)
        last, nodes = ([0] * (max(map(len, words), default=0) + 1) for _ in range(2))
        out: dict[str, list[int]] = {}
        for word, depth in zip(words, _shared(words)):
            node = nodes[depth]
            for c in word[depth:]:
                depth += 1
                nodes[depth] = node = moves[node][c] if c in moves[node] else self._step(node, c)
                for token, n in ending[node]:  # the longest first: it is the right one more often than not
                    if n == depth:
                        break
                    good = known.get((last[depth - n], token))
                    if good or good is None and self.fits(last[depth - n], token):
                        break
                else:
                    raise ValueError(f"no encoding of {word[:depth]!r}")
                last[depth] = token
            back = []
            while depth:
                back.append(last[depth])
                depth -= size[last[depth]]
            out[word] = back[::-1]
        return out

    def _learn(self, stretches: Iterable[str]) -> None:
        """Put the pieces of new stretches into the cache."""
        cut = {}
        for s in stretches:
            plain = _PLAIN.fullmatch(s)
            cut[s] = [w for w in plain.groups() if w] if plain else [w for w, _ in self.pre.pre_tokenize_str(s)]
            if plain:
                cut[s][0] = cut[s][0].translate(_AS_BYTES)
        if len(self.words) > MAX_CACHED_WORDS:
            self.words.clear()  # words of stretches that stay in the cache are not needed again
        new = [w for w in {w for ws in cut.values() for w in ws} if w not in self.words]
        for i in range(0, len(new), MAX_TRIE_WORDS):
            for word, ids in self.encode_words(new[i : i + MAX_TRIE_WORDS]).items():
                self.words[word] = self._piece(ids)
        for s, ws in cut.items():
            found = [self.words[w] for w in ws]
            self.stretches[s] = found[0] if len(found) == 1 else (",".join([ids for ids, _ in found]), b"".join([data for _, data in found]))

    def _piece(self, ids: list[int]) -> tuple[str, bytes]:
        """Ids in decimal, joined by commas, and the bytes they are decoded to."""
        return ",".join([self.names[i] for i in ids]), b"".join([self.bytes_of[i] for i in ids])

    def encode_many(self, texts: list[str]) -> list[list[tuple[str, bytes]]]:
        """Pieces of each whole text. Words new to the worker go into one trie together."""
        cut, new = [], set()
        for text in texts:
            parts = [(part, None if part in self.special else [part] if _OTHER_SPACE.search(part) else _STRETCH.findall(part)) for part in (self.cut.split(text) if self.cut else [text]) if part]
            cut.append(parts)
            for _, stretches in parts:
                if stretches:
                    new.update(filterfalse(self.stretches.__contains__, stretches))
        if len(self.stretches) + len(new) > MAX_CACHED_WORDS:
            self.stretches.clear()
            new = {s for parts in cut for _, stretches in parts if stretches for s in stretches}
        self._learn(new)
        known = self.stretches.__getitem__
        return [[piece for part, stretches in parts for piece in ([self._piece([self.special[part]])] if stretches is None else map(known, stretches))] for parts in cut]

    def encode(self, text: str) -> str:
        return ",".join([ids for ids, _ in self.encode_many([text])[0]])

    def decode(self, pieces: list[tuple[str, bytes]]) -> str:
        """Text of the ids of pieces; bytes that are no UTF-8 become U+FFFD. A word's ids are decoded once."""
        return b"".join([data for _, data in pieces]).decode("utf-8", "replace")


def _shared(words: list[str]) -> list[int]:
    """How many characters each of the sorted, distinct words shares with the one before; vocabularies hold no NUL, which pads."""
    if not words:
        return []
    wide = np.array([w[:_WIDE] for w in words], f"U{_WIDE}").view(np.uint32).reshape(len(words), _WIDE)
    differ = np.ones((len(words), _WIDE + 1), bool)
    differ[1:, :_WIDE] = wide[1:] != wide[:-1]
    shared = [0, *differ[1:].argmax(axis=1).tolist()]
    for i in [i for i, n in enumerate(shared) if n == _WIDE]:
        shared[i] = len(commonprefix(words[i - 1 : i + 1]))
    return shared


def _byte_alphabet() -> dict[str, int]:
    """The byte of each character of byte-level vocabularies: visible Latin-1 stands for itself, the rest follows from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


#: Latin-1 characters in the byte alphabet.
_AS_BYTES = {c: "".join({b: a for a, b in _byte_alphabet().items()}[b] for b in chr(c).encode()) for c in range(256)}


@lru_cache(maxsize=2)
def coder(path: str) -> TrieBPE:
    """One coder for each worker process."""
    return TrieBPE(path)


def _encoded(bpe: TrieBPE, texts: pa.Array):
    """Pieces of each text in turn, encoded a few million characters at a time."""
    group, size = [], 0
    for text in texts:
        group.append(text.as_py() or "")
        size += len(group[-1])
        if size > MAX_GROUP_CHARS:
            yield from bpe.encode_many(group)
            group, size = [], 0
    yield from bpe.encode_many(group)


def encode_documents(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids): the ids of every whole text, in decimal, joined by commas. Null texts give an empty string."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = coder(vocabulary)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([",".join([ids for ids, _ in pieces]) for pieces in _encoded(bpe, batch.column(1))], pa.string())], [id_column, "ids"])

    return arrow_map(docs.select(id_column, text_column), each, f"{id_column} {docs.schema[id_column].dataType.simpleString()}, ids string")


def round_trip_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row for each document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Encodes every whole text and decodes its ids again in one pass without a shuffle; ids never leave the worker.
    Repeated doc_ids give a row each. Columns besides doc_id and text are not read.
    """

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe, n, of_ids, of_text = coder(vocabulary), [], [], []
        for pieces in _encoded(bpe, batch.column(1)):
            ids = ",".join([x for x, _ in pieces])
            n.append(ids.count(",") + 1 if ids else 0)
            of_ids.append(hashlib.sha256(ids.encode()).hexdigest())
            of_text.append(hashlib.sha256(bpe.decode(pieces).encode()).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return arrow_map(docs.select("doc_id", "text"), each, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
