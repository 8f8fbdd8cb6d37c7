"""Language-model scoring with a weighted backoff automaton over word n-grams.

Tokens are the words of a text (A-Z lower-cased) and one end token; before the first word stands the end token's
state. The model holds all n-grams up to its order that occur in training, with Dirichlet smoothing at each
order: p(w | h) = (c(h w) + m p(w | h')) / (c(h) + m), where h' is h without its first word and m the mass of the
order; p(w) = (c(w) + 1) / (N + V + 1). As an automaton: a state for each history seen, an arc for each n-gram seen
from its history to the longest history it ends in, weighted with its smoothed probability, and from each state a
failure arc to h', weighted m / (c(h) + m), over which all other words are read. The weights of a state's arcs and of
all that its failure arc leads to sum to one. One left-to-right traversal carries the state through a text and adds
the log10 weights of the arcs taken. Long texts are read in lanes of LANE words side by side; a lane begins a
history's length early at the root, which brings it to the state that the words before it lead to.

Counts come from all training texts and are never held in one place. A block is a run of texts of about BLOCK_BYTES
(one text at least) inside an input split. Each block sends its distinct n-grams (64-bit keys, with the block's
training counts) to the shards of the key space; a shard adds the counts of all blocks and answers each block in its
own key order. Then block and answers meet, and the block builds the part of the automaton that its texts can enter
and traverses it. Blocks and shards are bounded, however large the splits and the corpus, and a text or n-gram that
fills a third of the corpus is one key a block.

The model's order is one more than the number of masses given. MASSES makes it a trigram model: each order more sends
its n-grams once more, about as many bytes as the input has. The masses were chosen from a grid by the
likelihood of the held-out fold of 10,000 documents of synthetic prose, around which it is flat.

Null texts count as empty: one token, the end. Rows that repeat count each time. Null ids belong to no fold: scored,
not learnt from (held_out null). The input must give the same rows when read again (a table or a checkpoint; its
splits are pinned): a block that differs from what was asked for raises. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import give_back, pin_splits, remainder, ship, written
from sparkloom.llm.tokens import grouped, mix, numbered, words_of_texts

END = 0x5851F42D4C957F2D
MASSES = (5000.0, 4.0)  # of orders 2 and 3
BLOCK_BYTES, SHARD_KEYS, MOST_TASKS, LANE = 8_000_000, 4_000_000, 20_000, 512
#: Keys that are hashed at once.
STEP = 1 << 18


class Block:
    """Tokens of a block's texts, in turn, and what is known of the n-grams that end at each."""

    def __init__(self, texts: pa.Array, trains: pa.Array):
        words, counts = words_of_texts(t.as_py() for t in texts)
        self.sizes = counts + 1
        self.ends = np.cumsum(self.sizes) - 1
        self.tokens = np.full(len(words) + len(counts), END, np.uint64)
        is_word = np.ones(len(self.tokens), bool)
        is_word[self.ends] = False
        self.tokens[is_word] = words
        self.learnt = np.repeat(trains.to_numpy(zero_copy_only=False).astype(bool), self.sizes)
        self.place = np.arange(len(self.tokens), dtype=np.int32)
        self.place -= np.repeat((self.ends - self.sizes + 1).astype(np.int32), self.sizes)
        self.start = mix(np.array([END], np.uint64))[0]
        self.counts: dict[int, np.ndarray] = {}
        self._last = 0, mix(self.tokens)

    def keys(self, order: int) -> np.ndarray:
        """Key of the n-gram that ends at each token; of use where it does not reach beyond the text's start."""
        at, found = self._last if self._last[0] and self._last[0] <= order else (1, mix(self.tokens))
        while at < order:
            before = np.empty_like(found)
            before[1:] = found[:-1]
            if at == 1:
                before[self.place == 0] = self.start
            found, at = mix(before * np.uint64(3) + self.tokens), at + 1
        self._last = order, found
        return found

    def before(self, x: np.ndarray, first) -> np.ndarray:
        """Values at the token before; first at the start of a text."""
        out = np.empty_like(x)
        out[1:] = x[:-1]
        out[self.place == 0] = first
        return out

    def asked(self, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(places, their order by key, heads in it, distinct keys) of the n-grams to ask for."""
        at = np.flatnonzero(self.place >= order - 2)
        keys = self.keys(order)[at]
        by_key, heads = grouped(keys)
        return at, by_key, heads, keys[by_key[heads]]

    def hear(self, answers: dict[int, np.ndarray]) -> None:
        """Counts of all orders answered, for each token; 0 where an n-gram would reach beyond the text's start."""
        for order in sorted(answers):
            answer = answers[order]
            if int(answer.max(initial=0)) < (1 << 31) - 1:
                answer = answer.astype(np.int32)
            at, by_key, heads, keys = self.asked(order)
            if len(keys) != len(answer):
                raise RuntimeError("a block differs from what was asked for: the input changed between two scans")
            del keys
            number = numbered(by_key, heads)
            del by_key, heads
            count = np.zeros(len(self.tokens), answer.dtype)
            count[at] = answer[number]
            self.counts[order] = count
            del at, number


class Arcs:
    """An open-addressed table from (state, symbol) to the arc's number."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(4, (2 * len(self.keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.table = np.full(1 << bits, -1, np.int32)
        rest, slot = np.arange(len(self.keys), dtype=np.int32), np.empty(len(self.keys), np.int32 if bits < 31 else np.int64)
        for at in range(0, len(slot), STEP):
            slot[at : at + STEP] = self._slot(self.keys[at : at + STEP])
        while len(rest):
            free = self.table[slot] < 0
            self.table[slot[free]] = rest[free]
            lost = self.table[slot] != rest
            rest, slot = rest[lost], (slot[lost] + 1) & self.mask

    @staticmethod
    def of(states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """State and symbol of each pair as one integer."""
        keys = states.astype(np.uint64)
        keys <<= np.uint64(32)
        keys |= symbols.astype(np.uint32)
        return keys

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) >> self.shift).astype(np.int64)

    def find(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The arc of each pair; -1 where there is none."""
        if not len(self.keys):
            return np.full(len(states), -1, np.int32)
        keys = self.of(states, symbols)
        slot = self._slot(keys)
        out = self.table[slot]
        live = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        while len(live):
            slot[live] = (slot[live] + 1) & self.mask
            out[live] = self.table[slot[live]]
            live = live[(out[live] >= 0) & (self.keys[out[live]] != keys[live])]
        return out


class Automaton:
    """States (root 0), their failure arcs, and the arcs that a block's texts can take.

    Symbols are the distinct tokens of the block by number; a symbol that training lacks has no arc from the root.
    """

    def __init__(self, block: Block, total: int, kinds: int, masses=MASSES):
        self.room, self.history = float(total + kinds + 1), len(masses)
        self.unknown = -math.log10(self.room)
        by, first = grouped(block.keys(1))
        self.symbols = numbered(by, first)
        del by, first
        n = len(self.symbols)
        counts = block.counts
        end_count = int(counts[1][block.ends[0]])
        arcs, fails, backs = [], [np.zeros(1, np.int32)], [np.zeros(1)]
        state_before = np.zeros(n, np.int32)  # state of the history of the n-gram that ends at each token
        state, p, offset, first_state = np.zeros(n, np.int32), np.zeros(n), 1, 0
        self.start = 0
        for order in range(1, len(masses) + 2):
            count = counts[order]
            if order == 1:
                p = (count + 1) / self.room
            else:
                p *= masses[order - 2]
                p += count
                history = block.before(counts[order - 1], end_count if order == 2 else 0)
                np.maximum(history, 1, out=history)
                p /= history + masses[order - 2]
                p[count == 0] = 0.0
                del history
            some = np.flatnonzero(count > 0)
            by, first = grouped(block.keys(order)[some])
            at = some[by[first]]  # one place for each n-gram
            if order <= len(masses):
                here = np.zeros(n, np.int32)
                here[some] = offset + numbered(by, first)
                mass = masses[order - 1]
                fails.append(state[at] if order > 1 else np.zeros(len(at), np.int32))
                backs.append(np.log10(mass / (count[at] + mass)))
                offset += len(at)
                to = here[at]
                if order == 1:
                    ends = here[block.ends]
                    first_state = self.start = int(ends[0])  # 0 if no text was learnt from
            else:
                here, to = state, state[at]
            del some, by, first
            arcs.append((Arcs.of(state_before[at], self.symbols[at]), to, np.log10(p[at])))
            state_before, state = block.before(here, first_state if order == 1 else 0), here
        self.fail, self.back = np.concatenate(fails), np.concatenate(backs)
        del p, count, state, state_before, here, to, at, fails, backs
        keys, self.to, self.weight = map(list, zip(*arcs))
        del arcs
        self.to, self.weight, keys = np.concatenate(self.to), np.concatenate(self.weight), np.concatenate(keys)
        self.arcs = Arcs(keys)

    def traverse(self, sizes: np.ndarray, lane: int) -> np.ndarray:
        """log10 probability of each text: the state is carried over its tokens, the weights of arcs and failures add up."""
        warm = self.history
        pieces = -(-sizes // lane)
        text = np.repeat(np.arange(len(sizes)), pieces)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = (np.cumsum(sizes) - sizes)[text] + nth * lane
        early = np.minimum(nth * lane, warm)
        length = np.minimum(sizes[text] - nth * lane, lane) + early
        longest = np.argsort(-length, kind="stable")
        text, at, early, length = text[longest], (first - early)[longest], early[longest], length[longest]
        state = np.where((at == (np.cumsum(sizes) - sizes)[text]), self.start, 0).astype(np.int64)
        total = np.zeros(len(text))
        active = np.searchsorted(-length, -np.arange(1, (int(length[0]) if len(length) else 0) + 1), "right")
        for t, live in enumerate(active):
            lanes, symbol, weight = np.arange(live), self.symbols[at[:live] + t], np.zeros(live)
            while len(lanes):
                arc = self.arcs.find(state[lanes], symbol[lanes])
                hit = arc >= 0
                done = lanes[hit]
                weight[done] += self.weight[arc[hit]]
                state[done] = self.to[arc[hit]]
                lanes = lanes[~hit]
                stuck = state[lanes] == 0
                weight[lanes[stuck]] += self.unknown
                lanes = lanes[~stuck]
                weight[lanes] += self.back[state[lanes]]
                state[lanes] = self.fail[state[lanes]]
            total[:live] += np.where(early[:live] <= t, weight, 0.0)
        return np.bincount(text, total, len(sizes))


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences of six bytes where those suffice and are shorter."""
    gaps = np.diff(keys, prepend=keys[:1])
    if len(keys) > 4 and int(gaps.max()) < 1 << 48:
        return keys[:1].tobytes() + gaps.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    return keys.tobytes()


def _unpack_keys(data: bytes, n: int) -> np.ndarray:
    if len(data) == 8 * n:
        return np.frombuffer(data, np.uint64)
    gaps = np.zeros((n, 8), np.uint8)
    gaps[:, :6] = np.frombuffer(data, np.uint8, 6 * n, 8).reshape(n, 6)
    return np.frombuffer(data, np.uint64, 1)[0] + np.cumsum(gaps.reshape(-1).view(np.uint64), dtype=np.uint64)


def _pack_counts(counts: np.ndarray) -> bytes:
    """The width in bytes of the largest count, then the counts."""
    wide = next(w for w in (1, 2, 4, 8) if w == 8 or int(counts.max(initial=0)) < 1 << 8 * w)
    return bytes([wide]) + counts.astype(f"<u{wide}").tobytes()


def _unpack_counts(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, pa.Table]]:
    """(number, rows) of the blocks of a split: at least one text, closed when so many bytes are reached. Column 1 is the text."""
    from pyspark import TaskContext

    number, held, size = TaskContext.get().partitionId() << 24, [], 0
    for batch in batches:
        bytes_of = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        begin = 0
        for i, n in enumerate(bytes_of.tolist()):
            size += n + 1
            if size >= most:
                held.append(batch.slice(begin, i + 1 - begin))
                yield number, pa.Table.from_batches(held)
                number, begin, held, size = number + 1, i + 1, [], 0
        if begin < batch.num_rows:
            held.append(batch.slice(begin))
    if held:
        yield number, pa.Table.from_batches(held)


def _asks(block: Block, number: int, orders: tuple[int, ...], shards: int) -> Iterator[pa.RecordBatch]:
    """A block's distinct keys and training counts, a row for each shard that has any."""
    shift = np.uint64(64 - int(math.log2(shards)))
    for order in orders:
        at, by_key, heads, keys = block.asked(order)
        if not len(keys):
            continue
        counts = np.add.reduceat(block.learnt[at][by_key].astype(np.int64), heads)
        edges = np.append(np.flatnonzero(np.diff(keys >> shift, prepend=np.uint64(shards))), len(keys))
        for i in range(0, len(edges) - 1, 256):
            part = list(zip(edges[i : i + 256], edges[i + 1 : i + 257]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(keys[a] >> shift) for a, _ in part], pa.int64()), pa.array([number] * len(part), pa.int64()), pa.array([order] * len(part), pa.int32()),
                    pa.array([_pack_keys(keys[a:b]) for a, b in part], pa.binary()), pa.array([_pack_counts(counts[a:b]) for a, b in part], pa.binary()),
                ],
                ["shard", "block", "grams", "keys", "counts"],
            )
        del at, by_key, heads, keys, counts, part


ASK = "shard bigint, block bigint, grams int, keys binary, counts binary"
ANSWER = "shard bigint, block bigint, grams int, counts binary, total bigint, kinds bigint"


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard and order: each block's keys with the counts of all blocks, and sums of the unigrams."""

    def out(shard: int, order: int, rows: list) -> pa.RecordBatch:
        counts = [_unpack_counts(c) for _, _, c in rows]
        keys = np.concatenate([_unpack_keys(k, len(c)) for (_, k, _), c in zip(rows, counts)])
        by_key, heads = grouped(keys)
        totals = np.add.reduceat(np.concatenate(counts)[by_key], heads)
        answer = np.split(totals[numbered(by_key, heads)], np.cumsum([len(c) for c in counts])[:-1])
        made = [(shard, b, order, _pack_counts(a), 0, 0) for (b, _, _), a in zip(rows, answer)]
        if order == 1:
            made.append((shard, -1, 1, b"", int(totals.sum()), int((totals > 0).sum())))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), kinds)], [x.split()[0] for x in ANSWER.split(", ")])

    now, rows = None, []
    for batch in batches:
        for shard, block, order, keys, counts in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if rows and now != (shard, order):
                yield out(*now, rows)
                rows = []
                give_back()
            now = shard, order
            rows.append((block, keys, counts))
    if rows:
        yield out(*now, rows)
    give_back()


def _told(heard: pa.Table) -> dict[int, np.ndarray]:
    """Counts of each order from the answers of all shards, in key order."""
    out: dict[int, list] = {}
    for order, _, data in sorted(zip(*(heard.column(c).to_pylist() for c in ("grams", "shard", "counts"))), key=lambda r: r[:2]):
        out.setdefault(order, []).append(_unpack_counts(data))
    return {order: np.concatenate(parts) for order, parts in out.items()}


def scored(block: Block, answers: dict[int, np.ndarray], orders: tuple[int, ...], total: int, kinds: int, masses: tuple[float, ...], lane: int) -> list[np.ndarray]:
    """n_tokens, n_known, train_tokens, base_score and score of each text of a block. The answers are used up."""
    block.hear({n: answers.pop(n, np.zeros(0, np.int64)) for n in orders})
    firsts, sizes = block.ends - block.sizes + 1, block.sizes
    per = lambda x: np.add.reduceat(x, firsts)
    known = per((block.counts[1] > 0).astype(np.int64))
    base = per(np.log10((block.counts[1] + 1) / float(total + kinds + 1)))
    automaton = Automaton(block, total, kinds, masses)
    return [sizes, known, np.full(len(firsts), total, np.int64), base, automaton.traverse(sizes, lane)]


def score(docs: DataFrame, trains, masses: tuple[float, ...] = MASSES) -> DataFrame:
    """One row for each document. docs: (doc_id, text); trains: boolean column, true for documents to learn from.

    Columns: doc_id, n_tokens, n_known, train_tokens, base_score, score.
    """
    orders = tuple(range(1, len(masses) + 2))
    ship(docs.sparkSession)
    pin_splits(docs.sparkSession)
    docs = docs.select("doc_id", "text", F.coalesce(trains, F.lit(False)).alias("trains"))
    size = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    shards = 1 << max(4, math.ceil(math.log2(max(1, size / 6 * len(orders) / SHARD_KEYS))))
    tasks, most, lane = min(shards, MOST_TASKS), BLOCK_BYTES, LANE

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in _blocks(batches, most):
            yield from _asks(Block(rows.column(1), rows.column(2)), number, orders, shards)
            give_back()

    def name_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in _blocks(batches, most):
            for batch in rows.to_batches():
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, number))], ["doc_id", "text", "trains", "block"])

    asked = docs.mapInArrow(ask, ASK).repartitionById(tasks, F.pmod("shard", F.lit(tasks)).cast("int")).sortWithinPartitions("shard", "grams")
    answers = written(asked.mapInArrow(_answers, ANSWER))
    total, kinds = answers.where("block = -1").agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    blocks = docs.mapInArrow(name_blocks, "doc_id bigint, text string, trains boolean, block bigint").groupBy("block")
    to_blocks = answers.where("block >= 0").select("block", "shard", "grams", "counts").groupBy("block")

    def read(texts: pa.Table, heard: pa.Table) -> pa.Table:
        names, kind = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"], [pa.int64()] * 4 + [pa.float64()] * 2
        if not texts.num_rows:
            return pa.table([pa.array([], t) for t in kind], names)
        made = [texts.column("doc_id"), *scored(Block(texts.column("text"), texts.column("trains")), _told(heard), orders, total, kinds, masses, lane)]
        give_back()
        return pa.table([x if isinstance(x, pa.ChunkedArray) else pa.array(x, t) for x, t in zip(made, kind)], names)

    return blocks.cogroup(to_blocks).applyInArrow(read, "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def query(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text, learnt from all of the other folds."""
    out = score(docs, remainder(7) != 2)
    return out.select("doc_id", (remainder(7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
