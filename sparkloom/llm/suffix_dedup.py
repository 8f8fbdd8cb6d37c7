"""Suffix-array dedup: remove every byte that a repeated string of ``length`` bytes covers.

1. Each text is cut into content-defined stretches (see anchors); only windows whose stretches have equal cores can be
   equal. Stretches whose core occurs once are done, and so are cores around which all stretches are equal: copies are
   counted, not compared. So are those that one text holds several times (a line that it repeats): they make one row,
   with the symbols they cover.
2. Around the other cores, distinct stretches are gathered in shards by core and written one after the other, with the
   core (equal symbols by construction) as one symbol. A shard's suffix array is built by induced sorting: suffixes are
   classified, leftmost-smaller substrings sorted by induction and named, the named string is sorted recursively, and
   the whole array is induced from it in linear passes over the buckets. Permuted common prefixes are computed where
   they are irreducible and follow from the place before elsewhere. A window is repeated if its suffix shares the
   window's whole length with a neighbour in the array, or if its stretch occurs twice.
3. Repeated windows go back to their documents, whose bytes they cover are removed.

With ``words`` set, the same is done for strings of that many words (white space between them does not count): 400
bytes are about 62 words of English, so bytes alone leave repeated passages of 51 words in the text.

A core with over BUSY distinct stretches (a passage that very many texts quote) is no single group: its windows are
dealt by how many symbols they have before the core, in ranges of doubling size, and by the symbols that all windows
of a range have in common. Equal windows meet in one such group, and what a range does not reach is cut off, so that
stretches that differ only there are counted, not compared. Joins with the counts of keys that hold over a share of
1 / HEAVY of all rows (at most HEAVY keys) are broadcast.

Null texts count as empty: nothing removed, digest of no bytes. Texts are told apart by their place in the input, so
rows may repeat ids or have none. The input must give the same rows in the same order when read again (a table or a
checkpoint; its splits are pinned). Texts shorter than the length are never touched. Removed runs may cut a character:
see ``kept_text``. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.anchors import GRAM_WORDS, stretches, width_of, word_hashes, word_places, word_stretches
from sparkloom.llm.common import arrow_map, give_back, join_counted, pin_splits, ship, unused, written

LENGTH = 400
PASSAGE_WORDS = 51
#: Symbols that a shard should hold, shards that one task reads one after the other at most, and stretches of a core above which it is split.
SHARD_SYMBOLS, MOST_TASKS, BUSY = 400_000, 20_000, 4_000
#: Places of the array that are induced at once, where no bucket among them receives any.
STEP = 1024


def _dense(s: np.ndarray) -> np.ndarray:
    """The symbols numbered from 0 in their order, by counting where they are not far apart."""
    low = s - s.min()
    if low.max() > 8 * len(s) + 1000:
        return np.unique(s, return_inverse=True)[1].astype(np.int32)
    return (np.cumsum(np.bincount(low) > 0) - 1).astype(np.int32)[low]


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array (32 bits a place) of integers whose last one is smaller than all others, by induced sorting."""
    n = len(s)
    if n < 3:
        return np.argsort(s, kind="stable").astype(np.int32)
    s = _dense(s)
    sizes = np.bincount(s)
    tails = np.cumsum(sizes)
    heads = tails - sizes
    turn = np.minimum.accumulate(np.where(s[:-1] != s[1:], np.arange(n - 1, dtype=np.int32), np.int32(n))[::-1])[::-1]
    smaller = np.append(s[turn] < s[turn + 1], True)  # S-type
    del turn
    lms = np.flatnonzero(smaller & ~np.append(True, smaller[:-1])).astype(np.int32)

    counter, first_one = np.arange(n), np.ones(1, bool)

    def put(out: np.ndarray, at: np.ndarray, items: np.ndarray, sign: int) -> np.ndarray:
        """Append items to the buckets of their first symbols, upwards from the heads or downwards from the tails; where they went."""
        symbols = s[items]
        order = symbols.argsort(kind="stable")
        symbols, rank = symbols[order], counter[: len(items)]
        begins = np.where(np.concatenate([first_one, symbols[1:] != symbols[:-1]]), rank, 0)
        rank = rank - np.maximum.accumulate(begins)
        if sign > 0:
            places = at[symbols] + rank
            at[symbols] = places + 1  # of repeated symbols the last one stays
        else:
            places = at[symbols] - 1 - rank
            at[symbols] = places
        out[places] = items[order]
        return places

    def before(some: np.ndarray, of_smaller: bool) -> np.ndarray:
        """The suffixes one place before those of a stretch of the array, of one type, in turn."""
        some = some[some > 0] - 1
        return some[smaller[some] == of_smaller]

    def upwards(out: np.ndarray, low: np.ndarray, starts: np.ndarray) -> None:
        """Larger suffixes from the left: buckets a STEP of places at a time, as far as none of them is given a suffix."""
        c, end = 0, len(sizes)
        while c < end:
            e = max(c + 1, int(np.searchsorted(tails, heads[c] + STEP, "right")))
            some = before(out[heads[c] : tails[e - 1]], False)
            least = int(s[some].min()) if len(some) else e
            if least > c:
                if least < e:
                    e, some = least, before(out[heads[c] : heads[least]], False)
                if len(some):
                    put(out, low, some, 1)
                c = e
                continue
            done = heads[c]  # the bucket gives to itself
            while done < low[c]:
                some, done = before(out[done : low[c]], False), low[c]
                if len(some):
                    put(out, low, some, 1)
            some = before(out[starts[c] : tails[c]], False)
            if len(some):
                put(out, low, some, 1)
            c += 1

    def downwards(out: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Smaller suffixes from the right, in the same way."""
        c = len(sizes) - 1
        while c >= 0:
            e = min(c - 1, int(np.searchsorted(heads, tails[c] - STEP, "left")) - 1)
            some = before(out[heads[e + 1] : tails[c]][::-1], True)
            most = int(s[some].max()) if len(some) else e
            if most < c:
                if most > e:
                    e, some = most, before(out[tails[most] : tails[c]][::-1], True)
                if len(some):
                    put(out, high, some, -1)
                c = e
                continue
            done = tails[c]
            while done > high[c]:
                some, done = before(out[high[c] : done][::-1], True), high[c]
                if len(some):
                    put(out, high, some, -1)
            some = before(out[heads[c] : low[c]][::-1], True)
            if len(some):
                put(out, high, some, -1)
            c -= 1

    def induce(sorted_lms: np.ndarray) -> np.ndarray:
        out, low, high = np.full(n, -1, np.int32), heads.copy(), tails.copy()
        given = put(out, high, sorted_lms[::-1], -1)
        upwards(out, low, high)
        out[given] = -1
        downwards(out, low, tails.copy())
        out[0] = n - 1
        return out

    first = induce(lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = first[is_lms[first]]
    del first, is_lms
    end = np.zeros(n, np.int32)
    end[lms[:-1]], end[lms[-1]] = lms[1:], n - 1
    a, b = order[:-1], order[1:]
    same = end[a] - a == end[b] - b
    same[0:1] = False
    lengths = (end[a] - a + 1)[same]
    if len(lengths):
        begin = np.cumsum(lengths) - lengths
        step = np.arange(lengths.sum(), dtype=np.int32) - np.repeat(begin.astype(np.int32), lengths)
        same[same] = np.logical_and.reduceat(s[np.repeat(a[same], lengths) + step] == s[np.repeat(b[same], lengths) + step], begin)
    names = np.zeros(n, np.int32)
    names[order] = np.append(0, np.cumsum(~same))
    named = names[lms]
    del names, end, a, b, same, lengths
    if int(named.max()) + 1 < len(lms):
        order = lms[suffix_array(named)]
    return induce(order)


def common_prefixes(s: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place, the length its suffix shares with the suffix before it in the array (permuted common prefixes)."""
    n = len(s)
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    i = np.arange(n, dtype=np.int32)
    own = (i == 0) | (before <= 0)
    own[1:] |= s[i[1:] - 1] != s[before[1:] - 1]
    at = np.flatnonzero(own)
    length = np.zeros(n, np.int32)
    live = at[before[at] >= 0]
    while len(live):
        x, y = live + length[live], before[live] + length[live]
        live, x, y = (v[(x < n) & (y < n)] for v in (live, x, y))
        live = live[s[x] == s[y]]
        length[live] += 1
    last = np.maximum.accumulate(np.where(own, i, 0))
    return np.maximum(length[last] - (i - last), 0)


def repeated(shard: pa.Table, width: int, kind: str) -> pa.RecordBatch | None:
    """(node, piece, n, row, start, unit, runs) of a shard's entries that have repeated windows and are asked for: runs of windows (first, last, first, ...).

    An entry is a stretch, or the part of one that windows of a range reach: the symbols before and after its core.
    Stretches that occur twice (row null) are not asked for: all of their windows are repeated.
    """
    sides = [shard.column(c).combine_chunks() for c in ("before", "after")]
    flat = np.frombuffer(b"".join(x for pair in zip(*(s.to_pylist() for s in sides)) for x in pair), kind)
    symbols, wide = (np.unique(flat, return_inverse=True)[1] if flat.itemsize > 1 else flat).astype(np.int32) + 2, flat.itemsize
    node = shard.column("node").to_numpy()
    sizes = np.ones((len(node), 4), np.int64)  # before, core, after, end
    for k, side in zip((0, 2), sides):
        sizes[:, k] = pc.binary_length(side).to_numpy() // wide
    ends = np.cumsum(sizes.sum(axis=1))
    place = ends - sizes.sum(axis=1)
    s = np.zeros(ends[-1] + 1, np.int32)
    s[:-1][np.repeat(np.tile([True, False, True, False], len(node)), sizes.reshape(-1))] = symbols
    s[place + sizes[:, 0]] = (int(symbols.max()) if len(symbols) else 1) + 1 + np.unique(node, return_inverse=True)[1]
    s[ends - 1] = 1
    del flat, symbols
    order = suffix_array(s)
    longest = common_prefixes(s, order)
    longest[order[:-1]] = np.maximum(longest[order[:-1]], longest[order[1:]])
    windows = sizes[:, 0] + sizes[:, 2] - width + 1
    first = np.cumsum(windows) - windows
    within = np.arange(windows.sum()) - np.repeat(first, windows)
    count = shard.column("count").to_numpy()
    hit = (longest[np.repeat(place, windows) + within] >= width + 1) | np.repeat(count > 1, windows)  # a width around the core's one symbol
    edge = np.concatenate([[True], hit[1:] != hit[:-1], [True]])
    edge[first] = True
    begin = np.flatnonzero(edge[:-1])
    stop = np.append(begin[1:], len(hit)) - 1
    asked = shard.column("row").combine_chunks().is_valid().to_numpy(zero_copy_only=False) | (shard.column("n").to_numpy() > 0)
    owner = np.searchsorted(first, begin, "right") - 1
    good = hit[begin] & asked[owner]
    begin, stop, owner = begin[good], stop[good], owner[good]
    some, many = np.unique(owner, return_counts=True)
    if not len(some):
        return None
    runs = np.stack([within[begin], within[stop]], axis=1).reshape(-1).astype(np.int32)
    offsets = np.append(0, np.cumsum(2 * many)).astype(np.int32)
    take = lambda c: shard.column(c).combine_chunks().take(pa.array(some))
    names = ["node", "piece", "n", "row", "start", "unit"]
    return pa.RecordBatch.from_arrays([*map(take, names), pa.ListArray.from_arrays(pa.array(offsets), pa.array(runs))], [*names, "runs"])


def own_copies(owner: np.ndarray, start: np.ndarray, size: np.ndarray, lead: np.ndarray, core: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.ListArray]:
    """The distinct stretches of each owner, in turn: where they come first, how often, and, of those that come again, the symbols covered (from, to, ...)."""
    order = np.lexsort((content, core, owner))
    fresh = np.ones(len(order), bool)
    fresh[1:] = np.logical_or.reduce([x[order[1:]] != x[order[:-1]] for x in (owner, core, content)])
    heads = np.flatnonzero(fresh)
    times = np.diff(np.append(heads, len(order)))
    turn = np.argsort(order[heads])
    heads, times = heads[turn], times[turn]
    again = np.flatnonzero(times > 1)
    covered = [merge(np.stack([start[at], start[at] + size[at]], axis=1)) for at in (order[h : h + n] for h, n in zip(heads[again], times[again]))]
    lengths = np.zeros(len(heads), np.int64)
    lengths[again] = [len(x) for x in covered]
    offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
    values = np.concatenate(covered) if covered else np.zeros(0, np.int32)
    return order[heads], times, pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=pa.array(times == 1))


def parts_of(before: bytes, after: bytes, lead: int, tail: int, width: int, wide: int) -> Iterator[tuple[bytes, bytes, bytes, int]]:
    """(symbols that all windows of a range have, symbols before, after, first window) for the ranges of a stretch of a busy core.

    A range: windows with 0, 1, 2 to 3, 4 to 7, ... symbols before the core. lead, tail: symbols before and after it.
    """
    low, high = 0, 0
    while low <= width:
        b, a = min(high, lead), min(width - low, tail)
        if lead >= low and a + b >= width:
            left, right = before[len(before) - b * wide :], after[: a * wide]
            yield b"%d:" % low + left[len(left) - low * wide :] + b":" + right[: (width - high) * wide], left, right, lead - b
        low, high = high + 1, min(width, 2 * high + 1)


def spans(docs: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """(row, spans, word_spans): bytes [from, to, from, to, ...] to remove, and words, sorted and apart, of rows that have any.

    docs: (row, text) with row the place in the input. word_spans are ranges of words that strings of ``words`` words cover.
    """
    spark = docs.sparkSession
    ship(spark)
    units = [(length, width_of(length), 1), (words, width_of(words, GRAM_WORDS), 8)] if words else [(length, width_of(length), 1)]

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = text.as_py().encode("utf-8", "surrogatepass")
            for unit, (size, _, _) in enumerate(units):
                found.append((row, unit, word_stretches(word_hashes(data), size) if unit else stretches(data, size)))
        owner = np.repeat(np.arange(len(found)), [len(x[0]) for _, _, x in found])
        columns = [np.concatenate([x[k] for _, _, x in found]) if found else np.zeros(0, np.int64) for k in range(5)]
        first, times, places = own_copies(owner, *columns)
        rows, kinds = (np.array([f[k] for f in found], t)[owner[first]] for k, t in ((0, np.int64), (1, np.int8)))
        columns = [c[first] for c in columns]
        return pa.RecordBatch.from_arrays([pa.array(rows), pa.array(kinds), *[pa.array(c.astype(np.int32)) for c in columns[:3]], *[pa.array(c.view(np.int64)) for c in columns[3:]], pa.array(times.astype(np.int32)), places], ["row", "unit", "start", "size", "lead", "core", "content", "times", "places"])

    least = min(length, 2 * words - 1) if words else length
    parts = written(arrow_map(docs.where(F.octet_length("text") >= least).select("row", "text"), cut, "row bigint, unit tinyint, start int, size int, lead int, core bigint, content bigint, times int, places array<int>"))
    kinds = written(parts.groupBy("core").agg(F.count("*").alias("n"), F.min("content").alias("a"), F.max("content").alias("b"), F.sum("times").alias("all")).where("all > 1").select("core", "n", (F.col("a") == F.col("b")).alias("alike")))
    hits = written(join_counted(parts, kinds, ["core"], "n"))
    variants = written(hits.where("not alike").groupBy("core", "content").agg(F.sum("times").alias("count"), F.count("*").alias("n"), F.min(F.struct("row", "unit", "start", "size", "lead")).alias("at")))
    busy = written(variants.groupBy("core").agg(F.count("*").alias("kinds")).where(F.col("kinds") > BUSY).select("core"))
    split = not busy.isEmpty()
    marked = variants.withColumn("busy", F.lit(False))
    if split:  # few rows, so each goes to all salts of its core's stretches
        salted = busy.select("core", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(63).cast("bigint"))).alias("salt"), F.lit(True).alias("busy"))
        marked = variants.withColumn("salt", F.pmod("content", F.lit(64))).join(salted, ["core", "salt"], "left").drop("salt").withColumn("busy", F.coalesce("busy", F.lit(False)))
    wanted = marked.groupBy("at.row").agg(F.collect_list(F.struct("core", "content", "count", "busy", "at.unit", "at.start", "at.size", "at.lead")).alias("all"))
    schema = "unit tinyint, busy boolean, row bigint, start int, node bigint, piece bigint, count bigint, before binary, after binary"

    def sides(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        signed = lambda data: xxhash.xxh3_64_intdigest(data) - (1 << 63)
        for row, text, all_of in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            data = text.as_py().encode("utf-8", "surrogatepass")
            as_words = None
            for v in all_of.as_py():
                size, width, wide = units[v["unit"]]
                if v["unit"] and as_words is None:
                    as_words = word_hashes(data).tobytes()
                symbols, core = as_words if v["unit"] else data, v["start"] + v["lead"]
                before, after = symbols[v["start"] * wide : core * wide], symbols[(core + size - width) * wide : (v["start"] + v["size"]) * wide]
                of = v["unit"], v["busy"], row if v["count"] == 1 else None  # one that occurs once is here; one that occurs twice is repeated anyway
                if not v["busy"]:
                    out.append((*of, v["start"], v["core"], v["content"], v["count"], before, after))
                    continue
                for common, left, right, shift in parts_of(before, after, v["lead"], v["size"] - v["lead"] - size + width, width, wide):
                    out.append((*of, v["start"] + shift, signed(b"%d:" % v["core"] + common), signed(left + b":%d:" % len(left) + right), v["count"], left, right))
        kinds = [pa.int8(), pa.bool_(), pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)], [x.split()[0] for x in schema.split(", ")])

    texts = written(arrow_map(docs.join(wanted, "row").select("row", "text", "all"), sides, schema))
    columns = ["unit", "row", "start", "node", "piece", "count", "n", "before", "after"]
    entries = texts.where("not busy").withColumn("n", F.lit(0).cast("bigint")).select(*columns)  # n: stretches that share an entry of a busy core
    if split:
        entries = entries.union(texts.where("busy").groupBy("node", "piece").agg(F.first("unit").alias("unit"), F.lit(None).cast("bigint").alias("row"), F.lit(0).alias("start"), F.sum("count").alias("count"), F.count("*").alias("n"), F.first("before").alias("before"), F.first("after").alias("after")).select(*columns))
        entries = written(entries)
    symbols = entries.agg(F.sum((F.octet_length("before") + F.octet_length("after")) / F.when(F.col("unit") == 0, 1).otherwise(8) + 2)).first()[0] or 0
    shards = max(6, int(symbols) // SHARD_SYMBOLS + 1)
    tasks = 2 * min(shards, MOST_TASKS)
    number = (F.pmod(F.xxhash64("node"), F.lit(shards)) * 2 + F.col("unit")).cast("bigint")
    dealt = entries.withColumn("shard", number).repartitionById(tasks, F.pmod("shard", F.lit(tasks)).cast("int")).sortWithinPartitions("shard")

    def sort_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = [], None

        def out():
            table = pa.Table.from_batches(held)
            held.clear()
            unit = shard & 1
            made = repeated(table, units[unit][1], "<u8" if unit else "u1")
            del table
            give_back()
            return made

        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("shard")).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                if held and ids[begin] != shard and (found := out()) is not None:
                    yield found
                shard = int(ids[begin])
                held.append(batch.slice(begin, end - begin))
        if held and (found := out()) is not None:
            yield found

    runs = dealt.mapInArrow(sort_shards, "node bigint, piece bigint, n bigint, row bigint, start int, unit tinyint, runs array<int>")
    lengths = F.when(F.col("unit") == 0, length).otherwise(words or 0)
    shifted = F.transform("runs", lambda x, i: F.when(i % 2 == 0, x + F.col("start")).otherwise(x + F.col("start") + lengths)).alias("r")
    if split:
        runs = written(runs)
    some = runs.where("n = 0").select("row", "unit", shifted)
    if split:
        of = texts.where("busy and row is not null").select("row", "unit", "start", "node", "piece")
        some = some.union(join_counted(of, runs.where("n > 0").select("node", "piece", "n", "runs"), ["node", "piece"], "n").select("row", "unit", shifted))
    twice = join_counted(hits.where("not alike"), variants.where("count > 1").select("core", "content", "n"), ["core", "content"], "n")
    placed = F.coalesce("places", F.array("start", F.col("start") + F.col("size"))).alias("r")
    whole = hits.where("alike").select("row", "unit", placed).union(twice.select("row", "unit", placed))
    of_unit = lambda k: F.flatten(F.collect_list(F.when(F.col("unit") == k, F.col("r"))))
    gathered = whole.union(some).groupBy("row").agg(of_unit(0).alias("r"), of_unit(1).alias("w"))

    def merged(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [[merge(np.asarray(x.values)) for x in batch.column(k)] for k in (1, 2)]
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, pa.list_(pa.int32())) for x in out]], ["row", "spans", "word_spans"])

    return arrow_map(gathered, merged, "row bigint, spans array<int>, word_spans array<int>")


def merge(ranges) -> np.ndarray:
    """Ranges [from, to, from, to, ...] sorted, with those that meet or overlap joined."""
    x = np.asarray(ranges, np.int64).reshape(-1, 2)
    if not len(x):
        return x.reshape(-1).astype(np.int32)
    x = x[np.argsort(x[:, 0], kind="stable")]
    reach = np.maximum.accumulate(x[:, 1])
    fresh = np.flatnonzero(np.append(True, x[1:, 0] > reach[:-1]))
    return np.stack([x[fresh, 0], reach[np.append(fresh[1:], len(x)) - 1]], axis=1).reshape(-1).astype(np.int32)


def with_words(data: bytes, removed: list[int], words: list[int]) -> list[int]:
    """The byte ranges to remove, and those of ranges of words, joined."""
    if not words:
        return removed
    begin, end = word_places(data)
    w = np.asarray(words).reshape(-1, 2)
    return merge(np.concatenate([np.asarray(removed, np.int64), np.stack([begin[w[:, 0]], end[w[:, 1] - 1]], axis=1).reshape(-1)])).tolist()


def kept_bytes(data: bytes, removed: list[int]) -> bytes:
    at, out = 0, []
    for begin, end in zip(removed[::2], removed[1::2]):
        out.append(data[at:begin])
        at = end
    return b"".join([*out, data[at:]])


def kept_text(data: bytes, removed: list[int]) -> str:
    """What is left as text; a character that a cut goes through is dropped."""
    return kept_bytes(data, removed).decode("utf-8", "ignore")


def with_spans(docs: DataFrame, length: int = LENGTH, words: int | None = None) -> tuple[DataFrame, list[str]]:
    """docs, all columns, with two more: byte and word ranges to remove (null where there are none), and their names."""
    pin_splits(docs.sparkSession)
    row, *names = (unused(n, docs.columns) for n in ("row", "spans", "word_spans"))
    rows = docs.withColumn(row, F.monotonically_increasing_id())
    found = spans(rows.select(F.col(row).alias("row"), "text"), length, words).toDF(row, *names)
    return rows.join(found, row, "left").drop(row), names


def query(docs: DataFrame, length: int = LENGTH, words: int = PASSAGE_WORDS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, by strings of ``length`` bytes.

    n_repeated counts the bytes that those strings or repeated strings of ``words`` words cover.
    """

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        out, size = [], lambda r: sum(r[1::2]) - sum(r[::2])
        for text, r, w in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            data, r = (text.as_py() or "").encode("utf-8", "surrogatepass"), r or []
            out.append((len(data), size(r), len(r) // 2, hashlib.sha256(kept_bytes(data, r)).hexdigest(), size(with_words(data, r, w or []))))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated"])

    found, names = with_spans(docs.select("doc_id", "text"), length, words)
    return arrow_map(found.select("doc_id", "text", *names), each, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, n_repeated bigint")


def keep(docs: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """The documents, all columns, with repeated bytes (and strings of so many words) removed from text (null stays null) and n_chars, if there, counted anew."""
    names = docs.columns

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, texts = names.index("text"), []
        for text, r, w in zip(batch.column(at), batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist()):
            text = text.as_py()
            if r or w:
                data = text.encode("utf-8", "surrogatepass")
                text = kept_text(data, with_words(data, r or [], w or []))
            texts.append(text)
        arrays = list(batch.columns[:-2])
        arrays[at] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays(arrays, names)

    found, added = with_spans(docs, length, words)
    changed = arrow_map(found.select(*names, *added), each, docs.schema)
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*names) if "n_chars" in names else changed
