"""SimHash near-dedup: a byte-position inverted index with count filtering.

Fingerprints within 3 bits differ in at most 3 of their 8 bytes, so they share at least 5 positional bytes. Of any 5 of
8 positions at least 3 lie in the first or the last four; the index therefore posts a fingerprint under the 8 triples
of positions inside a half, 24 bits each, instead of under single bytes, whose lists would grow with a 256th of the
table. A list of over MOST_POSTED fingerprints is cut by two more bytes, in all ten choices of the other five. For
fingerprints that meet in a list the shared positional bytes are tallied; pairs under the guaranteed 5 go, and the rest
are verified by their differing bits.

A link of 3 bits needs texts that are all but equal: at a Jaccard similarity of 0.8 of the shingles about 10 of 64 bits
differ. With ``similarity`` set, candidates are texts linked by fingerprints or by a signature of POSITIONS bytes, each
the last byte of a min-wise hash, of which a pair shares about the similarity's share. The index is the same: a text is
posted under QUADS groups of four positional bytes, texts that meet in a list are tallied over all positions and are
candidates if they share at least the share of similarity - MARGIN. A pair at exactly 0.8 shares 102 of 128 bytes give or
take 4.5 and needs 80; it meets in no list once in 10 million times. Then the components of candidates are compared
inside, and pairs link by the exact similarity of their shingles alone. How groups of any size are compared without
gathering them or expanding their pairs: see links_inside.

Copies are one entry: the index holds distinct fingerprints. Nulls and texts without words have fingerprint zero and
link like any other (by similarity: with each other). Rows that repeat a doc_id share its component; a null doc_id is
no member of a component and gets its fingerprint's (by similarity it is a member, and last of its group). An empty
table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import arrow_map, give_back, join_counted, pin_splits, unused, words_of, written
from sparkloom.llm.components import Forest, components
from sparkloom.llm.tokens import runs_of, words_of_texts

SEED = 42
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]
CHUNK = 1 << 16
POSITIONS, QUADS, MARGIN, CHUNK_ROWS, CHUNK_BYTES, SALTS = 128, 32, 0.18, 1000, 4_000_000, 16
#: Fingerprints that a list of three bytes may hold; beyond, it is cut by two bytes more.
MOST_POSTED = 500


def votes_of(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set, lowest first."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), CHUNK):
        total += np.unpackbits(hashes[i : i + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of a text as a signed 64-bit integer: bit set if set in over half of its shingles' XXH64."""
    hashes = _hashes_of(text, shingle)
    bits = (votes_of(hashes) * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp bigint) of every whole text."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], pa.int64())], ["doc_id", "fp"])

    return arrow_map(docs.select("doc_id", "text"), each, "doc_id bigint, fp bigint")


def _byte(value: Column, i: int) -> Column:
    return F.shiftrightunsigned(value, 8 * i).bitwiseAND(F.lit(255))


def near_pairs(entries: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs (u, v) of ids whose distinct fingerprints differ in 1 to radius (at most 3) bits. entries: (id, fp), one row for each fp."""
    pairs = tallied(entries, radius).where(F.bit_count("x") <= radius)  # verify
    return pairs.select("u", "v").distinct()


def _list_key(positions: tuple[int, ...]) -> Column:
    return sum((F.shiftleft(_byte(F.col("fp"), p), 8 * i) for i, p in enumerate(positions)), F.lit(0).cast("bigint"))


def tallied(entries: DataFrame, radius: int = 3) -> DataFrame:
    """(u, v, x, shared) of fingerprints that meet in a list and share the guaranteed number of positional bytes; x: the bits that differ.

    A pair that meets in several lists comes several times.
    """
    if not 0 <= radius <= 3:
        raise ValueError("the index guarantees 5 shared bytes for up to 3 bits")
    post = lambda lists, *more: F.explode(F.array(*[F.struct(F.lit(k).cast("int").alias("list"), *more, _list_key(t).alias("at")) for k, t in lists]))
    posted = entries.select("id", "fp", post(enumerate(TRIPLES)).alias("p")).select("id", "fp", "p.list", "p.at")
    lists = written(posted.groupBy("list", "at").agg(F.count("*").alias("n")).where("n > 1"))
    short = join_counted(posted, lists.where(F.col("n") <= MOST_POSTED), ["list", "at"], "n")
    long = lists.where(F.col("n") > MOST_POSTED)
    if not long.isEmpty():
        # a pair of a triple's list shares two of the other five bytes as well: so many lists, 16 bits longer each
        again = join_counted(posted, long, ["list", "at"], "n").withColumnRenamed("at", "above")
        deeper = [(100 + 28 * k + i, k, pair) for k, t in enumerate(TRIPLES) for i, pair in enumerate(combinations([p for p in range(8) if p not in t], 2))]
        sub = F.explode(F.filter(F.array(*[F.struct(F.lit(n).alias("list"), F.lit(k).alias("of"), _list_key(pair).alias("at")) for n, k, pair in deeper]), lambda s: s["of"] == F.col("list")))
        again = again.select("id", "fp", "above", sub.alias("p")).select("id", "fp", "p.list", (F.col("above") * (1 << 16) + F.col("p.at")).alias("at"))
        short = short.unionByName(again)
    a, b = short.alias("a"), short.alias("b")
    met = a.join(b, (F.col("a.list") == F.col("b.list")) & (F.col("a.at") == F.col("b.at")) & (F.col("a.fp") < F.col("b.fp")))
    met = met.select(F.col("a.id").alias("u"), F.col("b.id").alias("v"), F.col("a.fp").bitwiseXOR(F.col("b.fp")).alias("x"))
    shared = sum(((_byte(F.col("x"), i) == 0).cast("int") for i in range(8)), F.lit(0))  # the tally of shared positional bytes
    return met.withColumn("shared", shared).where(F.col("shared") >= 8 - radius)


def _hashes_of(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of each shingle of a text, repeats included."""
    import xxhash

    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)])) if len(words) >= shingle else [b" ".join(words)]
    return np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64)


def signature(hashes: np.ndarray) -> bytes:
    """The last bytes of POSITIONS min-wise hashes of the set of shingles."""
    rng = np.random.default_rng(SEED)
    odd, add = (rng.integers(0, 1 << 63, POSITIONS, dtype=np.uint64) for _ in range(2))
    odd = odd * np.uint64(2) + np.uint64(1)
    least, hashes = np.full(POSITIONS, np.iinfo(np.uint64).max, np.uint64), np.unique(hashes)
    for i in range(0, len(hashes), 2048):
        x = (hashes[i : i + 2048, None] ^ add) * odd
        least = np.minimum(least, (x ^ (x >> np.uint64(32))).min(axis=0))
    return ((least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.uint8).tobytes()


def shingles_of(texts: pa.Array, shingle: int):
    """Hashes of the word shingles of each text in turn, repeats included; a text of fewer words is one shingle."""
    words, counts = words_of_texts(t.as_py() for t in texts)
    at = 0
    for n in counts.tolist():
        of = words[at : at + n]
        at += n
        yield runs_of(of, min(shingle, n)) if n else of


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """(row, doc_id, fp, sig, grams) of every whole text of docs (row, doc_id, text).

    grams is a digest of the set of shingles; sig is null for texts without words, which are near no other.
    """
    import xxhash

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        bits, sigs, sets = [], [], []
        for h in shingles_of(batch.column(2), shingle):
            bits.append(np.packbits((votes_of(h) * 2 > len(h)).astype(np.uint8), bitorder="little").view("<i8")[0])
            sigs.append(signature(h) if len(h) else None)
            sets.append(xxhash.xxh3_128_digest(np.unique(h).tobytes()))
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(bits, pa.int64()), pa.array(sigs, pa.binary()), pa.array(sets, pa.binary())], ["row", "doc_id", "fp", "sig", "grams"])

    return arrow_map(docs.select("row", "doc_id", "text"), each, "row bigint, doc_id bigint, fp bigint, sig binary, grams binary")


def is_similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether the Jaccard similarity of two sets, each sorted, reaches the given one."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)) - 1e-9:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


class Side:
    """The texts of a chunk: ids, signatures as a matrix, and sets of shingles where they travel."""

    def __init__(self, rows: pa.StructArray):
        self.ids = rows.field("id").to_pylist()
        self.sigs = np.frombuffer(b"".join(s.as_py() for s in rows.field("sig")), np.uint8).reshape(-1, POSITIONS)
        self.sets = [np.frombuffer(g.as_py(), np.uint64) if g.is_valid else None for g in rows.field("grams")]

    def alike(self, i: int, other: Side, after: int, need: int, similarity: float | None, out: Forest | None = None) -> list[int]:
        """Places from after on of the other side's texts that text i is linked with; those that out has tied already are left out."""
        near = np.flatnonzero((other.sigs[after:] == self.sigs[i]).sum(axis=1) >= need) + after
        return [j for j in near.tolist() if (out is None or out.root(self.ids[i]) != out.root(other.ids[j])) and (similarity is None or is_similar(self.sets[i], other.sets[j], similarity))]


ROWS = "array<struct<id:bigint,sig:binary,grams:binary>>"


def _compared(need: int, similarity: float | None):
    """Forests over the links of pairs of chunks (a, b), or inside chunks (a, null)."""

    def over(batches):
        for batch in batches:
            out = Forest()
            for a, b in zip(*batch.columns):  # one pair of chunks at a time
                x = Side(a.values)
                y = Side(b.values) if b.is_valid else x
                for i, u in enumerate(x.ids):
                    for j in x.alike(i, y, 0 if b.is_valid else i + 1, need, similarity, out):
                        out.join(u, y.ids[j])
            if out.up:
                nodes = list(out.up)
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([out.root(n) for n in nodes], pa.int64())], ["u", "v"])
            del out
            give_back()

    return over


def links_inside(members: DataFrame, texts: DataFrame, similarity: float, exact: bool) -> DataFrame:
    """(u, v): a forest over the links inside groups: members (g bigint, id), any number of one g; texts (id, sig, grams).

    Linked are texts whose signatures share the share of similarity - MARGIN and, if exact, whose sets of shingles have
    the similarity. A group of over a chunk is compared with its pivot, the text nearest to the most frequent bytes of
    one of its chunks: what is linked with the pivot is in one class; only the rest is compared with all of the group,
    chunk with chunk. So a group of near copies costs its size, not its square.
    """
    need, limit = int(np.ceil(POSITIONS * (similarity - MARGIN))), similarity if exact else None
    sizes = written(members.groupBy("g").agg(F.count("*").alias("n")).where("n > 1"))
    bytes_of = F.coalesce(F.octet_length("grams"), F.lit(0)).cast("bigint")
    of_group = lambda n, size: F.ceil(F.greatest(n / CHUNK_ROWS, size / CHUNK_BYTES))

    def chunked(rows: DataFrame) -> DataFrame:
        """rows (g, id, sig, grams, chunks) dealt to chunks: (g, chunk, chunks, rows)."""
        dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")))
        return written(dealt.groupBy("g", "chunk", "chunks").agg(F.sort_array(F.collect_list(F.struct("id", "sig", "grams"))).alias("rows")))

    rows = join_counted(members.select("g", "id"), sizes.withColumn("chunks", F.ceil(F.col("n") / CHUNK_ROWS)), ["g"], "n").join(texts, "id")
    if exact:  # sets of any size: chunks are bounded in bytes as well
        rows = written(rows.drop("chunks"))
        heavy = written(rows.groupBy("g").agg(F.count("*").alias("n"), F.sum(bytes_of).alias("bytes")).select("g", "n", of_group(F.col("n"), F.col("bytes")).alias("chunks")))
        rows = join_counted(rows, heavy, ["g"], "n")
    chunks = chunked(rows)
    links = chunks.where("chunks = 1").select(F.col("rows").alias("a"), F.lit(None).cast(ROWS).alias("b")).mapInArrow(_compared(need, limit), "u bigint, v bigint")
    large = chunks.where("chunks > 1")
    if large.isEmpty():
        return links

    def pivots(batches):
        for batch in batches:
            best = []
            for rows in batch.column(1):
                sigs = Side(rows.values).sigs
                frequent = np.array([np.bincount(column, minlength=256).argmax() for column in sigs.T])
                best.append(rows.values[int((sigs == frequent).sum(axis=1).argmax())].as_py())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([[x] for x in best], batch.column(1).type)], ["g", "pivot"])

    chosen = written(large.groupBy("g").agg(F.min_by("rows", "chunk").alias("rows")).mapInArrow(pivots, f"g bigint, pivot {ROWS}"))

    def apart(batches):
        for batch in batches:
            tied, first, rest = [], [], []
            for rows, pivot in zip(batch.column(1), batch.column(2)):
                x, p = Side(rows.values), Side(pivot.values)
                near = p.alike(0, x, 0, need, limit)
                tied.append([x.ids[j] for j in near])
                first.append(p.ids[0])
                rest.append(rows.values.take(pa.array(np.setdiff1d(np.arange(len(x.ids)), near), pa.int64())))
            sizes = np.cumsum([0, *map(len, rest)])
            rows = pa.concat_arrays(rest)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tied, pa.list_(pa.int64())), pa.array(first, pa.int64()), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), rows)], ["g", "tied", "pivot", "rest"])

    parted = written(large.join(chosen, "g").select("g", "rows", "pivot").mapInArrow(apart, f"g bigint, tied array<bigint>, pivot bigint, rest {ROWS}"))
    links = links.union(parted.select(F.explode("tied").alias("u"), F.col("pivot").alias("v")).where("u <> v"))
    left = parted.select("g", F.explode("rest").alias("r")).select("g", "r.*")
    again = written(left.groupBy("g").agg(F.count("*").alias("n"), F.sum(bytes_of).alias("bytes")).select("g", "n", of_group(F.col("n"), F.col("bytes")).alias("chunks")))
    if again.isEmpty():
        return links
    salts = F.lit(SALTS).cast("bigint")
    rest = chunked(join_counted(left, again, ["g"], "n")).select("g", F.col("rows").alias("a"), F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)).alias("salt"))
    pairs = rest.join(large.select("g", F.col("rows").alias("b"), F.pmod("chunk", salts).alias("salt")), ["g", "salt"]).select("a", "b")
    return links.union(pairs.mapInArrow(_compared(need, limit), "u bigint, v bigint"))


def similar_pairs(entries: DataFrame, similarity: float) -> DataFrame:
    """(u, v): a forest over candidates among entries (id, sig), one row for each sig: they meet in a list and share enough positions."""
    quads = F.explode(F.array(*[F.xxhash64(F.lit(k), F.substring("sig", 4 * k + 1, 4)) for k in range(QUADS)]))
    return links_inside(entries.select(quads.alias("g"), "id"), entries.select("id", "sig", F.lit(None).cast("binary").alias("grams")), similarity, exact=False)


def verified_pairs(rows: DataFrame, entries: DataFrame, linked: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(u, v): a forest over the pairs of entries (id, sig) in one component of linked whose shingles are similar.

    rows: (row, text), where an entry's id is the row of its text. Only texts of candidate components travel.
    """

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams = pa.array([np.unique(h).tobytes() for h in shingles_of(batch.column(2), shingle)], pa.binary())
        return pa.RecordBatch.from_arrays([*batch.columns[:2], grams], ["id", "sig", "grams"])

    members = written(entries.where("sig is not null").select("id", "sig").join(linked, F.col("id") == F.col("node")).select("component", "id", "sig"))
    texts = arrow_map(members.join(rows, F.col("id") == F.col("row")).select("id", "sig", "text"), each, "id bigint, sig binary, grams binary")
    return links_inside(members.select(F.col("component").alias("g"), "id"), texts, similarity, exact=True)


def _similar_entries(rows: DataFrame, radius: int, shingle: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id, fp, grams) of rows (row, doc_id, text), and their entries (fp, grams, least, n, top).

    Texts with equal shingles and fingerprint are one entry, named by one of its rows; top is the entry that names the
    component, least the entry's row of smallest doc_id (null last).
    """
    of = written(signatures(rows, shingle))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("least")
    entries = written(of.groupBy("fp", "grams").agg(F.first("sig").alias("sig"), F.min("row").alias("id"), least, F.count("*").alias("n")))
    reps = entries.groupBy("fp").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    sigs = entries.where("sig is not null").groupBy("sig").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    reps, sigs = written(reps), written(sigs)
    to = lambda firsts, key: join_counted(entries.select(key, F.col("id").alias("u")), firsts, [key], "n").select("u", F.col("id").alias("v")).where("u <> v")
    # links found in Python are written first: components begins with Python too, and a task would run a worker for each
    similar = written(similar_pairs(sigs.select("id", "sig"), similarity))
    links = near_pairs(reps.select("id", "fp"), radius).union(to(reps, "fp")).union(to(sigs, "sig")).union(similar)
    linked = components(written(verified_pairs(rows.select("row", "text"), entries, components(links), shingle, similarity)))
    return of, written(entries.join(linked, entries.id == linked.node, "left").select("fp", "grams", "least", "n", F.coalesce("component", "id").alias("top")))


def keep_similar(docs: DataFrame, shingle: int, similarity: float, radius: int = 3) -> DataFrame:
    """One row, all columns, of each group of texts whose shingles are similar: of smallest doc_id (null last), then first in the input.

    A group is decided on texts, whatever their ids: rows that share an id with other texts are judged one by one.
    """
    pin_splits(docs.sparkSession)
    place = unused("row", docs.columns)
    rows = docs.withColumn(place, F.monotonically_increasing_id())
    _, entries = _similar_entries(rows.select(F.col(place).alias("row"), "doc_id", "text"), radius, shingle, similarity)
    kept = entries.groupBy("top").agg(F.min("least").alias("least")).select(F.col("least.row").alias(place))
    return rows.join(kept, place, "left_semi").select(*docs.columns)


def _similar_groups(docs: DataFrame, radius: int, shingle: int, similarity: float) -> DataFrame:
    pin_splits(docs.sparkSession)
    of, entries = _similar_entries(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), radius, shingle, similarity)
    least = entries.groupBy("top").agg(F.min("least").alias("first")).select("top", F.col("first.doc_id").alias("component_id"))
    named = written(entries.join(least, "top").select("fp", "grams", "n", "component_id"))
    return join_counted(of.select("doc_id", "fp", "grams"), named, ["fp", "grams"], "n").select("doc_id", "fp", "component_id")


def group(docs: DataFrame, radius: int = 3, shingle: int = 3, similarity: float | None = None) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable over links.

    Links are fingerprints of at most radius bits apart or, with similarity set, texts whose shingles have that Jaccard
    similarity or more.
    """
    if similarity:
        return _similar_groups(docs, radius, shingle, similarity)
    of = written(fingerprints(docs, shingle))
    entries = written(of.groupBy("fp").agg(F.min("doc_id").alias("id"), F.count("*").alias("n")))
    linked = components(near_pairs(entries.where("id is not null").select("id", "fp"), radius))
    found = written(entries.join(linked, entries.id == linked.node, "left").select("fp", "n", F.coalesce("component", "id").alias("component_id")))
    return join_counted(of, found, ["fp"], "n").select("doc_id", "fp", "component_id")


def query(docs: DataFrame) -> DataFrame:
    return group(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
