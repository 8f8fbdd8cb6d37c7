"""Duplicate removal: exact, MinHash, SimHash, by modality; the first is the row of smallest id (null last)."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType

from sparkloom.operators.skew import join_counted, pin_splits


def exact_groups(docs: DataFrame, key: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(hash, first, n) of each distinct content. Two narrow columns travel; the hash is made where the row is read."""
    return docs.select(F.sha2(key, 256).alias("hash"), id_column).groupBy("hash").agg(F.min(id_column).alias("first"), F.count("*").alias("n"))


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with each row's place in the input, and the name of that column.

    A place is kept by every scan only if splits are cut alike, so how they are cut is pinned for the session.
    """
    pin_splits(docs.sparkSession)
    name = "_row"
    while name in docs.columns:
        name = f"_{name}"
    return docs.withColumn(name, F.monotonically_increasing_id()), name


def marked(docs: DataFrame, key: str = "text", id_column: str = "doc_id") -> DataFrame:
    """docs with duplicate_of: null for the first row of each content, else that row's id (and is_duplicate, as ids may be null)."""
    rows, place = numbered(docs)
    rows = rows.withColumn("_hash", F.sha2(key, 256))
    first = rows.groupBy("_hash").agg(F.min(F.struct(F.col(id_column).isNull(), id_column, place)).alias("_first"))
    out = rows.join(first, rows._hash.eqNullSafe(first._hash)).withColumn("is_duplicate", F.col(f"_first.{place}") != F.col(place))
    return out.select(*docs.columns, F.when(F.col("is_duplicate"), F.col(f"_first.{id_column}")).alias("duplicate_of"), "is_duplicate")


def exact(docs: DataFrame, key: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row of each content: of smallest id, then first in the input. Ids may repeat or be null; null contents are one content.

    Hashes, ids and places travel to find the first rows; whole rows only to meet those.
    """
    rows, place = numbered(docs)
    narrow = rows.select(F.sha2(key, 256).alias("hash"), id_column, place)
    first = narrow.groupBy("hash").agg(F.min(F.struct(F.col(id_column).isNull(), id_column, place)).alias("first")).select(F.col(f"first.{place}").alias(place))
    return rows.join(first, place, "left_semi").select(*docs.columns)


def unseen(docs: DataFrame, seen: DataFrame, key: str = "text") -> DataFrame:
    """The rows whose content hash is not in the stored keys (hash)."""
    return docs.join(seen.select(F.col("hash").alias("_hash")), F.sha2(key, 256) == F.col("_hash"), "left_anti")


def jaccard(a, b):
    """Similarity of two arrays as sets; 0 without any element."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))


# --- SimHash -------------------------------------------------------------------------------------------------------
FEATURE_CHARS, DISTANCE = 4, 3
_WORD_CHARS = re.compile(r"\w+")


_P1, _P2, _P3, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
#: The bits of each value of a byte, least first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def _xxh64_of_four(lanes: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of four bytes each, given as little-endian numbers."""
    h = (_P5 + np.uint64(4)) ^ (lanes.astype(np.uint64) * _P1)
    h = ((h << np.uint64(23)) | (h >> np.uint64(41))) * _P2 + _P3
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def _shingle_hashes(chars: str, width: int) -> np.ndarray:
    """XXH64 of each shingle; those of four ASCII characters all at once."""
    import xxhash

    grams = max(1, len(chars) - width + 1)
    if width != 4 or len(chars) < 4:
        return np.fromiter((xxhash.xxh64_intdigest(chars[i : i + width]) for i in range(grams)), np.uint64, grams)
    codes = np.frombuffer(chars.encode("utf-32-le"), np.uint32)
    out = _xxh64_of_four(codes[:-3] | codes[1:-2] << np.uint32(8) | codes[2:-1] << np.uint32(16) | codes[3:] << np.uint32(24))
    wide = codes > 127
    if wide.any():
        for i in np.flatnonzero(wide[:-3] | wide[1:-2] | wide[2:-1] | wide[3:]).tolist():
            out[i] = xxhash.xxh64_intdigest(chars[i : i + 4])
    return out


def simhash(text: str | None, width: int = FEATURE_CHARS) -> int:
    """64-bit fingerprint of the lower-cased word characters of a text, by votes of the hashes of its shingles of ``width``."""
    hashes = _shingle_hashes("".join(_WORD_CHARS.findall((text or "").lower())), width)
    places = np.arange(0, 2048, 256)
    counts = sum((np.bincount((hashes[i : i + 65536].view(np.uint8).reshape(-1, 8) + places).ravel(), minlength=2048) for i in range(0, len(hashes), 65536)), np.zeros(2048, np.int64))
    votes = (counts.reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<i8")[0])


@F.pandas_udf(LongType())
def simhash_of(texts: pd.Series) -> pd.Series:
    return texts.map(simhash)


def _posted(entries: DataFrame, distance: int, most: int) -> DataFrame:
    """(doc_id, hash, k, s): entries in the lists k, s in which those of at most ``distance`` differing bits meet.

    They agree in one of distance + 1 blocks of bits. A block's list of over ``most`` hashes is cut by one block more of
    the rest, as bits that differ leave one of those alone as well where there are more than distance.
    """
    blocks = distance + 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    cut = lambda low, high: F.shiftrightunsigned("hash", low).bitwiseAND(F.lit((1 << (high - low)) - 1))
    keys = F.array(*[F.struct(F.lit(i).alias("i"), cut(low, high).alias("v")) for i, (low, high) in enumerate(zip(edges, edges[1:]))])
    posted = entries.select("doc_id", "hash", F.explode(keys).alias("k"))
    sizes = posted.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    posted = posted.join(sizes, "k")
    rest = []  # for each block: the bits outside it, in distance + 1 pieces
    for low, high in zip(edges, edges[1:]):
        others = [b for b in range(64) if not low <= b < high]
        pieces = [others[len(others) * i // blocks : len(others) * (i + 1) // blocks] for i in range(blocks)]
        masks = [sum(1 << b for b in p) for p in pieces]
        rest.append(F.array(*[F.struct(F.lit(i).alias("i"), F.col("hash").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("v")) for i, m in enumerate(masks)]))
    chosen = reduce(lambda out, i: F.when(F.col("k.i") == i, rest[i]).otherwise(out), range(blocks), rest[0])
    whole = F.array(F.struct(F.lit(-1).alias("i"), F.lit(0).cast("bigint").alias("v")))
    return posted.withColumn("s", F.explode(F.when(F.col("n") > most, chosen).otherwise(whole))).select("doc_id", "hash", "k", "s")


def hamming_links(entries: DataFrame, distance: int, most: int = 2000) -> DataFrame:
    """(doc_id, first): all pairs of entries (doc_id, hash), one row for each hash, of at most ``distance`` differing bits."""
    posted = _posted(entries, distance, most)
    a, b = posted.alias("a"), posted.alias("b")
    near = F.bit_count(F.col("a.hash").bitwiseXOR(F.col("b.hash"))) <= distance
    return a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("a.s") == F.col("b.s")) & (F.col("a.doc_id") < F.col("b.doc_id")) & near).select(F.col("b.doc_id").alias("doc_id"), F.col("a.doc_id").alias("first")).distinct()


def spanning(hashes: np.ndarray, distance: int) -> Iterator[tuple[int, np.ndarray]]:
    """(place, places tied to it): a forest that ties all hashes (uint64) which links of at most ``distance`` bits connect."""
    left = np.arange(len(hashes))
    while len(left) > 1:
        waiting, left = [left[0]], left[1:]
        while waiting and len(left):
            at = waiting.pop()
            near = np.bitwise_count(hashes[left] ^ hashes[at]) <= distance
            if near.any():
                yield at, left[near]
                waiting += left[near].tolist()
                left = left[~near]


def hamming_forest(entries: DataFrame, distance: int, most: int = 2000) -> DataFrame:
    """(doc_id, first): pairs of hamming_links that connect what all of them connect; a list of n hashes gives n - 1 at most. Ids are integers."""
    of = entries.schema["doc_id"].dataType.simpleString()
    posted = _posted(entries.where("doc_id is not null"), distance, most).select("doc_id", "hash", F.col("k.i").alias("a"), F.col("k.v").alias("b"), F.col("s.i").alias("c"), F.col("s.v").alias("d"))
    keys = ["a", "b", "c", "d"]

    def links(batches):
        kept = None  # the last list so far, which the next batch may go on with
        for batch in batches:
            part = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            new = np.flatnonzero(np.logical_or.reduce([part[k].to_numpy()[1:] != part[k].to_numpy()[:-1] for k in keys])) + 1
            if len(new):
                kept = part.iloc[new[-1] :]
                yield tied(part.iloc[: new[-1]], np.concatenate([[0], new]))
            else:
                kept = part
        if kept is not None:
            yield tied(kept, np.array([0, len(kept)]))

    def tied(part, cuts):
        ids, hashes = part["doc_id"].to_numpy(), part["hash"].to_numpy().view(np.uint64)
        sizes, ups, downs = np.diff(cuts), [], []
        two = cuts[:-1][sizes == 2]
        two = two[np.bitwise_count(hashes[two] ^ hashes[two + 1]) <= distance]
        ups.append(ids[two])
        downs.append(ids[two + 1])
        for low, n in zip(cuts[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            for at, near in spanning(hashes[low : low + n], distance):
                ups.append(np.full(len(near), ids[low + at]))
                downs.append(ids[low + near])
        ups, downs = np.concatenate(ups), np.concatenate(downs)
        return pd.DataFrame({"doc_id": np.maximum(ups, downs), "first": np.minimum(ups, downs)})

    return posted.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(links, f"doc_id {of}, first {of}").distinct()


def by_hash(docs: DataFrame, distance: int) -> DataFrame:
    """(doc_id, component) of docs (doc_id, hash): near hashes share a component; rows with a null hash stand alone.

    The hashes are written, as each later table is made of them: a text is read and hashed once.
    """
    _checkpoints(docs.sparkSession)
    docs = docs.checkpoint()
    kinds = docs.where("hash is not null").groupBy("hash").agg(F.min("doc_id").alias("doc_id")).checkpoint()
    numbers = isinstance(kinds.schema["doc_id"].dataType, IntegralType)
    tied = settle(kinds, (hamming_forest if numbers else hamming_links)(kinds, distance))
    of = kinds.join(tied, "doc_id").select("hash", "component")
    return docs.join(of, "hash", "left").select("doc_id", F.coalesce("component", "doc_id").alias("component"))


def simhash_groups(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, component): texts whose SimHash differs in at most ``distance`` bits share a component."""
    return by_hash(docs.select("doc_id", simhash_of("text").alias("hash")), distance)


def batch_dedup(items: DataFrame, modality: str = "text", near: str = "minhash") -> DataFrame:
    """The rows that are no duplicates: exact ones go first; then near ones of texts (minhash or simhash) and images.

    items: (doc_id, text) or (doc_id, data); video and audio: exact only.
    """
    key = "text" if modality == "text" else "data"
    items = exact(items, key)
    if modality == "text":
        groups = minhash(items) if near == "minhash" else simhash_groups(items)
    elif modality == "image":
        from sparkloom.operators import image

        groups = by_hash(items.select("doc_id", image.perceptual_hash("data").alias("hash")), image.DISTANCE)
    else:
        return items
    return items.join(groups.where("doc_id = component").select("doc_id"), "doc_id", "left_semi")


def bands_for(threshold: float, permutations: int) -> tuple[int, int]:
    """Bands and rows with the least sum of the areas of false positives and false negatives."""
    grid = np.linspace(0, 1, 201)

    def cost(b: int, r: int) -> float:
        p = 1 - (1 - grid**r) ** b
        return p[grid < threshold].sum() + (1 - p[grid >= threshold]).sum()

    return min(((b, r) for b in range(1, permutations + 1) for r in range(1, permutations // b + 1)), key=lambda x: cost(*x))


def minhash_bands(docs: DataFrame, threshold: float = 0.8, permutations: int = 128, seed: int = 1) -> DataFrame:
    """(doc_id, band, key): signatures of the distinct lower-cased words, cut into bands. Texts without words have none."""
    bands, rows = bands_for(threshold, permutations)
    rng = np.random.default_rng(seed)
    a, b = rng.integers(1, 1 << 31, permutations, dtype=np.uint64), rng.integers(0, 1 << 31, permutations, dtype=np.uint64)

    odd = np.arange(rows, dtype=np.uint64) * np.uint64(2) + np.uint64(0xD6E8FEB86659FD93)

    def digest(part: np.ndarray) -> np.int64:
        mixed = (part + np.uint64(1)) * odd
        return np.bitwise_xor.reduce(mixed ^ (mixed >> np.uint64(29))).view(np.int64)

    @F.pandas_udf("array<bigint>")
    def keys(hashes: pd.Series) -> pd.Series:
        def of(h):
            if h is None or not len(h):
                return []
            x = np.asarray(h, np.int64).view(np.uint64) >> np.uint64(33)
            least = np.full(permutations, np.iinfo(np.uint64).max, np.uint64)
            for i in range(0, len(x), 4096):
                least = np.minimum(least, ((x[i : i + 4096, None] * a + b) % np.uint64((1 << 31) - 1)).min(axis=0))
            return [int(digest(least[k * rows : (k + 1) * rows])) for k in range(bands)]

        return hashes.map(of)

    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"(?U)\s+"), lambda w: w != ""))
    return docs.select("doc_id", F.posexplode(keys(F.transform(words, lambda w: F.xxhash64(w)))).alias("band", "key"))


def near_links(bands: DataFrame) -> DataFrame:
    """(doc_id, first): each row tied to the first row of each of its bands' buckets: a star for each bucket, not its pairs."""
    _checkpoints(bands.sparkSession)
    first = bands.groupBy("band", "key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").checkpoint()
    return join_counted(bands, first, ["band", "key"], "n").where("doc_id <> first").select("doc_id", "first").distinct()


def _checkpoints(spark: SparkSession) -> None:
    """The session's checkpoint folder: the one its setting names; one of our own where none is named (tests)."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp())


def settle(nodes: DataFrame, links: DataFrame, rounds: int = 50) -> DataFrame:
    """(doc_id, component): smallest id reachable over links (doc_id, first), by minimum labels with pointer jumping."""
    _checkpoints(nodes.sparkSession)
    both = links.select("doc_id", F.col("first").alias("other")).union(links.select("first", "doc_id")).checkpoint()
    labels = both.groupBy("doc_id").agg(F.least(F.min("other"), F.col("doc_id")).alias("component"), F.count("*").alias("n")).checkpoint()
    for _ in range(rounds):
        seen = join_counted(both, labels.withColumnRenamed("doc_id", "other"), ["other"], "n").groupBy("doc_id").agg(F.min("component").alias("seen"))
        lower = labels.join(seen, "doc_id").select("doc_id", F.least("component", "seen").alias("c"), F.col("component").alias("old"), "n").checkpoint()
        into = lower.groupBy("c").agg(F.count("*").alias("times")).join(labels.select(F.col("doc_id").alias("c"), F.col("component").alias("next")), "c").checkpoint()
        new = join_counted(lower, into, ["c"], "times").select("doc_id", F.least("c", "next").alias("component"), "old", "n").checkpoint()
        changed = new.where("component <> old").limit(1).count()
        labels = new.drop("old")
        if not changed:
            break
    else:
        raise RuntimeError(f"labels did not settle in {rounds} rounds")
    return nodes.select("doc_id").join(labels.drop("n"), "doc_id", "left").select("doc_id", F.coalesce("component", "doc_id").alias("component"))


def minhash(docs: DataFrame, threshold: float = 0.8, permutations: int = 128) -> DataFrame:
    """(doc_id, component): near duplicates share a component; keep the rows whose component is their own id."""
    return settle(docs, near_links(minhash_bands(docs, threshold, permutations)))
