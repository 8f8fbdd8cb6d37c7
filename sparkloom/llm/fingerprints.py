"""SimHash document fingerprints and the permuted block tables that find all within a Hamming radius.

Terms are 3-word shingles (the words lower-cased in A-Z); a term that occurs t times weighs 1 + ln t (in 1024ths). Each term's
64-bit hash votes with its weight for the bits it sets and against the rest; a bit of the fingerprint is set if its
votes are positive. A text without words has fingerprint zero. Likeness of two fingerprints that differ in h bits is
max(0, cos(pi h / 64)), the cosine of the weighted term vectors that SimHash estimates: 1 for equal fingerprints.

Nulls count as empty texts. The order of documents is descending doc_id (null ids last), then descending text, so
repeated ids have a defined order too; a single document is its own next one. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import SLICE_ROWS, arrow_map, join_counted, ship, written
from sparkloom.llm.tokens import mix, runs_of, words_of_texts

SHINGLE, RADIUS = 3, 3
#: Characters of text that one range of documents should hold, and ranges at most (a range is read in turn, so its size is no matter of memory).
RANGE_CHARS, MOST_RANGES = 16_000_000, 20_000
#: Fingerprints that a list of a table may hold; beyond, it is cut by blocks of the bits that are not in its key.
MOST_POSTED = 500


def fingerprints_of(texts: list[str | None]) -> list[int]:
    """The fingerprints of texts as unsigned 64-bit integers."""
    words, counts = words_of_texts(texts)
    out, at = [], 0
    for n in counts.tolist():
        if not n:
            out.append(0)
            continue
        terms, times = np.unique(mix(runs_of(words[at : at + n], min(SHINGLE, n))), return_counts=True)
        at += n
        weights, votes = np.rint(1024 * (1 + np.log(times))), np.zeros(64)  # whole numbers: sums don't depend on their order
        for i in range(0, len(terms), 1 << 15):
            votes += weights[i : i + (1 << 15)] @ np.unpackbits(terms[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out.append(int(np.packbits(votes * 2 > weights.sum(), bitorder="little").view("<u8")[0]))
    return out


def fingerprint(text: str | None) -> int:
    return fingerprints_of([text])[0]


def likeness(a: int, b: int) -> float:
    return max(0.0, float(np.cos(np.pi * (a ^ b).bit_count() / 64))) if a != b else 1.0


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp bigint) of every whole text."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array(fingerprints_of(batch.column(1).to_pylist()), np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return arrow_map(docs.select("doc_id", "text"), each, "doc_id bigint, fp bigint")


def _masks(bits: list[int], blocks: int) -> list[int]:
    """The bits in so many blocks of about equal size."""
    edges = [len(bits) * i // blocks for i in range(blocks + 1)]
    return [sum(1 << b for b in bits[i:k]) for i, k in zip(edges, edges[1:])]


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint")


class Tables:
    """The permuted tables of a radius: the bits are cut into blocks, and each choice of blocks - radius of them is a table's key.

    Fingerprints within the radius agree in at least that many blocks, so one of the tables has every match. Below a
    key, the bits that are not in front are cut in the same way, for lists of over MOST_POSTED entries.
    """

    def __init__(self, radius: int, blocks: int | None = None):
        blocks = blocks or radius + 2
        choices = lambda bits: [sum(c) for c in combinations(_masks(bits, blocks), blocks - radius)]
        self.keys = choices(list(range(64)))
        self.below = [choices([b for b in range(64) if not m >> b & 1]) for m in self.keys]

    def post(self, df: DataFrame, name: str) -> DataFrame:
        """(name, fp_name, t, key): df (name, fp) under the key of each table."""
        keys = F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(_signed(m)).alias("key")) for k, m in enumerate(self.keys)])
        return df.select(F.col(name), F.col("fp").alias(f"fp_{name}"), F.explode(keys).alias("k")).select(name, f"fp_{name}", "k.t", "k.key")

    def post_below(self, df: DataFrame, name: str) -> DataFrame:
        fp = F.col(f"fp_{name}")
        keys = F.filter(F.array(*[F.struct(F.lit(100 * (k + 1) + i).alias("t"), F.lit(k).alias("of"), fp.bitwiseAND(_signed(m | self.keys[k])).alias("key")) for k, some in enumerate(self.below) for i, m in enumerate(some)]), lambda x: x["of"] == F.col("t"))
        return df.select(name, fp, F.explode(keys).alias("k")).select(name, f"fp_{name}", "k.t", "k.key")

    def in_lists(self, posted: DataFrame, name: str, lists: DataFrame) -> DataFrame:
        """Posts in the lists (t, key, n) of a table of theirs, those of long lists posted below."""
        short = join_counted(posted, lists.where(F.col("n") <= MOST_POSTED), ["t", "key"], "n")
        long = lists.where(F.col("n") > MOST_POSTED)
        return short if long.isEmpty() else short.unionByName(self.post_below(join_counted(posted, long, ["t", "key"], "n"), name))


def find_within(queries: DataFrame, entries: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """(query_id, id, distance) for all entries (id, fp) within radius bits of a query (query_id, fp)."""
    tables = Tables(radius, blocks)
    left, right = tables.post(queries, "query_id"), tables.post(entries, "id")
    lists = written(right.groupBy("t", "key").agg(F.count("*").alias("n")))
    met = tables.in_lists(left, "query_id", lists).join(tables.in_lists(right, "id", lists), ["t", "key"])
    met = met.withColumn("distance", F.bit_count(F.col("fp_query_id").bitwiseXOR(F.col("fp_id"))))
    return met.where(F.col("distance") <= radius).select("query_id", "id", "distance").distinct()


def pairs_within(entries: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """(u, v): each pair of entries (id, fp), one row for each fp, within radius bits, once. Lists of one entry are left alone."""
    tables = Tables(radius, blocks)
    posted = tables.post(entries, "id")
    lists = written(posted.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1"))
    kept = tables.in_lists(posted, "id", lists)
    a, b = kept.alias("a"), kept.alias("b")
    near = F.bit_count(F.col("a.fp_id").bitwiseXOR(F.col("b.fp_id"))) <= radius
    met = a.join(b, (F.col("a.t") == F.col("b.t")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.fp_id") < F.col("b.fp_id")) & near)
    return met.select(F.col("a.id").alias("u"), F.col("b.id").alias("v")).distinct()


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by as many (or all) of the following text's first."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


SCHEMA = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}


def _judged(pairs: list[tuple]) -> list[list]:
    """Columns of SCHEMA for (doc_id, text, its fingerprint, next text, its fingerprint)."""
    others = [edited(text, after) for _, text, _, after, _ in pairs]
    out = [[] for _ in range(7)]
    for (doc, text, fp, _, fp_after), other, changed in zip(pairs, others, fingerprints_of(others)):
        digest = hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest()
        for column, x in zip(out, (doc, len(text), digest, f"{fp:016x}", f"{changed:016x}", likeness(fp, changed), likeness(fp, fp_after))):
            column.append(x)
    return out


def _batch(columns: list[list], schema: str) -> pa.RecordBatch:
    names, types = zip(*[x.split() for x in schema.split(", ")])
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[t]) for c, t in zip(columns, types)], list(names))


def _next_documents(docs: DataFrame) -> DataFrame:
    """SCHEMA with each document's next one. Documents are dealt into sorted ranges; the last of a range meets the first of the next afterwards."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    chars, n = docs.agg(F.sum(F.length("text").cast("bigint")), F.count("*")).first()
    ranges = max(1, min(n, MOST_RANGES, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), (chars or 0) // RANGE_CHARS)))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text").desc()]
    dealt = docs.repartitionByRange(ranges, order[0], F.substring("text", 1, 64).desc()).sortWithinPartitions(*order)
    schema = f"role int, place int, text string, {SCHEMA}"

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place, last = TaskContext.get().partitionId(), None
        edge = lambda role, doc, text: _batch([[role], [place], [text], [doc], *[[None]] * 6], schema)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                ids, texts = (c.to_pylist() for c in batch.slice(at, SLICE_ROWS).columns)
                rows = list(zip(ids, texts, fingerprints_of(texts)))
                if last is None:
                    yield edge(1, *rows[0][:2])
                else:
                    rows.insert(0, last)
                last = rows[-1]
                if len(rows) > 1:
                    found = _judged([(*a, *b[1:]) for a, b in zip(rows, rows[1:])])
                    yield _batch([[0] * len(found[0]), [place] * len(found[0]), [None] * len(found[0]), *found], schema)
        if last is not None:
            yield edge(2, *last[:2])

    out = written(dealt.mapInArrow(over, schema))
    firsts = out.where("role = 1").select(F.col("place").alias("following"), F.col("text").alias("next"))
    places = out.where("role = 1").select("place", F.lead("place").over(Window.orderBy("place")).alias("following"))  # a row for each range
    least = out.where("role = 1").agg(F.min("place").alias("least"))
    places = places.join(F.broadcast(least)).select("place", F.coalesce("following", "least").alias("following"))
    lasts = out.where("role = 2").select("place", "doc_id", "text").join(places, "place").join(firsts, "following").select("doc_id", "text", "next")

    def close(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, texts, after = (c.to_pylist() for c in batch.columns)
        return _batch(_judged(list(zip(ids, texts, fingerprints_of(texts), after, fingerprints_of(after)))), SCHEMA)

    return written(out.where("role = 0").drop("role", "place", "text").union(arrow_map(lasts, close, SCHEMA)))


def edited_fingerprints(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document.

    n_within: how many other documents' fingerprints lie within radius bits, found through the permuted tables over
    distinct fingerprints; equal ones count too.
    """
    found = _next_documents(docs)
    kinds = written(found.groupBy("fingerprint").agg(F.count("*").alias("n")).withColumn("fp", F.conv("fingerprint", 16, -10).cast("bigint")))
    pairs = pairs_within(kinds.select(F.col("fp").alias("id"), "fp"), radius)
    sides = pairs.union(pairs.select("v", "u")).toDF("fp", "id")
    others = sides.join(kinds.select(F.col("fp").alias("id"), "n"), "id").groupBy("fp").agg(F.sum("n").alias("others"))
    near = written(kinds.join(others, "fp", "left").select("fingerprint", "n", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_within")))
    return join_counted(found, near, ["fingerprint"], "n").select(*[x.split()[0] for x in SCHEMA.split(", ")], "n_within")
