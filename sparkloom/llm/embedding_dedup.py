"""Embedding near-dedup by epsilon grid order.

Unit vectors with cosine >= t lie within eps = sqrt(2 - 2 t). Vectors of a label are sorted by the grid cells (side eps)
of their leading principal coordinates, cut into blocks of the sequence, and blocks are joined with blocks: first over
shared or neighbouring cells of the first KEYED coordinates, then only where their bounding boxes lie within eps; the
rest is provably distant. A block ends where the cell of the first two coordinates does, unless it is still small, so
few blocks reach over many cells. A pair of blocks is split in halves again and again while boxes of the halves can be told apart.
What is left is compared in full by cosine in double precision.

Equal vectors (same label) are one entry with a count, so groups of copies are never expanded. A pair of blocks sends
back a count for each vector and a spanning forest, not its links. Principal directions come from a bounded sample of
vectors (SAMPLE rows); they steer only what is skipped, never what is linked.

Vectors that are null, zero, or hold null or non-finite components, and vectors with a null label, link with nothing;
so do vectors of different lengths. Rows that repeat a vec_id with the same vector are linked copies of each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import ship, written
from sparkloom.llm.components import components

LEADING, KEYED, BLOCK, LEAST_BLOCK, LEAF, SAMPLE = 4, 3, 256, 32, 48, 4000


def _scaled(v: np.ndarray) -> np.ndarray:
    v = np.asarray(v, np.float64)
    return v / np.abs(v).max()


def _directions(rows: DataFrame) -> dict[int, np.ndarray]:
    """Leading principal directions of unit vectors, for each length of vector."""
    by: dict[int, list] = {}
    for r in rows.orderBy(F.xxhash64("id")).limit(SAMPLE).select("embedding").collect():
        v = _scaled(r[0])
        by.setdefault(len(v), []).append(v / np.linalg.norm(v))
    return {n: np.linalg.eigh(np.cov(np.array(x), rowvar=False).reshape(n, n) if len(x) > 1 else np.eye(n))[1][:, ::-1][:, :LEADING] for n, x in by.items()}


def _axes(found: dict[int, np.ndarray], n: int) -> np.ndarray:
    return found[n] if n in found else np.eye(n)[:, :LEADING]


def _blocks(batches: Iterator[pa.RecordBatch], most: int, least: int) -> Iterator[pa.RecordBatch]:
    """Sequences of sorted rows (label, id, copies, vector, place, cells) in blocks of one label and length."""
    from pyspark import TaskContext

    number, rows = TaskContext.get().partitionId() << 32, []

    def out() -> pa.RecordBatch:
        nonlocal number, rows
        p = np.array([r[4] for r in rows])
        made = {"block": [number], "label": [rows[0][0]], "size": [len(rows[0][3])], "lo": [p.min(axis=0).tolist()], "hi": [p.max(axis=0).tolist()], "ids": [np.array([r[1] for r in rows], np.int64).tobytes()], "copies": [np.array([r[2] for r in rows], np.int64).tobytes()], "vectors": [np.array([r[3] for r in rows]).tobytes()], "places": [p.tobytes()]}
        number, rows = number + 1, []
        return pa.RecordBatch.from_pydict(made, schema=pa.schema([("block", pa.int64()), ("label", pa.int64()), ("size", pa.int32()), ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())), ("ids", pa.binary()), ("copies", pa.binary()), ("vectors", pa.binary()), ("places", pa.binary())]))

    for batch in batches:
        for label, i, copies, vector, place, cells in zip(*[batch.column(k).to_pylist() for k in range(6)]):
            if rows and (len(rows) == most or rows[0][0] != label or len(rows[0][3]) != len(vector) or len(rows) >= least and rows[-1][5][:2] != cells[:2]):
                yield out()
            rows.append((label, i, copies, vector, place, cells))
    if rows:
        yield out()


def _joined(a, b, pa_, pb, eps: float, threshold: float, same: bool):
    """Boolean matrix of links between two sequence intervals, by recursion; provably distant halves are skipped."""
    links = np.zeros((len(a), len(b)), bool)
    stack = [(0, len(a), 0, len(b))]
    while stack:
        i, j, k, m = stack.pop()
        gap = np.maximum(0, np.maximum(pa_[i:j].min(axis=0) - pb[k:m].max(axis=0), pb[k:m].min(axis=0) - pa_[i:j].max(axis=0)))
        if (gap**2).sum() > eps * eps + 1e-9 or same and m <= i:
            continue
        if max(j - i, m - k) <= LEAF:
            links[i:j, k:m] = a[i:j] @ b[k:m].T >= threshold
        elif j - i >= m - k:
            stack += [(i, (i + j) // 2, k, m), ((i + j) // 2, j, k, m)]
        else:
            stack += [(i, j, k, (k + m) // 2), (i, j, (k + m) // 2, m)]
    return np.triu(links, 1) if same else links


def links(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """(id, n_links, root): distinct vectors' links weighted by copies, and a forest over them. vectors: (label, id, copies, embedding)."""
    spark, eps = vectors.sparkSession, float(np.sqrt(2 - 2 * threshold))
    ship(spark)
    found = _directions(vectors)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, cells = [], []
            for v in batch.column(3).to_pylist():
                v = _scaled(v)
                p = np.zeros(LEADING)
                p[: min(LEADING, len(v))] = (v / np.linalg.norm(v)) @ _axes(found, len(v))
                places.append(p.tolist())
                cells.append(np.floor(p / eps).astype(int).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.list_(pa.float64())), pa.array(cells, pa.list_(pa.int32()))], ["label", "id", "copies", "embedding", "place", "cells"])

    vectors = vectors.select(F.col("label").cast("bigint"), "id", "copies", F.col("embedding").cast("array<double>"))
    rows = vectors.mapInArrow(placed, "label bigint, id bigint, copies bigint, embedding array<double>, place array<double>, cells array<int>")
    order = ["label", F.size("embedding"), "cells", "id"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most, least = BLOCK, min(LEAST_BLOCK, BLOCK)
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("label", "id", "copies", "embedding", "place", "cells")
    blocks = written(rows.mapInArrow(lambda batches: _blocks(batches, most, least), "block bigint, label bigint, size int, lo array<double>, hi array<double>, ids binary, copies binary, vectors binary, places binary"))
    keys = [f"c{k}" for k in range(KEYED)]

    def in_cells(boxes: DataFrame, reach: int) -> DataFrame:
        """A row for each cell that a box, widened by so many cells, lies in."""
        for k, name in enumerate(keys):
            at = lambda side, by: (F.floor(F.get(side, F.lit(k)) / eps) + by).cast("int")  # noqa: B023, E731
            boxes = boxes.withColumn(name, F.explode(F.sequence(at("lo", -reach), at("hi", reach))))
        return boxes

    boxes = blocks.select("block", "label", "size", "lo", "hi")
    left, right = in_cells(boxes, 0).alias("a"), in_cells(boxes, 1).alias("b")
    gaps = F.aggregate(F.zip_with(F.zip_with("a.lo", "b.hi", lambda x, y: x - y), F.zip_with("b.lo", "a.hi", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0))), F.lit(0.0), lambda s, g: s + g * g)
    near = left.join(right, ["label", "size", *keys]).where((F.col("a.block") <= F.col("b.block")) & (gaps <= eps * eps + 1e-9)).select(F.col("a.block").alias("a"), F.col("b.block").alias("b")).distinct()
    side = lambda name: blocks.select(F.col("block").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("ids", "copies", "vectors", "places")])
    pairs = near.join(side("a"), "a").join(side("b"), "b").select("a", "b", *[f"{s}_{c}" for s in "ab" for c in ("ids", "copies", "vectors", "places")])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda k, kind: np.frombuffer(batch.column(k)[r].as_py(), kind)  # noqa: B023, E731
                same = batch.column(0)[r].as_py() == batch.column(1)[r].as_py()
                sides = []
                for k in (2, 6):
                    ids, copies = get(k, np.int64), get(k + 1, np.int64)
                    v = get(k + 2, np.float64).reshape(len(ids), -1)
                    v = v / np.abs(v).max(axis=1, keepdims=True)
                    sides.append((ids, copies, v / np.linalg.norm(v, axis=1, keepdims=True), get(k + 3, np.float64).reshape(len(ids), -1)))
                (ia, ca, va, pla), (ib, cb, vb, plb) = sides
                met = _joined(va, vb, pla, plb, eps, threshold, same)
                if not met.any():
                    continue
                root_a, root_b = ia.copy(), ib.copy()
                top = np.iinfo(np.int64).max
                while True:  # the smallest id of each component of this pair of blocks
                    new_b = np.minimum(root_b, np.where(met, root_a[:, None], top).min(axis=0))
                    new_a = np.minimum(root_a, np.where(met, new_b[None, :], top).min(axis=1))
                    if same:
                        new_a = new_b = np.minimum(new_a, new_b)
                    if (new_a == root_a).all() and (new_b == root_b).all():
                        break
                    root_a, root_b = new_a, new_b
                n_a, n_b = met @ cb, met.T @ ca
                ids, n, root = np.concatenate([ia, ib]), np.concatenate([n_a, n_b]), np.concatenate([root_a, root_b])
                some = n > 0
                yield pa.RecordBatch.from_arrays([pa.array(x[some], pa.int64()) for x in (ids, n, root)], ["id", "n_links", "root"])

    return pairs.mapInArrow(compared, "id bigint, n_links bigint, root bigint")


def query(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """vectors (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    good = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)) & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = vectors.select("vec_id", F.when(good, F.col("label")).alias("label"), F.when(good, F.col("embedding")).alias("embedding"))
    entries = written(rows.where("embedding is not null").groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")).where("id is not null"))
    found = written(links(entries, threshold))
    counts = found.groupBy("id").agg(F.sum("n_links").alias("others"))
    tied = components(found.select(F.col("id").alias("u"), F.col("root").alias("v")))
    of = entries.join(counts, "id", "left").join(tied, entries.id == tied.node, "left").select("label", "embedding", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    linked = rows.where("embedding is not null").join(of, ["label", "embedding"], "left").select("vec_id", "n_links", "component_id")
    alone = rows.where("embedding is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"), (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"))
