"""Connected components of a graph given as pairs, without gathering the graph anywhere.

Each partition first keeps a spanning forest of its own pairs; then large-star and small-star rounds, each written to
the shared folder, make every node point at the smallest node of its component. Counts of neighbours are tables, so that
hubs (at most HEAVY of them at a time) are joined by broadcast and no task gathers a hub's neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import join_counted, ship, written


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up, top = self.up, x
        while (y := up.get(top, top)) != top:
            top = y
        while (y := up.get(x, x)) != top:
            up[x], x = top, y
        return top

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


MAX_LOCAL = 500_000


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()

    def out():
        for x in list(forest.up):
            forest.root(x)
        return pa.RecordBatch.from_pydict({"u": pa.array(list(forest.up), pa.int64()), "v": pa.array([forest.root(x) for x in forest.up], pa.int64())})

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(a, b)
        if len(forest.up) > MAX_LOCAL:
            yield out()
            forest = Forest()
    if forest.up:
        yield out()


def components(pairs: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of pairs (u bigint, v bigint): component is the smallest node that can be reached."""
    ship(pairs.sparkSession)
    edges = written(pairs.select("u", "v").where("u <> v").mapInArrow(_forests, "u bigint, v bigint"))  # u > v
    before = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v"), F.col("u"))).toDF("u", "v")
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n")))
        large = written(join_counted(both, least, ["u"], "n").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = written(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        small = join_counted(large, low, ["u"], "n")
        edges = written(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
