"""Splits, shards, mixtures, chunks and batches by hash: repeatable, without a sort of the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def point(key: Column, seed: int = 42) -> Column:
    """A number from 0 to under 1 that depends on key and seed alone: the first 13 hex digits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{seed}"))), 1, 13), 16, 10).cast("double") / float(1 << 52)


def split(docs: DataFrame, key: str, shares: dict[str, float], seed: int = 42) -> DataFrame:
    total, out, at = sum(shares.values()), F.lit(None).cast("string"), 1.0
    for name, share in reversed(shares.items()):
        at -= share / total
        out = F.when(point(F.col(key), seed) >= at - 1e-12, F.coalesce(out, F.lit(name))).otherwise(F.lit(None).cast("string")) if name == list(shares)[-1] else F.coalesce(out, F.when(point(F.col(key), seed) >= at - 1e-12, name))
    return docs.withColumn("split", out)


def shard(docs: DataFrame, key: str, shards: int) -> DataFrame:
    return docs.withColumn("shard", F.crc32(F.col(key).cast("string")) % shards)


def mixture(docs: DataFrame, key: str, group: str, weights: dict[str, float], seed: int = 42) -> DataFrame:
    """Rows of each group with its weight as the probability; groups without a weight have none."""
    table = F.create_map(*[F.lit(x) for p in weights.items() for x in p])
    return docs.where(point(F.col(key), seed) < F.coalesce(F.try_element_at(table, F.col(group)), F.lit(0.0)))


def chunk(docs: DataFrame, column: Column, length: int) -> DataFrame:
    """Words in chunks of at most ``length``, a row each."""
    n = F.ceil(F.size(column) / length).cast("int")
    parts = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(column, i * length + 1, length))).otherwise(F.array().cast("array<array<string>>"))
    return docs.select("*", F.posexplode(parts).alias("chunk", "words"))


def shuffled(docs: DataFrame, key: str, epoch: int, seed: int = 42) -> DataFrame:
    """docs with ``rank_key``, and sorted by it: another order in each epoch, the same in each run."""
    return docs.withColumn("rank_key", F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)), F.lit(str(epoch))))).orderBy("rank_key", key)


def curriculum(docs: DataFrame, difficulty: Column, edges: list[float]) -> DataFrame:
    """docs with ``stage``: how many of the edges the difficulty reaches. Edges are quantiles or limits; no sort of all rows."""
    return docs.withColumn("stage", sum((F.when(difficulty >= e, 1).otherwise(0) for e in edges), F.lit(0)))


def interleaved(parts: dict[str, DataFrame], key: str, weights: dict[str, float], seed: int = 42) -> DataFrame:
    """Rows of several sources in one table with their source, each kept with its weight as the probability."""
    out = None
    for name, df in parts.items():
        some = df.where(point(F.col(key), seed) < weights.get(name, 0.0)).withColumn("source_name", F.lit(name))
        out = some if out is None else out.unionByName(some, allowMissingColumns=True)
    return out
