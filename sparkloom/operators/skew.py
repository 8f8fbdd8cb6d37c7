"""What keeps plans even and repeatable: joins with counted keys, pinned splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that a join sends to all executors at most.
HEAVY = 1000


def join_counted(left: DataFrame, right: DataFrame, keys: list[str], n: str) -> DataFrame:
    """Inner join (without column n of right): right has one row for each key, and in n how many rows left has of it.

    Keys with over 1 / HEAVY of all these rows, so at most HEAVY of them, are joined by broadcast and shuffle nothing.
    right is read three times: a table or a checkpoint.
    """
    total = right.agg(F.sum(n)).first()[0] or 0
    is_heavy = F.col(n) * HEAVY > F.lit(max(total, HEAVY * HEAVY))
    heavy = right.where(is_heavy)
    if heavy.isEmpty():
        return left.join(right.drop(n), keys)
    light = left.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(right.where(~is_heavy).drop(n), keys)
    return light.unionByName(left.join(F.broadcast(heavy.drop(n)), keys))


def pin_splits(spark: SparkSession) -> None:
    """Keep how files are cut into splits for the rest of the session: by default it follows the number of live cores.

    Rows that are told apart by their place keep it in every scan only if the splits stay the same.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(max(1, spark.sparkContext.defaultParallelism)))
