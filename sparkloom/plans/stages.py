"""Stages that run DataFrame operators in order or as a graph, keep what succeeds, and resume from written stages."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.functions import udf as U
from sparkloom.operators import clean, dedup

log = logging.getLogger(__name__)


@dataclass
class Stage:
    name: str
    apply: Callable[[DataFrame], DataFrame]  # adds or keeps a status column; only success flows on
    order: int
    enabled: bool = True


def _file(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def finished(spark: SparkSession, folder: str) -> bool:
    """Whether a folder holds a table that was written to its end."""
    mark = _file(spark, f"{folder}/_SUCCESS")
    return bool(mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark))


def stage_table(df: DataFrame, folder: str) -> DataFrame:
    """df written to folder, or read from there if it was written to its end; half a table is written anew."""
    spark = df.sparkSession
    if not finished(spark, folder):
        df.write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


class CleaningPipeline:
    def __init__(self, stages: list[Stage]):
        self.stages = sorted(stages, key=lambda s: s.order)
        self._kept: list[DataFrame] = []
        self.seconds: dict[str, float] = {}

    def enable(self, name: str, on: bool = True) -> CleaningPipeline:
        for s in self.stages:
            s.enabled = on if s.name == name else s.enabled
        return self

    def add(self, stage: Stage) -> CleaningPipeline:
        self.stages = sorted([*self.stages, stage], key=lambda s: s.order)
        return self

    def remove(self, name: str) -> CleaningPipeline:
        self.stages = [s for s in self.stages if s.name != name]
        return self

    def get(self, name: str) -> Stage | None:
        return next((s for s in self.stages if s.name == name), None)

    def run(self, docs: DataFrame, folder: str | None = None) -> tuple[DataFrame, list[tuple[str, DataFrame]]]:
        """The surviving rows and (stage, its rows with status).

        A folder holds each stage's rows as Parquet; those written to their end are read. Without one the stages' rows
        stay in executor storage (memory and disk) until release().
        """
        traced = []
        for s in (s for s in self.stages if s.enabled):
            began, out = time.monotonic(), s.apply(docs)
            if folder:
                out = stage_table(out, f"{folder}/{s.order:02d}-{s.name}")
            else:
                out = out.persist()  # read by its counts and by the next stage
                self._kept.append(out)
            self.seconds[s.name] = time.monotonic() - began
            traced.append((s.name, out))
            docs = out.where("status = 'success'").drop("status")
        return docs, traced

    def release(self) -> None:
        for df in self._kept:
            df.unpersist()
        self._kept.clear()


def stage_counts(traced: list[tuple[str, DataFrame]]) -> DataFrame:
    """(stage, status, n) of a run."""
    parts = [df.groupBy("status").agg(F.count("*").alias("n")).select(F.lit(name).alias("stage"), "status", "n") for name, df in traced]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def stage_totals(counts: DataFrame) -> DataFrame:
    """(stage, total_in, total_out, filtered, failed): filtered is what did not come out, failed rows included."""
    n = lambda s: F.coalesce(F.sum(F.when(F.col("status") == s, F.col("n"))), F.lit(0))
    return counts.groupBy("stage").agg(F.sum("n").alias("total_in"), n("success").alias("total_out"), (F.sum("n") - n("success")).alias("filtered"), n("failed").alias("failed"))


def progress(done, total):
    """Per cent done; 0 without a total."""
    return F.when(total > 0, done / total * 100.0).otherwise(0.0)


# --- a graph of named tables ---------------------------------------------------------------------------------------
@dataclass
class Node:
    name: str
    make: Callable[..., DataFrame]  # takes the tables it needs, in turn
    needs: list[str] = field(default_factory=list)
    on_failure: str = "stop"  # or skip: the node and all that need it are left out


def run_graph(spark: SparkSession, nodes: list[Node], folder: str, inputs: dict[str, DataFrame] | None = None) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Tables by name, each written to folder/name, and the state of each node: done, read (from an earlier run), failed, skipped.

    A node runs when all it needs are there. The states are written to folder/_states.json after each node.
    """
    tables, states, left = dict(inputs or {}), {}, list(nodes)
    unknown = {n for node in nodes for n in node.needs} - {n.name for n in nodes} - set(tables)
    if unknown:
        raise ValueError(f"nobody makes {sorted(unknown)}")
    while left:
        ready = [n for n in left if all(x in tables or states.get(x) in ("failed", "skipped") for x in n.needs)]
        if not ready:
            raise ValueError(f"nodes need each other: {sorted(n.name for n in left)}")
        for node in ready:
            left.remove(node)
            if any(states.get(x) in ("failed", "skipped") for x in node.needs):
                states[node.name] = "skipped"
                continue
            path = f"{folder}/{node.name}"
            try:
                states[node.name] = "read" if finished(spark, path) else "done"
                tables[node.name] = spark.read.parquet(path) if states[node.name] == "read" else stage_table(node.make(*[tables[x] for x in node.needs]), path)
            except Exception:
                if node.on_failure != "skip":
                    raise
                log.exception("node %s failed and is left out", node.name)
                states[node.name] = "failed"
            _save(spark, f"{folder}/_states.json", json.dumps(states))
    return tables, states


def _save(spark: SparkSession, path: str, text: str) -> None:
    target = _file(spark, path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def default_pipeline() -> CleaningPipeline:
    """Text cleaning, exact dedup, personal data, quality and toxicity, in this order (numbers leave room for images, 2)."""

    def text(df: DataFrame) -> DataFrame:
        return clean.clean(df).select("doc_id", F.coalesce("content", "text").alias("text"), "status")

    def dedup_(df: DataFrame) -> DataFrame:
        return dedup.marked(df).withColumn("status", F.when(F.col("is_duplicate"), "filtered").otherwise("success")).drop("is_duplicate", "duplicate_of")

    def pii(df: DataFrame) -> DataFrame:
        return df.withColumns({"text": U.anonymize("replace")(F.col("text")), "status": F.lit("success")})

    def quality(df: DataFrame) -> DataFrame:
        return T.with_words(df).withColumn("status", F.when(T.filter_scores(F.col("text"))["overall"] >= 0.5, "success").otherwise("filtered")).drop("_w", "_lw")

    def toxic(df: DataFrame) -> DataFrame:
        return df.withColumn("status", F.when(T.toxicity(F.col("text"))["is_toxic"], "filtered").otherwise("success"))

    return CleaningPipeline([Stage("text", text, 1), Stage("dedup", dedup_, 3), Stage("pii", pii, 4), Stage("quality", quality, 5), Stage("toxicity", toxic, 6)])
