"""Validation of tables: schema, required values, types, rules, completeness, anomalies; none needs a second pass per rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkloom.functions import text as T


def schema_problems(df: DataFrame, wanted: str) -> list[str]:
    """Columns that are missing, of another type, or not asked for (no job runs)."""
    has = {f.name: f.dataType.simpleString() for f in df.schema}
    asked = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(wanted)}
    out = [f"missing: {n}" for n in asked if n not in has]
    out += [f"type: {n} is {has[n]}, not {t}" for n, t in asked.items() if n in has and has[n] != t]
    return out + [f"extra: {n}" for n in has if n not in asked]


def converted(df: DataFrame, wanted: str) -> DataFrame:
    """The asked columns with the asked types; values that can't be converted become null."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in StructType.fromDDL(wanted)])


def issues(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """df with ``issues``: names of the rules that a row breaks (a rule that is null is broken)."""
    return df.withColumn("issues", F.array_compact(F.array(*[F.when(~F.coalesce(rule, F.lit(False)), name) for name, rule in rules.items()])))


def issue_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(issue, n) over all rows."""
    return issues(df, rules).select(F.explode(T.made_once("issues")).alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))


def passing(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that keep all rules: one condition, so that Spark can push its parts down."""
    return df.where(reduce(lambda a, b: a & b, [F.coalesce(r, F.lit(False)) for r in rules.values()]))


def completeness(df: DataFrame) -> DataFrame:
    """One row: the share of values that are not null of each column."""
    return df.agg(*[F.round(F.coalesce(F.try_divide(F.count(c), F.count(F.lit(1))), F.lit(0.0)), 6).alias(c) for c in df.columns])


def distribution(df: DataFrame, value: str, group: str) -> DataFrame:
    """(group, n, mean, spread, p25, p50, p75) of a number."""
    q = lambda p: F.round(F.percentile(value, p), 6)
    return df.groupBy(group).agg(F.count(value).alias("n"), F.round(F.avg(value), 6).alias("mean"), F.round(F.stddev_samp(value), 6).alias("spread"), q(0.25).alias("p25"), q(0.5).alias("p50"), q(0.75).alias("p75"))


def anomalies(df: DataFrame, value: str, group: str, far: float = 1.5) -> DataFrame:
    """Rows whose number lies over ``far`` spreads between the quartiles beyond them, within their group (a small joined table)."""
    edges = df.groupBy(group).agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.75))).alias("_q"))
    out = df.join(edges, group)
    low, high = F.col("_q")[0], F.col("_q")[1]
    return out.where((F.col(value) < low - far * (high - low)) | (F.col(value) > high + far * (high - low))).drop("_q")


def digest_matches(data: Column, digest: Column) -> Column:
    """Whether bytes have the SHA-256 or, by its length, the MD5 that is given."""
    return F.when(F.length(digest) == 32, F.md5(data) == F.lower(digest)).otherwise(F.sha2(data, 256) == F.lower(digest))
