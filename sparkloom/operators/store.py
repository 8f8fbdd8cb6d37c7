"""The dataset catalog: data items, lookups, statistics, upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def items_from(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """data_items of documents: quality_score is the label (null without one)."""
    score = labels.groupBy("doc_id").agg(F.max("quality").cast("double").alias("quality_score"))
    status = F.when(F.length("text") >= 50, "cleaned").otherwise("raw")
    return docs.join(score, "doc_id", "left").select(F.col("doc_id").cast("string").alias("item_id"), F.col("source").alias("dataset"), F.lit("text").alias("data_type"), F.sha2("text", 256).alias("content_hash"), status.alias("status"), "quality_score")


def query_items(items: DataFrame, equal: dict | None = None, low: float | None = None, high: float | None = None, limit: int = 100, offset: int = 0) -> DataFrame:
    """Items by equal columns and a range of scores, by id descending, a page of them."""
    for column, value in (equal or {}).items():
        items = items.where(F.col(column) == value)
    if low is not None:
        items = items.where(F.col("quality_score") >= low)
    if high is not None:
        items = items.where(F.col("quality_score") <= high)
    return items.orderBy(F.col("item_id").desc()).offset(offset).limit(limit)


def statistics(items: DataFrame) -> DataFrame:
    """One row a dataset: number, by status, mean score (0 without scores), in one pass."""
    return items.groupBy("dataset").agg(F.count("*").alias("total_items"), F.count_if(F.col("status") == "raw").alias("raw_items"), F.count_if(F.col("status") == "cleaned").alias("cleaned_items"), F.round(F.coalesce(F.avg("quality_score"), F.lit(0.0)), 6).alias("avg_quality"))


def histogram(items: DataFrame, column: str = "quality_score") -> DataFrame:
    """Five half-open buckets of a score; the last takes all from 0.8 on, empty ones are absent."""
    c = F.col(column)
    bucket = F.when(c < 0.2, "0.0-0.2").when(c < 0.4, "0.2-0.4").when(c < 0.6, "0.4-0.6").when(c < 0.8, "0.6-0.8").otherwise("0.8-1.0")
    return items.where(c.isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


def upsert(old: DataFrame, new: DataFrame, key: str, replaced: list[str]) -> DataFrame:
    """New rows by key; of rows in both only the replaced columns change."""
    names = [c for c in old.columns if c != key]
    a, b = old.alias("a"), new.alias("b")
    hit_old, hit_new = F.col(f"a.{key}").isNotNull(), F.col(f"b.{key}").isNotNull()
    value = lambda c: F.when(hit_new & (F.lit(c in replaced) | ~hit_old), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c)
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer").select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), *map(value, names))


def merge_metadata(old, new):
    """Shallow merge of two maps; the new value wins."""
    return F.map_concat(F.map_filter(F.coalesce(old, F.create_map().cast("map<string,string>")), lambda k, _: ~F.array_contains(F.map_keys(F.coalesce(new, F.create_map().cast("map<string,string>"))), k)), F.coalesce(new, F.create_map().cast("map<string,string>")))


def delete_dataset(items: DataFrame, name: str) -> DataFrame:
    return items.where(~F.col("dataset").eqNullSafe(F.lit(name)))


def by_status(items: DataFrame) -> DataFrame:
    """(dataset, total, statuses, types): counts by status and by type as maps, in two narrow aggregations."""
    counted = lambda c: items.groupBy("dataset", c).agg(F.count("*").alias("n")).groupBy("dataset").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(c), F.col("n"))))).alias(f"by_{c}"))
    total = items.groupBy("dataset").agg(F.count("*").alias("total"))
    return total.join(counted("status"), "dataset").join(counted("data_type"), "dataset")


DATASETS = "dataset_id string, name string, data_type string, description string, metadata map<string,string>, created_at timestamp, updated_at timestamp"
ITEMS = "item_id string, dataset_id string, data_type string, storage_path string, content_hash string, status string, quality_score double, labels string, metadata map<string,string>, created_at timestamp, updated_at timestamp"


def create_tables(spark: SparkSession, database: str, form: str = "parquet") -> None:
    """The two catalog tables, if they are not there."""
    spark.sql(f"create database if not exists {database}")
    for name, columns in (("datasets", DATASETS), ("data_items", ITEMS)):
        spark.sql(f"create table if not exists {database}.{name} ({columns}) using {form}")


def register(old: DataFrame, new: DataFrame) -> DataFrame:
    """Datasets by name: of one that is there already the description, metadata and time change; its id, type and creation stay."""
    return upsert(old, new, "name", ["description", "metadata", "updated_at"]).select(*old.columns)


def update_status(items: DataFrame, changes: DataFrame) -> DataFrame:
    """items with the status of changes (item_id, status, metadata) and both metadata merged, the new value winning."""
    c = changes.select(F.col("item_id").alias("_id"), F.col("status").alias("_status"), F.col("metadata").alias("_metadata"))
    out = items.join(c, F.col("item_id") == F.col("_id"), "left")
    hit = F.col("_id").isNotNull()
    return out.withColumns({"status": F.when(hit, F.col("_status")).otherwise(F.col("status")), "metadata": F.when(hit, merge_metadata(F.col("metadata"), F.col("_metadata"))).otherwise(F.col("metadata"))}).select(*items.columns)


def cascade(datasets: DataFrame, items: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Both tables without a dataset and its items."""
    gone = datasets.where(F.col("name") == name).select("dataset_id")
    return datasets.where(~F.col("name").eqNullSafe(F.lit(name))), items.join(F.broadcast(gone), "dataset_id", "left_anti")


def point_lookup(items: DataFrame, key: str, value: str) -> DataFrame:
    """The row of a key, if there is one; the condition reaches the scan."""
    return items.where(F.col(key) == value)
