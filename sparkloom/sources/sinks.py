"""Sinks: item batches, exports, annotation formats, reports, deletion."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import fixed as X


def save_items(items: DataFrame, folder: str) -> DataFrame:
    """Write items by type below folder and return the one-row save result: total, saved and failed, counted while writing.

    An item without an id, type or content fails: it goes to folder/_failed with its reason, the others are written.
    """
    reason = F.when(F.coalesce("item_id", F.lit("")) == "", "no id").when(F.coalesce("data_type", F.lit("")) == "", "no type").when(F.col("text").isNull(), "no content")
    marked = items.withColumn("_reason", reason)
    seen = Observation()
    good = marked.where("_reason is null").drop("_reason").withColumn("content_hash", F.sha2("text", 256)).observe(seen, F.count(F.lit(1)).alias("saved"))
    good.write.mode("append").partitionBy("data_type").parquet(folder)
    lost = Observation()
    marked.where("_reason is not null").observe(lost, F.count(F.lit(1)).alias("failed")).write.mode("append").parquet(f"{folder.rstrip('/')}_failed")
    saved, failed = seen.get["saved"], lost.get["failed"]
    return items.sparkSession.createDataFrame([(saved + failed, saved, failed)], "total bigint, saved bigint, failed bigint")


def export(df: DataFrame, folder: str, kind: str) -> None:
    """JSON, JSONL, Parquet, CSV or XML files; JSON: each file is an array, a row for each partition."""
    writer = df.write.mode("overwrite")
    if kind == "json":
        rows = df.select(F.to_json(F.struct(*df.columns)).alias("j"), F.spark_partition_id().alias("p"))
        arrays = rows.groupBy("p").agg(F.concat(F.lit("["), F.array_join(F.collect_list("j"), ","), F.lit("]")).alias("value"))
        arrays.select("value").write.mode("overwrite").text(folder)
        return
    {"jsonl": writer.json, "parquet": writer.parquet, "csv": lambda p: writer.option("header", True).csv(p), "xml": lambda p: writer.option("rowTag", "row").format("xml").save(p)}[kind](folder)


# --- boxes in images: (image_id, file_name, width, height, boxes array<struct<label, x, y, width, height>>) ---------
def yolo_lines(box_label: Column, boxes: Column, width: Column, height: Column) -> Column:
    """A line for each box: class number, middle and size as shares of the image. box_label: map from label to number."""
    n = lambda x: F.format_number(x, 6)
    line = lambda b: F.concat_ws(" ", F.try_element_at(box_label, b["label"]).cast("string"), n((b["x"] + b["width"] / 2) / width), n((b["y"] + b["height"] / 2) / height), n(b["width"] / width), n(b["height"] / height))
    return F.array_join(F.transform(boxes, line), "\n")


def yolo(images: DataFrame, labels: list[str]) -> DataFrame:
    """(file_name, text): the label file of each image."""
    table = F.create_map(*[F.lit(x) for i, name in enumerate(labels) for x in (name, i)])
    return images.select(F.regexp_replace("file_name", r"\.[^.]*$", ".txt").alias("file_name"), yolo_lines(table, F.col("boxes"), F.col("width"), F.col("height")).alias("text"))


def coco(images: DataFrame, labels: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables of the format: images, annotations (a row for each box) and categories."""
    spark = images.sparkSession
    table = F.create_map(*[F.lit(x) for i, name in enumerate(labels) for x in (name, i + 1)])
    rows = images.select("image_id", F.posexplode("boxes").alias("place", "b"))
    annotations = rows.select((F.col("image_id") * 100_000 + F.col("place")).alias("id"), "image_id", F.try_element_at(table, F.col("b.label")).alias("category_id"), F.array("b.x", "b.y", "b.width", "b.height").alias("bbox"), (F.col("b.width") * F.col("b.height")).alias("area"), F.lit(0).alias("iscrowd"))
    categories = spark.createDataFrame([(i + 1, name) for i, name in enumerate(labels)], "id int, name string")
    return images.select(F.col("image_id").alias("id"), "file_name", "width", "height"), annotations, categories


def voc(images: DataFrame) -> DataFrame:
    """(file_name, text): the XML annotation of each image."""
    box = lambda b: F.concat(F.lit("<object><name>"), b["label"], F.lit("</name><bndbox><xmin>"), F.floor(b["x"]).cast("string"), F.lit("</xmin><ymin>"), F.floor(b["y"]).cast("string"), F.lit("</ymin><xmax>"), F.floor(b["x"] + b["width"]).cast("string"), F.lit("</xmax><ymax>"), F.floor(b["y"] + b["height"]).cast("string"), F.lit("</ymax></bndbox></object>"))
    text = F.concat(F.lit("<annotation><filename>"), "file_name", F.lit("</filename><size><width>"), F.col("width").cast("string"), F.lit("</width><height>"), F.col("height").cast("string"), F.lit("</height></size>"), F.array_join(F.transform("boxes", box), ""), F.lit("</annotation>"))
    return images.select(F.regexp_replace("file_name", r"\.[^.]*$", ".xml").alias("file_name"), text.alias("text"))


# --- reports and objects -------------------------------------------------------------------------------------------
def markdown(df: DataFrame, rows: int = 100) -> str:
    """A small result as a Markdown table (the first ``rows`` of it)."""
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "-|" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join(map(str, r)) + " |" for r in df.take(rows))])


def report(parts: dict[str, DataFrame], rows: int = 100) -> dict[str, str]:
    """A JSON and a Markdown report of small results by title."""
    data = {title: [r.asDict(recursive=True) for r in df.take(rows)] for title, df in parts.items()}
    text = "\n\n".join(f"## {title}\n\n{markdown(df, rows)}" for title, df in parts.items())
    return {"json": json.dumps(data, default=str, ensure_ascii=False), "markdown": text}


def put(spark: SparkSession, path: str, data: bytes) -> tuple[str, int]:
    """Store one object, in place of what was there; its MIME type by the name's end, and its size."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    end = re.search(r"\.[^./]*$", path)
    return X.MIME.get(end[0].lower() if end else "", X.MIME_DEFAULT), len(data)


def delete(spark: SparkSession, paths: list[str]) -> dict[str, bool]:
    """Delete objects and tell for each whether it was there and went."""
    conf, out = spark._jsc.hadoopConfiguration(), {}
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        out[p] = bool(path.getFileSystem(conf).delete(path, True))
    return out
