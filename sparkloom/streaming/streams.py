"""Structured Streaming: ingest, stateful dedup, running counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import text as T


def documents(spark: SparkSession, folder: str, schema, files: int = 8) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def dedup(stream: DataFrame, time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """First row of each content; with an event time, state is dropped once the watermark has passed."""
    keyed = stream.withColumn("content_hash", F.sha2("text", 256))
    if time:
        return keyed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["content_hash"])
    return keyed.dropDuplicates(["content_hash"])


def running_languages(stream: DataFrame) -> DataFrame:
    return stream.groupBy(T.language_by_presence(F.col("text")).alias("language")).count()


def windowed_counts(stream: DataFrame, time: str, window: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    return stream.withWatermark(time, delay).groupBy(F.window(time, window)).agg(F.count("*").alias("n"))


def topics(spark: SparkSession, servers: str, names: list[str], start: str = "earliest", most: int | None = None) -> DataFrame:
    """(topic, key, text, timestamp) of Kafka topics; offsets are kept in the query's checkpoint. Needs the connector's package."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(names)).option("startingOffsets", start)
    reader = reader.option("maxOffsetsPerTrigger", most) if most else reader
    return reader.load().select("topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("text"), "timestamp")


def running_counts(stream: DataFrame, column: str) -> DataFrame:
    return stream.groupBy(column).agg(F.count("*").alias("n"))


def near_dedup(stream: DataFrame, folder: str, checkpoint: str):
    """Write the documents (doc_id, text) of a stream that share no MinHash band with an earlier one, batch by batch.

    folder/bands holds the bands of all kept documents, folder/kept the documents; both are written under their batch's
    number, so a batch that is run again replaces itself.
    """
    from sparkloom.operators import dedup as D

    spark = stream.sparkSession

    def one(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            bands = D.minhash_bands(batch)
            old = _earlier(spark, f"{folder}/bands", number)
            fresh = bands.join(bands.join(old, ["band", "key"], "left_semi").select("doc_id").distinct(), "doc_id", "left_anti") if old is not None else bands
            met = batch.join(bands.select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id").union(fresh.select("doc_id").distinct())  # texts without words have no bands
            groups = D.settle(met, D.near_links(fresh))
            firsts = groups.where("doc_id = component").select("doc_id")
            batch.join(firsts, "doc_id", "left_semi").write.mode("overwrite").parquet(f"{folder}/kept/batch={number}")
            fresh.join(firsts, "doc_id", "left_semi").select("band", "key").write.mode("overwrite").parquet(f"{folder}/bands/batch={number}")
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)


def _earlier(spark: SparkSession, folder: str, number: int) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.parquet(folder).where(F.col("batch") < number).select("band", "key")
