"""The corpus pipeline: quality, language, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet into the shared
folder and reads it as the next stage's docs. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm import language_id, packing, quality, simhash_dedup, suffix_dedup
from sparkloom.llm.common import table, written
from sparkloom.llm.queries import vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Null texts are scored as empty; repeated rows share their fate; an id with both labels counts as label 0. Without
    labels nothing is rejected. An empty table gives no rows.
    """
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier calls with enough probability.

    Null texts and texts without a letter go; repeated rows share their fate. Without a language to learn all go. An
    empty table gives no rows.
    """
    return language_id.keep(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (shingles of five words, similarity 0.8 or more): the one of smallest doc_id.

    Groups are decided on whole texts, row by row: of equal ids the first row of the input stays, null ids come last.
    Texts without words (null, empty) are copies of each other. An empty table gives no rows.
    """
    return simhash_dedup.keep_similar(docs, shingle=5, similarity=0.8)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that repeated strings of over 50 words, or of 400 bytes and more, cover.

    Null texts stay null; rows that repeat a text of that length lose it; no row goes. n_chars is counted anew. An empty
    table gives no rows.
    """
    return suffix_dedup.keep(docs, words=51)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens.

    A null or empty text is one piece, its end token; repeated rows are packed each. An empty table gives no rows.
    """
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality", quality_stage), ("language", language_stage), ("near_duplicates", near_duplicate_stage), ("passages", passage_stage), ("packing", packing_stage)]

#: Trained models, fingerprints and tokenizers have no SQL form; tests hold the stages against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
