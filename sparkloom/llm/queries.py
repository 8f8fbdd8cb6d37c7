"""The registered queries of the training-data operators: thin, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm import bpe, embedding_dedup, fingerprints, language_id, lm_scoring, packing, quality, simhash_dedup, suffix_dedup, url_filter
from sparkloom.llm.common import table


def vocabulary(name: str) -> str:
    """Place of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every whole document, as digests. Null: empty text, no ids; rows repeat alike."""
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and automaton scores of every whole document, learnt from six of seven folds. Null: the end token alone; null ids are not learnt from."""
    return lm_scoring.query(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in sequences of at most 2048 ids. Null: the end id alone; repeated rows are packed each."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how many others lie within the radius. Null: empty, fingerprint zero; null ids come last."""
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document, learnt from three of four folds. Null and letterless texts: und, score 0."""
    return language_id.query(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole document, learnt from the labels of four of five folds. Null: scored as empty; an id with both labels counts as 0."""
    return quality.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings of equal label. Null, zero and non-finite vectors, and null labels, link with nothing."""
    return embedding_dedup.query(table(spark, sf_dir, "embeddings"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that a repeated string of 400 bytes covers (n_repeated: or one of 51 words). Null: no bytes; repeated rows repeat each other."""
    return suffix_dedup.query(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over the whole documents table."""
    from corpus_pipeline import run

    return run(spark, sf_dir)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url. Null and urls without ://: both empty, the model's verdict on nothing."""
    weights = url_filter.train(url_filter.labelled_table(spark))
    return url_filter.judge(table(spark, sf_dir, "pages"), weights)


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash and component of every whole document. No words: fingerprint zero, linked like any other; rows of one id share a component."""
    return simhash_dedup.query(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_lm_scoring, op2_packing, op3_bpe_roundtrip, op4_fingerprints, op5_language_id, op6_quality, op7_embedding_dedup, op8_suffix_dedup, op9_url_filter, op10_simhash_dedup, pipeline)}

#: op7 alone has a SQL form: a self-join by label, and components by recursion. The others are held against brute force
#: in tests/llm: hashes, tokenizers, trained models and packing have none.
ORACLE_SQL: dict[str, str] = {
    "op7_embedding_dedup": """
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
p as (select a.vec_id as u, b.vec_id as w from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.98),
r(u, c) as (select vec_id, vec_id from embeddings union select p.w, r.c from r join p on r.u = p.u),
n as (select u, count(*) as n_links from p group by 1)
select r.u as vec_id, coalesce(any_value(n_links), 0)::bigint as n_links, min(c) as component_id, min(c) = r.u as kept from r left join n on n.u = r.u group by r.u
"""
}
