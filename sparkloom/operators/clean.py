"""The text cleaner: ordered rules, the first failure decides; no row is dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import fixed as X
from sparkloom.functions import text as T
from sparkloom.functions import udf as U


def outcome(raw, content, perplexity=None, education: float | None = None):
    """(status, reason) by the rules on the raw text and on the cleaned content; the last two rules are off by default."""
    bad_raw = (F.length(T.strip(raw)) < X.MIN_STRIPPED) | (F.length(raw) > X.MAX_LENGTH)
    bad_length = ~F.length(content).between(X.MIN_LENGTH, X.MAX_LENGTH)
    reason = (
        F.when(F.coalesce(raw, F.lit("")) == "", "empty_text").when(bad_raw, "validation_failed").when(F.length(content) == 0, "division by zero")
        .when(~T.language_by_share(content).isin(X.LANGUAGES), "language_filtered").when(bad_length, "length_filtered")
    )
    if perplexity is not None:
        reason = reason.when(perplexity > X.MOST_PERPLEXITY, "perplexity_filtered")
    if education is not None:
        reason = reason.when(T.education(content) < education, "quality_filtered")
    status = F.when(reason.isNull(), "success").when(reason == "division by zero", "failed").otherwise("filtered")
    return status, reason


def statuses(docs: DataFrame) -> DataFrame:
    """status and reason by the rules that need no rewriting of the text (built-ins only)."""
    status, reason = outcome(F.col("text"), F.col("text"))
    return docs.withColumns({"status": status, "reason": reason})


def clean(docs: DataFrame, quotes: bool = False, perplexity=None, education: float | None = None) -> DataFrame:
    """docs with content, status, reason, cleaning_steps and metadata. Rows that fail on the raw text skip the rewriting.

    perplexity: a function from the content's column to a column (a model's), or None for no such rule; education: the
    least education score, or None.
    """
    early, _ = outcome(F.col("text"), F.lit("x" * X.MIN_LENGTH))
    out = docs.withColumn("content", U.rewrite(quotes)(F.when(early == "success", F.col("text"))))
    content = F.coalesce("content", "text")
    scored = perplexity(F.col("content")) if perplexity else None
    status, reason = outcome(F.col("text"), content, scored, education)
    out = out.withColumns({"status": status, "reason": reason})
    none = F.array().cast("array<string>")
    done = F.array(*map(F.lit, ("remove_html_tags", "remove_boilerplate", "normalize_unicode", "remove_repetitions")))
    step = lambda name, value, upto: F.when((F.length("content") > 0) & F.coalesce(~F.col("reason").isin(*upto), F.lit(True)), F.array(F.concat(F.lit(f"{name}:"), value))).otherwise(none)
    more = [step("language_detection", T.language_by_share(F.col("content")), [""])]
    if perplexity:
        more.append(step("perplexity_filter", F.format_string("%.2f", scored), ["language_filtered", "length_filtered"]))
    if education is not None:
        more.append(step("education_score", F.format_string("%.2f", T.education(F.col("content"))), ["language_filtered", "length_filtered", "perplexity_filtered"]))
    steps = F.when(F.col("reason").isin("empty_text", "validation_failed"), none).otherwise(F.concat(done, *more))
    words = F.size(T.words(F.col("content")))
    return out.withColumns({"cleaning_steps": steps, "metadata": F.when(F.col("status") == "success", F.struct(F.length("content").alias("length"), words.alias("word_count"), F.length("content").alias("char_count")))})


def quality_predicate(content, perplexity=None, education: float | None = None):
    """Whether a text passes length, language and, if given, perplexity and education (the cleaner's filter_quality)."""
    ok = F.length(content).between(X.MIN_LENGTH, X.MAX_LENGTH) & T.language_by_share(content).isin(X.LANGUAGES)
    if perplexity is not None:
        ok = ok & (perplexity <= X.MOST_PERPLEXITY)
    if education is not None:
        ok = ok & (T.education(content) >= education)
    return F.coalesce(ok, F.lit(False))


def perplexity_of(log10_score, words):
    """10 to the minus mean log10 probability of a word; infinite without words."""
    return F.when(words > 0, F.pow(F.lit(10.0), -log10_score / words)).otherwise(F.lit(float("inf")))


def raw_validity(docs: DataFrame) -> DataFrame:
    """Whether a text item is valid to collect."""
    return docs.withColumn("valid", F.col("doc_id").isNotNull() & F.coalesce(F.length(T.strip(F.col("text"))) >= 10, F.lit(False)))


def image_text_validity(docs: DataFrame) -> DataFrame:
    """Whether an image with its caption is valid: bytes of an allowed size, and a caption of 10 to 1000 characters."""
    size, caption = F.octet_length("image"), F.length(T.strip(F.col("caption")))
    return docs.withColumn("valid", F.coalesce(size.between(X.LEAST_BYTES, X.MOST_BYTES) & caption.between(*X.CAPTION_CHARS), F.lit(False)))


def batch_stats(cleaned: DataFrame, score: str | None = None) -> DataFrame:
    """One row: total, success, filtered, failed and their rates; 0 when empty.

    With a score column also average_quality: the sum of all scores over the number of successes.
    """
    n = F.count("*")
    rate = lambda s: F.coalesce(F.try_divide(F.count_if(F.col("status") == s), n), F.lit(0.0))
    return cleaned.agg(n.alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in ("success", "filtered", "failed")], rate("success").alias("success_rate"), rate("filtered").alias("filter_rate"), *([F.coalesce(F.try_divide(F.sum(score), F.count_if(F.col("status") == "success")), F.lit(0.0)).alias("average_quality")] if score else []))


def summary(cleaned: DataFrame) -> DataFrame:
    """(status, n) over all batches so far."""
    return cleaned.groupBy("status").agg(F.count("*").alias("n"))
