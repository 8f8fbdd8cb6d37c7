"""Labelers: quality, safety, questions and answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import fixed as X
from sparkloom.functions import text as T


def quality(docs: DataFrame) -> DataFrame:
    scores = T.scorer_scores(F.col("text"))
    out = T.with_words(docs).select("doc_id", *[v.alias(k) for k, v in scores.items()])
    return out.withColumn("label_status", F.when(F.col("overall") >= X.SCORER_PASS, "completed").otherwise("needs_review"))


def safety(docs: DataFrame) -> DataFrame:
    """Risk scores, whether all are under the limit, the first largest risk, and the confidence."""
    kinds = {"nsfw": "sexual_content", "violence": "violence", "hate_speech": "hate_speech", "self_harm": "self_harm", "sexual_content": "sexual_content"}
    out = docs.select("doc_id", *[T.risk(F.col("text"), words).alias(k) for k, words in kinds.items()]).withColumn("worst", F.greatest(*kinds))
    primary = F.coalesce(*[F.when((F.col("worst") > 0) & (F.col(k) == F.col("worst")), k) for k in kinds])
    safe = F.col("worst") < X.RISK_THRESHOLD
    return out.withColumns({"primary_risk": primary, "is_safe": safe, "confidence": F.when(safe, 1 - F.col("worst")).otherwise(F.col("worst"))})


def image_safety(items: DataFrame) -> DataFrame:
    """Constant risks of images (no model here): safe, no primary risk."""
    return items.withColumns({"risks": F.create_map(*[F.lit(x) for p in X.IMAGE_RISKS.items() for x in p]), "is_safe": F.lit(True), "primary_risk": F.lit(None).cast("string"), "confidence": F.lit(X.IMAGE_CONFIDENCE)})


def merged_risks(a: Column, b: Column) -> Column:
    """Two maps of risks by name; the greater of both, a missing one counts as 0."""
    return F.map_zip_with(a, b, lambda _, x, y: F.greatest(F.coalesce(x, F.lit(0.0)), F.coalesce(y, F.lit(0.0))))


def multimodal_safety(docs: DataFrame) -> DataFrame:
    """Text and image assessments merged: greater risk, safe if both are, the text's primary risk first, lesser confidence."""
    kinds = ["nsfw", "violence", "hate_speech", "self_harm", "sexual_content"]
    out = image_safety(safety(docs).withColumnsRenamed({"is_safe": "_safe", "primary_risk": "_primary", "confidence": "_confidence"}))
    own = F.create_map(*[x for k in kinds for x in (F.lit(k), F.col(k))])
    return out.select("doc_id", merged_risks(own, F.col("risks")).alias("risks"), (F.col("_safe") & F.col("is_safe")).alias("is_safe"), F.coalesce("_primary", "primary_risk").alias("primary_risk"), F.least("_confidence", "confidence").alias("confidence"))


def dimensions(docs: DataFrame, wanted: list[str], modality: str = "text") -> DataFrame:
    """docs (doc_id, text) with dims, an array of (name, score): those asked for, in the scorer's order; none for an empty text."""
    scores = {k: v for k, v in T.scorer_scores(F.col("text")).items() if k != "overall"} if modality != "image" else {}
    if modality != "text":
        scores |= {k: F.lit(v) for k, v in X.SCORER_IMAGE.items() if modality == "multimodal" or k != "alignment"}
    of = lambda k: F.struct(F.lit(k).alias("name"), scores[k].alias("score"))
    some = [of(k) for k in scores if k in wanted]
    none = F.array().cast("array<struct<name:string,score:double>>")
    dims = F.array(*some) if some else none
    return T.with_words(docs).select("doc_id", F.when((F.length("text") > 0) | F.lit(modality == "image"), dims).otherwise(none).alias("dims"))


# --- labels as data ------------------------------------------------------------------------------------------------
LABEL = "array<struct<label_type:string,label_value:string,confidence:double>>"


def unlabelled(items: DataFrame) -> DataFrame:
    return items.withColumns({"labels": F.array().cast(LABEL), "label_status": F.lit("pending"), "errors": F.array().cast("array<string>")})


def add_label(items: DataFrame, kind: str, value: Column, confidence: Column) -> DataFrame:
    """items with one label more; a pending item is completed by its first."""
    new = F.struct(F.lit(kind).alias("label_type"), value.cast("string").alias("label_value"), confidence.cast("double").alias("confidence"))
    return items.withColumns({"labels": F.array_append("labels", new), "label_status": F.when(F.col("label_status") == "pending", "completed").otherwise(F.col("label_status"))})


def get_label(labels: Column, kind: str) -> Column:
    """The first label of a type, or null."""
    return F.get(get_labels(labels, kind), F.lit(0))


def get_labels(labels: Column, kind: str) -> Column:
    return F.filter(labels, lambda x: x["label_type"] == kind)


def chained(items: DataFrame, labelers: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Labelers by name, one after the other; each gets the items with all labels so far and adds its own."""
    for label_with in labelers.values():
        items = label_with(items)
    return items


def quality_labels(items: DataFrame) -> DataFrame:
    overall = T.scorer_scores(F.col("text"))["overall"]
    out = add_label(T.with_words(items), "quality", F.format_string("%.4f", overall), overall)
    return out.withColumn("label_status", F.when(overall < X.SCORER_PASS, "needs_review").otherwise(F.col("label_status"))).drop("_w", "_lw")


def safety_labels(items: DataFrame) -> DataFrame:
    """A safety label; texts over the limit need a review."""
    kinds = ("sexual_content", "violence", "hate_speech", "self_harm")
    worst = F.greatest(*[T.risk(F.col("text"), k) for k in kinds])
    safe = worst < X.RISK_THRESHOLD
    out = add_label(items, "safety", F.when(safe, "safe").otherwise("unsafe"), F.when(safe, 1 - worst).otherwise(worst))
    return out.withColumn("label_status", F.when(~safe, "needs_review").otherwise(F.col("label_status")))


def labeling_statistics(items: DataFrame) -> DataFrame:
    """One row: items, completed, failed, success rate (over one at least), labels for each item."""
    n = F.count("*")
    done = F.count_if(F.col("label_status") == "completed")
    return items.agg(n.alias("total"), done.alias("completed"), F.count_if(F.col("label_status") == "failed").alias("failed"), F.round(done / F.greatest(n, F.lit(1)), 6).alias("success_rate"), F.round(F.coalesce(F.sum(F.size("labels")), F.lit(0)) / F.greatest(n, F.lit(1)), 6).alias("avg_labels"))


def label_distribution(items: DataFrame) -> DataFrame:
    """(label_type, n) over all labels of all items."""
    return items.select(F.explode(T.made_once("labels")).alias("l")).groupBy("l.label_type").agg(F.count("*").alias("n"))


def voted(labels: DataFrame, item: str = "item_id", value: str = "label_value") -> DataFrame:
    """(item, winner, votes, share): the most frequent value of each item; the smallest of equals."""
    counts = labels.groupBy(item, value).agg(F.count("*").alias("votes"))
    best = F.max(F.struct("votes", F.lit(0).alias("tie"))).alias("top")
    top = counts.groupBy(item).agg(best, F.sum("votes").alias("all"))
    tied = counts.join(top, item).where(F.col("votes") == F.col("top.votes"))
    return tied.groupBy(item).agg(F.min(value).alias("winner"), F.max("votes").alias("votes"), F.max(F.col("votes") / F.col("all")).alias("share"))


# --- captions ------------------------------------------------------------------------------------------------------
def captions(images: DataFrame, model: str = "generic", language: str = "en", count: int = 1) -> DataFrame:
    """(image_id, status, captions): captions of a model's hook (constant here), tidied, of allowed length and confidence; images without bytes fail."""
    text, confidence = X.CAPTION_MODELS.get(model, X.CAPTION_MODELS["generic"])
    one = F.struct(T.tidy_caption(F.lit(text), language).alias("text"), F.lit(confidence).alias("confidence"))
    kept = valid_captions(F.array_repeat(one, count))
    has = F.col("data").isNotNull() & (F.octet_length("data") > 0)
    return images.select("image_id", F.when(has & (F.size(kept) > 0), "completed").otherwise("failed").alias("status"), F.when(has, kept).otherwise(F.array().cast("array<struct<text:string,confidence:double>>")).alias("captions"))


def valid_captions(found: Column) -> Column:
    """Captions (text, confidence) of allowed length that are confident enough."""
    return F.filter(found, lambda c: F.length(c["text"]).between(*X.CAPTION_LENGTHS) & (c["confidence"] >= X.CAPTION_CONFIDENCE))


# --- questions and answers -----------------------------------------------------------------------------------------
def question_arrays(docs: DataFrame, most: int = X.QUESTIONS) -> DataFrame:
    """(doc_id, qa_status, qa_error, pairs): heuristic question-answer pairs of the first sentences of each text.

    Diverse first (of each type the quota, then the rest by type as met), then distinct by question, then valid by
    lengths and confidence. Texts that are too short and texts without a valid pair fail.
    """
    sentence = lambda s: F.struct(s.alias("answer"), T.entities(s).alias("e"))

    def pair(x: Column) -> Column:
        named = F.size(x["e"]) > 0
        question = F.when(named, F.concat(F.lit("What is "), F.get(x["e"], F.lit(0)), F.lit("?"))).otherwise(F.concat(F.lit("What does this sentence mean: "), F.substring(x["answer"], 1, 50), F.lit("...?")))
        return F.struct(question.alias("question"), x["answer"].alias("answer"), F.when(named, "factual").otherwise("conceptual").alias("type"), F.when(named, "easy").otherwise("medium").alias("difficulty"), F.when(named, 0.7).otherwise(0.6).alias("confidence"))

    raw = F.transform(F.transform(F.slice(T.sentences(F.col("text")), 1, most), sentence), pair)
    out = docs.select("doc_id", "text", raw.alias("raw"))
    quota = max(1, most // len(X.QUESTION_TYPES))
    of = lambda kind: F.filter("raw", lambda p: p["type"] == kind)
    first = F.concat(*[F.slice(of(k), 1, quota) for k in X.QUESTION_TYPES])
    kinds = F.array_distinct(F.transform("raw", lambda p: p["type"]))  # in the order met
    by_kind = F.flatten(F.transform(kinds, lambda k: F.filter("raw", lambda p: p["type"] == k)))
    diverse = F.slice(F.concat(first, F.array_distinct(F.filter(by_kind, lambda p: ~F.array_contains(first, p)))), 1, most)
    out = out.withColumn("diverse", F.when(F.size("raw") > 1, diverse).otherwise(F.col("raw")))
    asked = F.transform("diverse", lambda p: F.lower(p["question"]))
    out = out.withColumn("_q", asked).withColumn("distinct", F.filter("diverse", lambda p, i: F.array_position("_q", F.lower(p["question"])) == i + 1))
    valid = F.filter("distinct", lambda p: F.length(p["question"]).between(*X.QUESTION_CHARS) & F.length(p["answer"]).between(*X.ANSWER_CHARS) & (p["confidence"] >= X.LEAST_CONFIDENCE))
    long = F.coalesce(F.length("text") >= X.ANSWER_CHARS[0], F.lit(False))
    out = out.withColumn("pairs", F.when(long, valid).otherwise(F.slice("raw", 1, 0)))
    error = F.when(~long, "Invalid item for QA generation").when(F.size("pairs") == 0, "No valid QA pairs generated")
    return out.select("doc_id", F.when(error.isNull(), "completed").otherwise("failed").alias("qa_status"), error.alias("qa_error"), "pairs")


def questions(docs: DataFrame, most: int = X.QUESTIONS) -> DataFrame:
    """The pairs of question_arrays, a row each, with their place."""
    rows = question_arrays(docs, most).select("doc_id", F.posexplode(T.made_once("pairs")).alias("place", "p"))
    return rows.select("doc_id", "place", "p.*")
