"""Column expressions over text; all stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import fixed as X


def strip(text: Column) -> Column:
    """Without white space (Unicode) at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def words(text: Column) -> Column:
    """Words between white space (Unicode); stripped first, so that no word has to be looked at to drop empty ones."""
    bare = strip(text)
    return F.when(F.length(bare) > 0, F.split(bare, r"(?U)\s+")).when(F.length(bare) == 0, F.array().cast("array<string>"))


def made_once(array: str) -> Column:
    """An array column to explode. Spark also filters by the size of a plain one, below the projections that make it, so that it is made again for that."""
    return F.transform(array, lambda x: x)


def hits(text: Column, found: list[str]) -> Column:
    """How many of the strings occur in the text."""
    return reduce(lambda a, b: a + b, [text.contains(w).cast("int") for w in found])


def any_match(text: Column, patterns: list[str], flags: str = "") -> Column:
    return reduce(lambda a, b: a | b, [text.rlike(flags + p) for p in patterns])


def clamp(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def strip_tags(text: Column) -> Column:
    """Tags removed; entities are left to functions.udf.unescape."""
    return F.regexp_replace(text, "<[^>]+>", "")


def drop_boilerplate(text: Column) -> Column:
    return strip(reduce(lambda t, p: F.regexp_replace(t, f"(?is){p}", ""), X.BOILERPLATE, text))


def cut_char_runs(text: Column) -> Column:
    """Runs of over 50 equal characters become 50."""
    return F.regexp_replace(text, r"(?d)((.)\2{49})\2+", "$1")


def collapse_space(text: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]", ""))


def unify_quotes(text: Column) -> Column:
    return F.translate(text, "‘’“”", "''\"\"")


def language_by_share(text: Column) -> Column:
    """zh if over a tenth of the characters are CJK, else en; null for an empty text."""
    share = F.try_divide(F.regexp_count(text, F.lit(r"[\x{4e00}-\x{9fff}]")), F.length(text))
    return F.when(F.length(text) > 0, F.when(share > 0.1, "zh").otherwise("en"))


def language_by_presence(text: Column) -> Column:
    return F.when(text.rlike(r"[\x{4e00}-\x{9fff}]"), "zh").otherwise("en")


def education(text: Column) -> Column:
    """The cleaner's education score."""
    gains = sum((F.when(text.rlike(p), 0.05).otherwise(0.0) for p in X.TECHNICAL), F.when(F.length(text) > 1000, 0.6).otherwise(0.5))
    return clamp(sum((F.when(F.lower(text).rlike(p), -0.1).otherwise(0.0) for p in X.INFORMAL), gains))


def variety(found: Column) -> Column:
    """Share of distinct words; 0 without words."""
    return F.coalesce(F.try_divide(F.size(F.array_distinct(found)), F.size(found)), F.lit(0.0))


def with_words(df: DataFrame, text: str = "text") -> DataFrame:
    """df with its words (_w) and lower-cased words (_lw), split once for all the scores of a row."""
    return df.withColumn("_w", words(F.col(text))).withColumn("_lw", words(F.lower(F.col(text))))


def filter_scores(text: Column) -> dict[str, Column]:
    """Fluency, density, education and the composite of the quality filter; over with_words()."""
    w, lowered = F.col("_w"), F.col("_lw")
    some = F.size(w) > 0
    fluency = F.lit(0.5) + F.when(text.contains("."), 0.2).otherwise(0.0) + F.when(text.contains(",") | text.contains("，"), 0.1).otherwise(0.0) + F.when(text.rlike(r"\p{Lu}"), 0.1).otherwise(0.0)
    fluency = clamp(F.when(some, fluency * (0.5 + 0.5 * variety(w))).otherwise(fluency))
    mean = F.try_divide(F.length(F.array_join(w, "")), F.size(w))
    density = F.when(some, 0.6 * variety(lowered) + 0.4 * F.least(mean / 10, F.lit(1.0))).otherwise(0.0)
    low = F.lower(text)
    edu = clamp(0.5 + 0.05 * hits(low, X.ACADEMIC) + F.when(F.regexp_count(text, F.lit(r"\d+")) > 3, 0.1).otherwise(0.0) + F.when(text.contains(X.CITATION_ZH) | low.contains(X.CITATION_EN), 0.1).otherwise(0.0))
    empty = F.length(text) == 0
    f, d, e = (F.when(empty, 0.0).otherwise(c) for c in (fluency, density, edu))
    a, b, c = X.TEXT_WEIGHTS
    return {"fluency": f, "density": d, "education": e, "overall": a * f + b * d + c * e}


def scorer_scores(text: Column) -> dict[str, Column]:
    """The five dimensions of the quality scorer and their mean; all 0 for an empty text; over with_words()."""
    low, w, lowered = F.lower(text), F.col("_w"), F.col("_lw")
    sentences = F.filter(F.transform(F.split(text, X.SENTENCE_ENDS), strip), lambda s: s != "")
    mean = F.try_divide(F.length(F.array_join(sentences, "")), F.size(sentences))
    fluency = F.when(mean < 5, 0.7).otherwise(1.0) * F.when(text.rlike(X.SENTENCE_ENDS), 1.0).otherwise(0.8) * F.when(F.size(w) > 0, 0.5 + 0.5 * variety(w)).otherwise(1.0)
    fluency = F.when(F.size(sentences) > 0, fluency).otherwise(0.0)
    content = F.coalesce(F.try_divide(F.size(F.filter(lowered, lambda x: ~x.isin(X.STOPWORDS))), F.size(w)), F.lit(0.0))
    out = {
        "fluency": fluency,
        "relevance": F.least(F.lit(1.0), 0.5 + hits(low, X.TOPIC) * 0.1),
        "coherence": F.least(F.lit(1.0), 0.6 + hits(low, X.CONNECTORS) * 0.05),
        "informativeness": F.when(F.size(w) > 0, 0.4 * variety(lowered) + 0.6 * content).otherwise(0.0),
        "safety": F.pow(F.lit(0.5), hits(low, X.SENSITIVE)),
    }
    out = {k: F.when(F.length(text) == 0, 0.0).otherwise(clamp(v)) for k, v in out.items()}
    out["overall"] = sum(list(out.values())[1:], out["fluency"]) / 5
    return out


def risk(text: Column, kind: str) -> Column:
    n = hits(F.lower(text), X.RISK_WORDS[kind])
    return F.when(n == 0, 0.0).when(n <= 2, 0.3).when(n <= 5, 0.6).otherwise(0.9)


def sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, X.SENTENCE_ENDS + "+"), strip), lambda s: s != "")


def entities(text: Column) -> Column:
    """Capitalised words or pairs of them, then the first number."""
    numbers = F.regexp_extract_all(text, F.lit(X.NUMBER), 0)
    return F.concat(F.regexp_extract_all(text, F.lit(X.ENTITY), 0), F.when(F.size(numbers) > 0, F.array(F.concat(F.lit("数字"), numbers[0]))).otherwise(F.array().cast("array<string>")))


def mime_type(path: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in X.MIME.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1))), F.lit(X.MIME_DEFAULT))


def item_text(*candidates: Column) -> Column:
    """The first candidate that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])


def without_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{P}", "")


def expand_contractions(text: Column) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), X.CONTRACTIONS.items(), text)


def tidy_caption(text: Column, language: str = "en") -> Column:
    """White space collapsed, repeated sentence ends made one, the first letter of an English caption in upper case."""
    out = collapse_words(text)
    for end in "。！？.!?":
        out = F.regexp_replace(out, rf"[{end}]{{2,}}", end)
    return F.concat(F.upper(F.substring(out, 1, 1)), F.substring(out, 2, 1 << 30)) if language == "en" else out


def collapse_words(text: Column) -> Column:
    """Words with one blank between."""
    return F.array_join(words(text), " ")


def profanity(text: Column, zh: list[str], en: list[str]) -> Column:
    found = [text.contains(w) for w in zh] + [F.lower(text).contains(w) for w in en]
    return reduce(lambda a, b: a | b, found, F.lit(False))


def redact(text: Column, zh: list[str], en: list[str], mark: str = "*") -> Column:
    """Listed words covered, each by as many marks as it has characters; English ones whatever their case."""
    out = reduce(lambda t, w: F.replace(t, F.lit(w), F.lit(mark * len(w))), zh, text)
    return reduce(lambda t, w: F.regexp_replace(t, r"(?iu)\Q" + w + r"\E", mark * len(w)), en, out)


def toxicity(text: Column, zh: list[str] = X.PROFANITY_ZH, en: list[str] = X.PROFANITY_EN) -> dict[str, Column]:
    """The seven values of the rule-based filter, and whether one is over its limit."""
    rude, hate, menace = profanity(text, zh, en), any_match(text, X.HATE, "(?i)"), any_match(text, X.THREAT, "(?i)")
    out = {k: F.lit(v) for k, v in X.TOXICITY_BASE.items()}
    out["toxicity"] = F.when(menace, X.TOXICITY_HIT["threat"]).when(hate, X.TOXICITY_HIT["identity_attack"]).otherwise(X.TOXICITY_BASE["toxicity"])
    for k, hit in (("profanity", rude), ("identity_attack", hate), ("threat", menace)):
        out[k] = F.when(hit, X.TOXICITY_HIT[k]).otherwise(X.TOXICITY_BASE[k])
    out["is_toxic"] = reduce(lambda a, b: a | b, [out[k] > v for k, v in X.TOXICITY_LIMITS.items()])
    return out


def toxicity_outcome(text: Column, mode: str = "remove") -> dict[str, Column]:
    """(status, action): empty texts are skipped; toxic ones filtered (mode remove) or redacted."""
    toxic = toxicity(text)["is_toxic"]
    empty = F.coalesce(text, F.lit("")) == ""
    removed = F.when(toxic & ~empty & F.lit(mode == "remove"), "filtered").otherwise("success")
    action = F.when(empty, "skipped").when(toxic, "toxic_content" if mode == "remove" else "redacted")
    return {"status": removed, "action": action}


def strict_pii(text: Column) -> Column:
    """Array of (entity_type, text, score) by the strict rules, kind by kind."""
    parts = []
    for kind, score in X.PII_STRICT.items():
        found = F.regexp_extract_all(text, F.lit(X.PII[kind]), 0)
        if kind == "BANK_CARD":
            found = F.filter(found, lambda c: F.call_function("luhn_check", c))
        if kind == "IP_ADDRESS":
            found = F.filter(found, lambda ip: F.forall(F.split(ip, r"\."), lambda x: x.cast("int") <= 255))
        parts.append(F.transform(found, lambda v: F.struct(F.lit(kind).alias("entity_type"), v.alias("text"), F.lit(score).alias("score"))))  # noqa: B023
    return F.concat(*parts)


def reading_ease(text: Column) -> Column:
    """Flesch reading ease from counts of sentences, words and groups of vowels; null without words."""
    w = F.size(words(text))
    n = F.greatest(F.size(sentences(text)), F.lit(1))
    vowels = F.regexp_count(F.lower(text), F.lit("[aeiouy]+"))
    return F.when(w > 0, 206.835 - 1.015 * w / n - 84.6 * vowels / w)


def spam_marks(text: Column) -> Column:
    """How many of four marks of advertising a text has: links, exclamations, shouting, prices."""
    marks = [F.regexp_count(text, F.lit(r"https?://")) >= 3, F.regexp_count(text, F.lit("!")) >= 5, F.regexp_count(text, F.lit("[A-Z]{4,}")) >= 5, text.rlike(r"[$€£]\s?\d")]
    return reduce(lambda a, b: a + b, [m.cast("int") for m in marks])


def data_type(has: dict[str, Column], order: tuple[str, ...], other: str) -> Column:
    """The first kind, in a caller's order, whose column is there."""
    out = F.lit(other)
    for kind in reversed(order):
        out = F.when(has[kind], kind).otherwise(out)
    return out


#: What each caller looks at first, and what it calls the rest.
TYPE_ORDERS = {"filter": (("text", "image", "audio"), "unknown"), "labeler": (("image", "audio", "video", "text"), "multimodal"), "tokenizer": (("image", "audio", "video", "text"), "text")}


def scorer_type(has_text: Column, has_image: Column) -> Column:
    return F.when(has_text & has_image, "multimodal").when(has_image, "image").when(has_text, "text").otherwise("unknown")


def modality(has: dict[str, Column]) -> Column:
    """The tokenizer's modality: text where several are there."""
    several = reduce(lambda a, b: a + b, [c.cast("int") for c in has.values()]) > 1
    return F.when(several, "text").otherwise(data_type(has, *TYPE_ORDERS["tokenizer"]))


def weighted_mean(scores: Column, weights: dict[str, float] | None = None) -> Column:
    """Mean of (name, score) structs; a name without a weight weighs 1; 0 without any."""
    table = F.create_map(*[F.lit(x) for p in (weights or {"": 1.0}).items() for x in p])
    of = lambda d: F.coalesce(F.try_element_at(table, d["name"]), F.lit(1.0))
    total = F.aggregate(scores, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("w")), lambda a, d: F.struct((a["s"] + d["score"] * of(d)).alias("s"), (a["w"] + of(d)).alias("w")))
    return clamp(F.coalesce(F.try_divide(total["s"], total["w"]), F.lit(0.0)))


def constant_score(scores: dict[str, float], weights: dict[str, float]) -> Column:
    return F.lit(sum(scores[k] * weights[k] for k in scores))
