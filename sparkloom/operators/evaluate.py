"""Evaluation: answer scores, label agreement, classification metrics."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.text import strip

log = logging.getLogger(__name__)


def vqa_score(predicted: Column, answers: Column) -> Column:
    """Mean over answers of 1 (equal), 0.5 (one in the other) or 0, times 3, at most 1."""
    p = strip(F.lower(predicted))
    one = lambda a: F.when(p == a, 1.0).when(a.contains(p) | p.contains(a), 0.5).otherwise(0.0)
    total = F.aggregate(F.transform(answers, lambda a: strip(F.lower(a))), F.lit(0.0), lambda s, a: s + one(a))
    return F.least(F.lit(1.0), total / F.size(answers) * 3.0)


def exact(predicted: Column, answers: Column) -> Column:
    return F.exists(answers, lambda a: strip(F.lower(a)) == strip(F.lower(predicted)))


def choice(answer: Column, choices: int = 4) -> Column:
    """The first letter if it names one of the choices, else empty."""
    first = F.substring(F.upper(strip(answer)), 1, 1)
    return F.when(first.isin([chr(65 + i) for i in range(choices)]), first).otherwise("")


def extract_answer(text: Column, mark: str = "Answer:") -> Column:
    return strip(F.substring_index(text, mark, -1))


def binary_metrics(rows: DataFrame, predicted: Column, truth: Column) -> DataFrame:
    """Counts, accuracy, precision, recall and F1 in one pass; ratios over nothing are 0."""
    t = rows.agg(*[F.count_if(c).alias(n) for n, c in (("tp", predicted & truth), ("fp", predicted & ~truth), ("fn", ~predicted & truth), ("tn", ~predicted & ~truth))])
    ratio = lambda a, b: F.round(F.coalesce(F.expr(f"try_divide({a}, {b})"), F.lit(0.0)), 6)
    return t.select("tp", "fp", "fn", "tn", ratio("tp + tn", "tp + fp + fn + tn").alias("accuracy"), ratio("tp", "tp + fp").alias("precision"), ratio("tp", "tp + fn").alias("recall"), ratio("2 * tp", "2 * tp + fp + fn").alias("f1"))


def cohen_kappa(rows: DataFrame, a: Column, b: Column) -> DataFrame:
    """Agreement of two binary judgements beyond chance."""
    t = rows.agg(F.count("*").alias("n"), F.count_if(a == b).alias("agreed"), F.count_if(a).alias("pa"), F.count_if(b).alias("pb"))
    chance = "(pa * pb + (n - pa) * (n - pb)) / (n * n)"
    return t.select("n", "agreed", F.expr(f"round(try_divide(agreed / n - {chance}, 1 - {chance}), 6)").alias("kappa"))


def accuracy_by(rows: DataFrame, group: str, score: Column) -> DataFrame:
    """(group, num_samples, num_correct, accuracy): the mean score of each benchmark; correct ones are cut to a whole number."""
    return rows.groupBy(group).agg(F.count("*").alias("num_samples"), F.floor(F.coalesce(F.sum(score), F.lit(0.0)) + 1e-9).alias("num_correct"), F.round(F.coalesce(F.avg(score), F.lit(0.0)), 6).alias("accuracy"))


def benchmark_score(benchmark: Column, predicted: Column, answers: Column) -> Column:
    """Score of a prediction by its benchmark: soft for vqa and textvqa, exact for gqa, the letter for mmlu and mmbench."""
    soft, equal = vqa_score(predicted, answers), exact(predicted, answers).cast("double")
    letter = (choice(predicted) == F.upper(strip(F.get(answers, F.lit(0))))).cast("double")
    return F.when(benchmark.isin("vqa", "textvqa"), soft).when(benchmark == "gqa", equal).when(benchmark.isin("mmlu", "mmbench"), letter)


def choice_prompt(question: Column, choices: Column) -> Column:
    """A multiple-choice prompt, a lettered line for each choice."""
    lines = F.transform(choices, lambda c, i: F.concat(F.chr(i + 65), F.lit(". "), c, F.lit("\n")))
    return F.concat(F.lit("Question: "), question, F.lit("\n"), F.array_join(lines, ""), F.lit("Answer:"))


def _grams(words: Column, n: int) -> Column:
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))


def _occurrences(found: Column, gram: Column) -> Column:
    return F.size(F.filter(found, lambda g: g == gram))


def bleu_counts(rows: DataFrame, most: int = 4) -> DataFrame:
    """rows (prediction, references) with their clipped matches and number of n-grams up to ``most``, and the two lengths.

    A gram's matches are clipped at its greatest number in one reference; the reference length is the one closest to
    the prediction's (the shorter of equals).
    """
    split = lambda t: F.filter(F.split(F.lower(t), r"(?U)\s+"), lambda w: w != "")
    rows = rows.withColumn("_p", split(F.col("prediction"))).withColumn("_r", F.transform("references", split))
    for n in range(1, most + 1):
        rows = rows.withColumn("_g", _grams(F.col("_p"), n)).withColumn("_s", F.transform("_r", lambda r: _grams(r, n)))  # noqa: B023
        clipped = F.aggregate(F.array_distinct("_g"), F.lit(0), lambda s, g: s + F.least(_occurrences(F.col("_g"), g), F.array_max(F.transform("_s", lambda r: _occurrences(r, g)))))
        rows = rows.withColumn(f"match_{n}", clipped).withColumn(f"total_{n}", F.size("_g"))
    closest = F.element_at(F.array_sort(F.transform("_r", lambda r: F.struct(F.abs(F.size(r) - F.size("_p")).alias("d"), F.size(r).alias("n")))), 1)["n"]
    return rows.withColumns({"length": F.size("_p"), "reference": closest}).drop("_p", "_r", "_g", "_s")


def bleu(rows: DataFrame, most: int = 4) -> DataFrame:
    """One row: corpus BLEU-1 to BLEU-``most`` with the brevity penalty; 0 where an order has no match."""
    counts = bleu_counts(rows, most).agg(*[F.sum(c).alias(c) for n in range(1, most + 1) for c in (f"match_{n}", f"total_{n}")], F.sum("length").alias("length"), F.sum("reference").alias("reference"))
    penalty = F.when(F.col("length") >= F.col("reference"), 1.0).otherwise(F.exp(1 - F.try_divide("reference", "length")))
    logs = [F.log(F.try_divide(f"match_{n}", f"total_{n}")) for n in range(1, most + 1)]
    return counts.select(*[F.round(F.coalesce(penalty * F.exp(sum(logs[1:n], logs[0]) / n), F.lit(0.0)), 6).alias(f"bleu_{n}") for n in range(1, most + 1)])


def rouge_l(prediction: Column, reference: Column, beta: float = 1.2) -> Column:
    """F score of the longest common subsequence of words (one row of the table at a time)."""
    split = lambda t: F.filter(F.split(F.lower(t), r"(?U)\s+"), lambda w: w != "")
    p, r = split(prediction), split(reference)
    last = lambda a: F.element_at(a, -1)

    def row(above: Column, w: Column) -> Column:
        return F.aggregate(r, F.array(F.lit(0)), lambda out, x: F.array_append(out, F.when(x == w, F.get(above, F.size(out) - 1) + 1).otherwise(F.greatest(F.get(above, F.size(out)), last(out)))))

    common = last(F.aggregate(p, F.transform(F.concat(F.array(F.lit("")), r), lambda _: F.lit(0)), row))
    precision, recall = F.try_divide(common, F.size(p)), F.try_divide(common, F.size(r))
    return F.coalesce(F.try_divide((1 + beta**2) * precision * recall, recall + beta**2 * precision), F.lit(0.0))


def fleiss_kappa(ratings: DataFrame, item: str, category: str) -> DataFrame:
    """One row: agreement of any number of raters beyond chance; items must have equally many ratings (at least two)."""
    cells = ratings.groupBy(item, category).agg(F.count("*").alias("n"))
    per = cells.groupBy(item).agg(F.sum("n").alias("raters"), F.sum(F.col("n") * (F.col("n") - 1)).alias("pairs"))
    observed = per.agg(F.count("*").alias("items"), F.avg(F.try_divide(F.col("pairs"), F.col("raters") * (F.col("raters") - 1))).alias("p"), F.sum("raters").alias("all"))
    shares = cells.groupBy(category).agg(F.sum("n").alias("n"))
    total = shares.agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"))
    chance = F.col("squares") / (F.col("all").cast("double") * F.col("all"))
    both = observed.withColumn("k", F.lit(1)).join(total.withColumn("k", F.lit(1)), "k")  # one row each
    return both.select("items", F.round(F.try_divide(F.col("p") - chance, 1 - chance), 6).alias("kappa"))


def latencies(rows: DataFrame, value: str, group: str | None = None) -> DataFrame:
    """The 50th, 95th and 99th percentile (interpolated), by group if given."""
    q = lambda p: F.round(F.percentile(value, p), 6)
    grouped = rows.groupBy(group) if group else rows.groupBy()
    return grouped.agg(q(0.5).alias("p50"), q(0.95).alias("p95"), q(0.99).alias("p99"))


def overlap(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes (x, y, width, height)."""
    side = lambda lo, size: F.greatest(F.lit(0.0), F.least(a[lo] + a[size], b[lo] + b[size]) - F.greatest(a[lo], b[lo]))
    both = side("x", "width") * side("y", "height")
    return F.coalesce(F.try_divide(both, a["width"] * a["height"] + b["width"] * b["height"] - both), F.lit(0.0))


def run_benchmark(rows: DataFrame, name: str) -> DataFrame:
    """One row (benchmark, num_samples, num_correct, accuracy) of predictions (predicted, answers) of a benchmark."""
    named = rows.withColumn("benchmark", F.lit(name))
    return accuracy_by(named, "benchmark", benchmark_score(F.col("benchmark"), F.col("predicted"), F.col("answers")))


def run_benchmarks(makers: dict[str, Callable[[], DataFrame]]) -> DataFrame | None:
    """The rows of all benchmarks whose predictions can be made; one that fails is logged and left out; None if all do."""
    out = None
    for name, make in makers.items():
        try:
            one = run_benchmark(make(), name)
        except Exception:
            log.exception("benchmark %s failed and is left out", name)
            continue
        out = one if out is None else out.union(one)
    return out


def first_details(rows: DataFrame, most: int = 100) -> DataFrame:
    """The first samples of a run by id, for a report (a top-k report)."""
    return rows.orderBy("sample_id").limit(most)
