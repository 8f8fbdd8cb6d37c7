"""Where a caller's own models and callbacks go in: scoring UDFs, a row-generating function, observed runs, parsed answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import fixed as X
from sparkloom.functions import udf as U


def model_udf(load: Callable[[], Any], score: Callable[[Any, pd.Series], pd.Series], returns: str):
    """Arrow UDF of a model that is loaded once for each worker task and scores a batch at a time.

    A batch that fails is scored row by row; rows that fail give null, the others keep their scores.
    """

    @F.pandas_udf(returns)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            try:
                yield score(model, batch)
            except Exception:
                yield pd.concat([_alone(score, model, batch.iloc[i : i + 1]) for i in range(len(batch))]) if len(batch) else pd.Series([], dtype=object)

    return of


def _alone(score: Callable[[Any, pd.Series], pd.Series], model: Any, row: pd.Series) -> pd.Series:
    try:
        return score(model, row)
    except Exception:
        return pd.Series([None], index=row.index, dtype=object)


def constant(value: Any) -> Callable[[Column], Column]:
    """A hook whose model is absent: the same score for every row."""
    return lambda _: F.lit(value)


#: Hooks without a model here: not-safe-for-work and watermark scores of images, similarity of image and text, an online toxicity service.
ABSENT = {"nsfw": constant(0.0), "watermark": constant(0.0), "alignment": constant(X.ALIGNMENT), "perspective": constant(X.TOXICITY_BASE["toxicity"])}


def find_entities(find: Callable[[str], list[tuple[str, str, int, int, float]]], least: float = 0.7):
    """Arrow UDF of a caller's recogniser beside the patterns: its entities that are sure enough, merged with theirs by place."""

    @F.pandas_udf(U.ENTITIES)
    def of(texts: pd.Series) -> pd.Series:
        names = ("entity_type", "text", "start", "end", "score")

        def merged(t):
            if not t:
                return []
            found = sorted([*U.pii_entities(t), *(e for e in find(t) if e[4] >= least)], key=lambda e: e[2])
            kept, reach = [], 0
            for e in found:
                if e[2] >= reach:
                    kept.append(dict(zip(names, e)))
                    reach = e[3]
            return kept

        return texts.map(merged)

    return of


PAIRS = "array<struct<question:string,answer:string,question_type:string,difficulty:string>>"


def question_prompt(text: Column, count: int = X.QUESTIONS) -> Column:
    """A prompt that asks a model for question-answer pairs of a text as a JSON array."""
    head = f"Write {count} question and answer pairs about the text below. Question types: {', '.join(X.QUESTION_TYPES)}. Answer with a JSON array of objects with question, answer, question_type and difficulty.\n\n"
    return F.concat(F.lit(head), text)


def parsed_pairs(answer: Column) -> Column:
    """The pairs of a model's answer: the JSON array between its first and last bracket; an empty array where there is none."""
    return F.coalesce(F.from_json(F.regexp_extract(answer, r"(?s)\[.*\]", 0), PAIRS), F.array().cast(PAIRS))


class SentenceRows:
    """Row generator: a row (place, sentence) for each sentence of a text."""

    def eval(self, text: str):
        import re

        for place, s in enumerate(x.strip() for x in re.split(X.SENTENCE_ENDS + "+", text or "")):
            if s:
                yield place, s


def register(spark: SparkSession) -> None:
    """Make the row generator known to SQL: select * from documents, lateral sentence_rows(text)."""
    spark.udtf.register("sentence_rows", F.udtf(SentenceRows, returnType="place int, sentence string"))


def observed(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """df with named aggregates that are counted while another action runs over it."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(k) for k, c in counts.items()]), seen


def run_with_callbacks(make: Callable[[], Any], on_done: Callable[[Any], None] | None = None, on_error: Callable[[Exception], None] | None = None) -> Any:
    """The result of make; callbacks hear of it, or of its error, which is raised on."""
    try:
        out = make()
    except Exception as e:
        if on_error:
            on_error(e)
        raise
    if on_done:
        on_done(out)
    return out
