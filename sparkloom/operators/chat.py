"""Conversations: ordered assembly, chat templates, supervised and preference samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The texts of the templates, by role.
CHATML = {r: (f"<|im_start|>{r}\n", "<|im_end|>\n") for r in ("system", "user", "assistant")}
CHATML_OPEN = "<|im_start|>assistant\n"
LLAMA3 = {r: (f"<|start_header_id|>{r}<|end_header_id|>\n\n", "<|eot_id|>") for r in ("system", "user", "assistant")}
LLAMA3_BEGIN, LLAMA3_OPEN = "<|begin_of_text|>", "<|start_header_id|>assistant<|end_header_id|>\n\n"
PLAIN = {"user": ("User: ", "\n"), "assistant": ("Assistant: ", "\n")}
PLAIN_OPEN = "Assistant: "

TAGGED = {r: (f"<|{r}|>\n", "\n") for r in ("system", "user", "assistant")}
CLOSED = {r: (f"<|{r}|>\n", f"\n</|{r}|>\n") for r in ("system", "user", "assistant")}
TAGGED_OPEN = "<|assistant|>\n"

TEMPLATES = {"tagged": ("", TAGGED, TAGGED_OPEN), "closed": ("", CLOSED, TAGGED_OPEN), "chatml": ("", CHATML, CHATML_OPEN), "llama3": (LLAMA3_BEGIN, LLAMA3, LLAMA3_OPEN), "default": ("", PLAIN, PLAIN_OPEN)}


def assemble(turns: DataFrame) -> DataFrame:
    """(conv_id, messages): the turns of each conversation in order. A conversation is the unit of a sample and bounded by it."""
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("messages"))


def render(messages: Column, template: str) -> Column:
    """The prompt of a template; roles it does not know are dropped, the assistant's opener ends it."""
    begin, roles, opener = TEMPLATES[template]

    def one(m: Column) -> Column:
        out = F.lit("")
        for role, (before, after) in roles.items():
            out = F.when(m["role"] == role, F.concat(F.lit(before), F.coalesce(m["text"], F.lit("")), F.lit(after))).otherwise(out)
        return out

    return F.concat(F.lit(begin), F.array_join(F.transform(messages, one), ""), F.lit(opener))


def rendered(turns: DataFrame, template: str) -> DataFrame:
    return assemble(turns).select("conv_id", render(F.col("messages"), template).alias("prompt"))


def sft_samples(turns: DataFrame) -> DataFrame:
    """(conv_id, n_messages, prompt, response): the last assistant turn answers what stands before it."""
    a = assemble(turns).withColumn("last", F.expr("aggregate(messages, -1L, (m, x) -> if(x.role = 'assistant', cast(x.turn as bigint), m))"))
    a = a.where("last >= 0")
    before = F.filter("messages", lambda m: m["turn"] < F.col("last"))
    answer = F.filter("messages", lambda m: m["turn"] == F.col("last"))
    return a.select("conv_id", F.size("messages").alias("n_messages"), render(before, "chatml").alias("prompt"), answer[0]["text"].alias("response"))


def tokenized(turns: DataFrame, template: str, encode, opener: bool = True) -> DataFrame:
    """(conv_id, prompt, ids): each conversation rendered and encoded by a UDF of operators.tokenize."""
    out = rendered(turns, template)
    end = TEMPLATES[template][2]
    prompt = F.col("prompt") if opener else F.substring("prompt", F.lit(1), F.length("prompt") - len(end))
    return out.select("conv_id", prompt.alias("prompt")).withColumn("ids", encode("prompt"))


def preference_pairs(turns: DataFrame, key: Callable[[Column], Column] = lambda t: t) -> DataFrame:
    """(prompt, chosen, rejected) texts: the longest and the shortest answer to first user turns of equal key with at least two."""
    users = turns.where("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("prompt")).withColumn("prompt", key(F.col("prompt")))
    answers = turns.where("role = 'assistant'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("answer"))
    rank = F.struct(F.length("answer"), "answer")
    pairs = users.join(answers, "conv_id").groupBy("prompt").agg(F.max_by("answer", rank).alias("a"), F.min_by("answer", rank).alias("b")).where("a <> b")
    return pairs.select("prompt", F.concat("prompt", F.lit("\n"), "a").alias("chosen"), F.concat("prompt", F.lit("\n"), "b").alias("rejected"))
