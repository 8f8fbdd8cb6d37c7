"""Tokenised samples: encode, truncate, pad, special tokens, statistics, labels, batches, media placeholders."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

IGNORED = -100
#: Characters encoded at a time: the library holds some hundred bytes for each token of what it encodes.
CHUNK_CHARS = 1 << 18
# Ids that stand for one image or audio clip, and the most of a video.
IMAGE_TOKENS, AUDIO_TOKENS, VIDEO_TOKENS = 256, 512, 1024


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_padding()
    t.no_truncation()
    return t


def _chunks(texts: pd.Series) -> Iterator[list[str]]:
    """The texts, null ones as empty, in lists of CHUNK_CHARS characters or so; a longer text is a list of its own."""
    some, chars = [], 0
    for t in texts:
        t = t or ""
        if some and chars + len(t) > CHUNK_CHARS:
            yield some
            some, chars = [], 0
        some.append(t)
        chars += len(t)
    if some:
        yield some


def _encodings(path: str, texts: pd.Series, made: Callable, places: bool = False) -> list:
    """made(encoding) of each text; no more encodings than those of a chunk are held."""
    t = _tokenizer(path)
    encode = t.encode_batch if places else t.encode_batch_fast
    return [made(e) for some in _chunks(texts) for e in encode(some, add_special_tokens=False)]


def encoder(path: str):
    """Arrow UDF from text to ids by a tokenizer file; null and empty texts have none. The file is read once a worker."""

    @F.pandas_udf(ArrayType(IntegerType()))
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series(_encodings(path, texts, lambda e: np.array(e.ids, np.int32)), index=texts.index, dtype=object)

    return encode


def counter(path: str):
    """Arrow UDF from text to the number of its ids; the ids themselves stay where they are made."""

    @F.pandas_udf(IntegerType())
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series(_encodings(path, texts, len), index=texts.index, dtype="int32")

    return count


def decoder(path: str):
    """Arrow UDF from ids to text by a tokenizer file; special tokens are skipped."""

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        return pd.Series(_tokenizer(path).decode_batch([list(x) if x is not None else [] for x in ids], skip_special_tokens=True), index=ids.index)

    return decode


def offsets(path: str):
    """Arrow UDF from text to (id, token, start, end) of each token, in characters of the text."""

    @F.pandas_udf("array<struct<id:int,token:string,start:int,end:int>>")
    def of(texts: pd.Series) -> pd.Series:
        rows = lambda e: [{"id": i, "token": t, "start": a, "end": b} for i, t, (a, b) in zip(e.ids, e.tokens, e.offsets)]
        return pd.Series(_encodings(path, texts, rows, places=True), index=texts.index)

    return of


def token_id(path: str, token: str, unknown: str = "<unk>") -> int:
    """A token's id; the unknown token's, or 0, for one that is not in the vocabulary."""
    t = _tokenizer(path)
    return next((i for i in (t.token_to_id(token), t.token_to_id(unknown)) if i is not None), 0)


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(id, token, special) of a tokenizer file."""
    t = _tokenizer(path)
    special = {x.content for x in t.get_added_tokens_decoder().values()}
    return spark.createDataFrame([(i, w, w in special) for w, i in sorted(t.get_vocab().items(), key=lambda x: x[1])], "id int, token string, special boolean")


def tokenized(docs: DataFrame, path: str, text: Column, length: int = 2048, pad: int = 0, bos: int | None = None, eos: int | None = None) -> DataFrame:
    """docs with input_ids, attention_mask, token_count and error: an empty text has no ids and an error."""
    out = docs.withColumn("_ids", encoder(path)(text))
    empty = F.coalesce(F.length(text), F.lit(0)) == 0
    parts = sized(F.col("_ids"), length, pad, bos, eos)
    none = F.array().cast("array<int>")
    return out.withColumns({"input_ids": F.when(empty, none).otherwise(parts["input_ids"]), "attention_mask": F.when(empty, none).otherwise(parts["attention_mask"]), "token_count": F.size("_ids"), "error": F.when(empty, "empty text")}).drop("_ids")


def image_text_sample(text: Column, image: str = "<image>") -> Column:
    """The text of an image-text sample: the placeholder on a line of its own before it."""
    return F.concat(F.lit(f"{image}\n"), text)


def spliced(ids: Column, placeholder: int, media: Column) -> Column:
    """ids with each placeholder replaced by the ids of the media."""
    return F.flatten(F.transform(ids, lambda i: F.when(i == placeholder, media).otherwise(F.array(i))))


def sized(ids: Column, length: int, pad: int = 0, bos: int | None = None, eos: int | None = None) -> dict[str, Column]:
    """input_ids and attention_mask of exactly ``length``: with special tokens, cut at the right, padded at the right."""
    marked = F.concat(*[F.array(F.lit(x)) for x in (bos,) if x is not None], ids, *[F.array(F.lit(x)) for x in (eos,) if x is not None])
    cut = F.slice(marked, 1, length)
    missing = F.greatest(F.lit(length) - F.size(marked), F.lit(0))
    return {"input_ids": F.concat(cut, F.array_repeat(F.lit(pad), missing)), "attention_mask": F.concat(F.transform(cut, lambda _: F.lit(1)), F.array_repeat(F.lit(0), missing)), "truncated": F.size(marked) > length, "padded": missing > 0}


def statistics(rows: DataFrame, ids: str = "ids", length: int = 2048, n: Column | None = None) -> DataFrame:
    """One row over arrays of ids, or over the numbers of ids that a counter gave."""
    n = F.size(ids) if n is None else n
    return rows.agg(F.count("*").alias("total"), F.sum(n).alias("tokens"), F.round(F.coalesce(F.avg(n), F.lit(0.0)), 6).alias("avg_tokens"), F.coalesce(F.max(n), F.lit(0)).alias("max_tokens"), F.coalesce(F.min(n), F.lit(0)).alias("min_tokens"), F.count_if(n > length).alias("truncated"), F.count_if(n < length).alias("padded"))


def fertility(rows: DataFrame, tokens: Column, words: Column, group: str) -> DataFrame:
    """Tokens for each word, by group; both are numbers of a row."""
    return rows.groupBy(group).agg(F.round(F.try_divide(F.sum(tokens), F.sum(words)), 6).alias("fertility"))


def masked_labels(messages: Column, answers: str = "assistant") -> Column:
    """Labels of messages (role, ids): the ids of answers, IGNORED elsewhere."""
    return F.flatten(F.transform(messages, lambda m: F.when(m["role"] == answers, m["ids"]).otherwise(F.transform(m["ids"], lambda _: F.lit(IGNORED)))))


def collate(rows: DataFrame, batch: str, ids: str = "input_ids", pad: int = 0) -> DataFrame:
    """Rows padded to the longest of their batch: ids with pad, labels with IGNORED, mask with 0."""
    longest = rows.groupBy(batch).agg(F.max(F.size(ids)).alias("_n"))
    missing = F.col("_n") - F.size(ids)
    out = rows.join(longest, batch)
    return out.withColumns({"labels": F.concat(ids, F.array_repeat(F.lit(IGNORED), missing)), "attention_mask": F.concat(F.transform(ids, lambda _: F.lit(1)), F.array_repeat(F.lit(0), missing)), "padded_ids": F.concat(ids, F.array_repeat(F.lit(pad), missing))}).drop("_n")


def multimodal(text_ids: Column, images: Column, clips: Column, image_id: int, audio_id: int, frames: Column | None = None, video_id: int | None = None) -> dict[str, Column]:
    """Ids of text, images, clips and video frames one after the other, and the type of each: 0, 1, 2, 3. A video has VIDEO_TOKENS at most."""
    parts = [(text_ids, 0), (F.array_repeat(F.lit(image_id), images * IMAGE_TOKENS), 1), (F.array_repeat(F.lit(audio_id), clips * AUDIO_TOKENS), 2)]
    if frames is not None:
        parts.append((F.array_repeat(F.lit(video_id), F.least(frames * IMAGE_TOKENS, F.lit(VIDEO_TOKENS))), 3))
    return {"input_ids": F.concat(*[p for p, _ in parts]), "token_type_ids": F.concat(*[_typed(p, k) for p, k in parts])}


def _typed(ids: Column, kind: int) -> Column:
    return F.array_repeat(F.lit(kind), F.size(ids))
