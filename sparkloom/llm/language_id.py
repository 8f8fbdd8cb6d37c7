"""Language identification: averaged hashed subword embeddings under a linear softmax, with calibrated rejection.

Subwords are the byte 2-, 3- and 4-grams of the text (A-Z lower-cased, ASCII white space as blanks), hashed into
BUCKETS rows of an embedding table; a text is the mean of its rows. Table and softmax are trained together by
stochastic gradient descent in numpy, on a bounded sample of labelled rows, drawn by a hash of the id: at most
MAX_PER_LANGUAGE documents of each language and MAX_SAMPLE in all. What reaches the driver for a document is the shares
of its MAX_BUCKETS most frequent buckets, so at most 8 * MAX_BUCKETS * MAX_SAMPLE bytes (192 MB) whatever the corpus.
All languages of the labels are learnt; more of them than MAX_SAMPLE raise an error. A fifth of the sample is held back to fit a temperature and the
rejection threshold, the probability that all but REJECTED of the right calls exceed (0.5 at most).

Every whole text is predicted. Texts that are null or have no letter are ``und`` with score 0 and rejected. Without
any labelled row all texts are ``und``. Ids may repeat; null ids are predicted like others but never learnt from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import arrow_map, give_back, remainder, ship

BUCKETS = 1 << 14
SIZES = (2, 3, 4)
DIMENSIONS, EPOCHS, RATE = 12, 4, 0.4
MAX_PER_LANGUAGE, MAX_SAMPLE, MAX_BUCKETS = 1200, 6000, 4000
REJECTED = 0.002
CHUNK = 1 << 19
UNKNOWN = "und"

_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\r\x0b\x0c", b"abcdefghijklmnopqrstuvwxyz     ")


def subwords(data: bytes):
    """Bucket numbers of a folded text's subwords, some at a time; every subword once."""
    for i in range(0, len(data), CHUNK):
        x = np.frombuffer(data[i : i + CHUNK + max(SIZES) - 1], np.uint8).astype(np.uint32)
        for n in SIZES:
            m = min(len(x) - n + 1, CHUNK)
            if m > 0:
                g = x[:m].copy()
                for k in range(1, n):
                    g = (g << np.uint32(8)) | x[k : k + m]
                yield ((g ^ np.uint32(n * 0x01000193)) * np.uint32(2654435761)) >> np.uint32(32 - 14)


def fold(text: str) -> bytes:
    return b" " + text.encode("utf-8", "surrogatepass").translate(_FOLD) + b" "


def counts_of(text: str, most: int = MAX_BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, shares) of a text's subwords: its most frequent buckets, the smaller number of equals first."""
    total = np.zeros(BUCKETS, np.int64)
    for g in subwords(fold(text)):
        total += np.bincount(g, minlength=BUCKETS)
    at = np.flatnonzero(total)
    if len(at) > most:
        at = np.sort(at[np.argsort(-total[at], kind="stable")[:most]])
    return at.astype(np.int32), (total[at] / total.sum()).astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # logits of each bucket: embeddings times softmax weights
    bias: np.ndarray
    temperature: float
    threshold: float

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, its probability, and whether the call is rejected."""
        import regex

        if not text or not self.languages or not regex.search(r"\p{L}", text):
            return UNKNOWN, 0.0, True
        total, n = np.zeros(len(self.languages)), 0
        for g in subwords(fold(text)):
            counts = np.bincount(g, minlength=BUCKETS) if len(g) > BUCKETS else None
            total += counts @ self.table if counts is not None else self.table[g].sum(axis=0, dtype=np.float64)
            n += len(g)
        p = _softmax((total / max(n, 1) + self.bias) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(min(1.0, p[best])), bool(p[best] < self.threshold)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> Model:
    """rows: (language, buckets, shares) of each document of the sample."""
    languages = sorted({r[0] for r in rows})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    rng, number = np.random.default_rng(seed), {x: i for i, x in enumerate(languages)}
    order = rng.permutation(len(rows))
    held, used = order[: len(rows) // 5], order[len(rows) // 5 :]
    e = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    w, b = rng.normal(0, 0.1, (DIMENSIONS, len(languages))), np.zeros(len(languages))
    steps, step = EPOCHS * len(used), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(used):
            language, at, share = rows[i]
            x = share @ e[at]
            gap = _softmax(x @ w + b)
            gap[number[language]] -= 1
            rate = RATE * (1 - step / steps)
            e[at] -= rate * 20 * np.outer(share, w @ gap)
            w -= rate * np.outer(x, gap)
            b -= rate * 0.1 * gap
            step += 1
    model = Model(languages, e @ w, b, 1.0, 0.0)
    check = held if len(held) else used
    logits = np.array([rows[i][2] @ model.table[rows[i][1]] + b for i in check])
    truth = np.array([number[rows[i][0]] for i in check])
    losses = {t: -np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in np.geomspace(0.1, 10, 41)}
    model.temperature = float(min(losses, key=losses.get))
    p = _softmax(logits / model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == truth]
    model.threshold = float(min(0.5, np.quantile(right, REJECTED))) if len(right) else 0.0
    return model


def train(labelled: DataFrame, per_language: int = MAX_PER_LANGUAGE) -> Model:
    """labelled: (doc_id, text, lang). Rows with a null are left out."""
    ship(labelled.sparkSession)
    labelled = labelled.select("doc_id", "text", "lang").dropna()
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().limit(MAX_SAMPLE + 1).collect()}
    if not sizes:
        return fit([])
    if len(sizes) > MAX_SAMPLE:
        raise ValueError(f"more than {MAX_SAMPLE} languages: no sample within the bound has all of them")
    per_language = min(per_language, MAX_SAMPLE // len(sizes))
    shares = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_language / n))])
    point = F.shiftrightunsigned(F.xxhash64(F.lit("language"), "doc_id"), 11) / float(1 << 53)
    sample = labelled.where(point < F.element_at(shares, F.col("lang")))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [counts_of(t.as_py()) for t in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([a.tobytes() for a, _ in found], pa.binary()), pa.array([s.tobytes() for _, s in found], pa.binary())], ["lang", "at", "share"])

    rows = arrow_map(sample.select("lang", "text"), each, "lang string, at binary, share binary").limit(MAX_SAMPLE).collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["share"])))
    return fit([(r["lang"], np.frombuffer(r["at"], np.int32), np.frombuffer(r["share"], np.float32)) for r in rows])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every whole text."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [model.predict(t.as_py()) for t in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]], ["doc_id", "lang_pred", "score", "rejected"])

    return arrow_map(docs.select("doc_id", "text"), each, "doc_id bigint, lang_pred string, score double, rejected boolean")


def learn(docs: DataFrame) -> Model:
    """From documents whose fold by id, of 4, is not 2."""
    return train(docs.where(remainder(4) != 2))


def query(docs: DataFrame) -> DataFrame:
    return predict(docs, learn(docs)).select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def keep(docs: DataFrame) -> DataFrame:
    """The documents, all columns, whose language call is not rejected; null texts and those without a letter are."""
    model, names = learn(docs), docs.columns

    def over(batches):
        for batch in batches:
            texts = batch.column(names.index("text"))
            yield batch.filter(pa.array([not model.predict(t.as_py())[2] for t in texts], pa.bool_()))
            give_back()

    return docs.mapInArrow(over, docs.schema)
