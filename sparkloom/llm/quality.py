"""Quality classifier: Bradley-Terry ranking from preference pairs, thresholded by a score quantile.

A document's latent score is linear in standardised surface features. Pairs (a label-1 document preferred to a label-0
document) are drawn from a sample of at most MAX_PER_LABEL labelled documents of each label (a bounded sample of
labelled rows, drawn by a hash of the id), and the weights minimise the logistic loss of the difference of the two
scores. The threshold is the quantile of the scores, weighted by the labels' shares among all labelled rows, below which the
label-0 documents caught outweigh the label-1 documents lost most (one of those counts KEEP_WEIGHT times); a slope fitted on the same sample turns scores into probabilities, with the threshold at CUT.

Every whole text is scored; null counts as empty, and an empty table gives no rows. Rows repeat with equal scores. Labels
that are null or whose document is missing are not learnt from; an id with both labels counts as 0. Without both labels
every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import arrow_map, give_back, remainder, ship

MAX_PER_LABEL = 4000
PAIRS, EPOCHS, RATE, DECAY = 40_000, 6, 0.1, 1e-4
CUT = 0.3
KEEP_WEIGHT = 3.0

_UPPER, _LOWER, _DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"
_STOPS, _SYMBOLS = b".,;:!?", b"!#$%&*+<=>@^_|~\\/[]{}"
FEATURES = ["log_bytes", "log_words", "word_bytes", "upper", "digits", "high_bytes", "stops", "symbols", "symbol_kinds", "word_variety", "line_variety", "line_words", "spaces", "stops_per_word", "symbol_tails", "top_word", "repeats"]


def features(text: str | None) -> list[float]:
    """Shares and logs of surface counts of the whole text, all bounded."""
    data = (text or "").encode("utf-8", "surrogatepass")
    n, words, lines = max(1, len(data)), data.split(), [x for x in data.split(b"\n") if x.strip()]
    k = max(1, len(words))
    lost = lambda chars: len(data) - len(data.translate(None, chars))
    upper, lower, stops, symbols = lost(_UPPER), lost(_LOWER), lost(_STOPS), lost(_SYMBOLS)
    high = len(data) - len(data.translate(None, bytes(range(128, 256))))
    counts = np.unique(np.fromiter(map(hash, words), np.int64, len(words)), return_counts=True)[1] if words else np.zeros(1)
    return [np.log1p(len(data)), np.log1p(len(words)), min(50.0, sum(map(len, words)) / k), upper / max(1, upper + lower), lost(_DIGITS) / n, high / n, stops / n, symbols / n, sum(c in data for c in _SYMBOLS) / len(_SYMBOLS), np.log(max(1, len(counts))) / np.log(k + 1), len(set(lines)) / max(1, len(lines)), np.log1p(k / max(1, len(lines))), (data.count(b" ") + data.count(b"\n")) / n, min(5.0, stops / k), min(1.0, sum(data.count(bytes([c]) + b" ") for c in _SYMBOLS) / k), float(counts.max()) / k, sum(map(eq, words, words[1:])) / k]


@dataclass
class Model:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Latent scores of rows of features; outliers count as six deviations."""
        return np.clip((x - self.center) / self.scale, -6, 6) @ self.weights

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.scores(x) - self.threshold) + np.log(CUT / (1 - CUT)), -30, 30)))


def _constant() -> Model:
    d = len(FEATURES)
    return Model(np.zeros(d), np.ones(d), np.zeros(d), -np.log((1 - CUT) / CUT) * 1.0, 1.0)


def fit(x: np.ndarray, y: np.ndarray, share_of_0: float, seed: int = 11) -> Model:
    """x: features of the sample, y: its labels, share_of_0: label 0's share of all labelled rows."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return _constant()
    rng = np.random.default_rng(seed)
    model = Model(x.mean(axis=0), x.std(axis=0) + 1e-6, np.zeros(x.shape[1]), 0.0, 1.0)
    z = np.clip((x - model.center) / model.scale, -6, 6)
    for epoch in range(EPOCHS):
        gaps = z[rng.choice(good, PAIRS)] - z[rng.choice(bad, PAIRS)]
        for i in range(0, PAIRS, 64):
            g = gaps[i : i + 64]
            model.weights += RATE / (1 + epoch) * ((1 / (1 + np.exp(np.clip(g @ model.weights, -30, 30)))) @ g / len(g) - DECAY * model.weights)
    s = model.scores(x)
    weight = np.where(y == 1, (1 - share_of_0) / len(good), share_of_0 / len(bad))
    order = np.argsort(s)
    lost = np.cumsum(np.where(y == 1, weight, 0)[order])  # label-1 mass below each cut
    caught = np.cumsum(np.where(y == 0, weight, 0)[order])
    best = int(np.argmin(KEEP_WEIGHT * lost - caught)) if (KEEP_WEIGHT * lost - caught).min() < 0 else 0
    model.threshold = float((s[order][best] + s[order][min(best + 1, len(s) - 1)]) / 2)
    slopes = np.geomspace(0.05, 20, 60)
    logit = np.log(CUT / (1 - CUT))
    losses = [(weight * np.logaddexp(0, np.where(y == 1, -1, 1) * (a * (s - model.threshold) + logit))).sum() for a in slopes]
    model.slope = float(slopes[int(np.argmin(losses))])
    return model


def train(docs: DataFrame, labels: DataFrame, per_label: int = MAX_PER_LABEL) -> Model:
    """docs (doc_id, text), labels (doc_id, quality): only what may be learnt from."""
    ship(docs.sparkSession)
    labels = labels.select("doc_id", "quality").dropna().where("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sizes = {r["quality"]: r["count"] for r in labels.groupBy("quality").count().collect()}
    if set(sizes) != {0, 1}:
        return _constant()
    shares = F.when(F.col("quality") == 1, per_label / sizes[1]).otherwise(per_label / sizes[0])
    point = F.shiftrightunsigned(F.xxhash64(F.lit("quality"), "doc_id"), 11) / float(1 << 53)
    sample = F.broadcast(labels.where(point < shares).limit(4 * per_label))
    joined = docs.select("doc_id", "text").join(sample, "doc_id").select("quality", "text")

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array([features(t.as_py()) for t in batch.column(1)], pa.list_(pa.float64()))], ["quality", "x"])

    rows = sorted((r["quality"], tuple(r["x"])) for r in arrow_map(joined, each, "quality int, x array<double>").limit(8 * per_label).collect())
    if not rows:
        return _constant()
    return fit(np.array([r[1] for r in rows]), np.array([r[0] for r in rows]), sizes[0] / (sizes[0] + sizes[1]))


def probabilities(texts: pa.Array, model: Model) -> np.ndarray:
    return model.probabilities(np.array([features(t.as_py()) for t in texts], np.float64).reshape(-1, len(FEATURES)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every whole text."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(probabilities(batch.column(1), model), pa.float64())], ["doc_id", "score"])

    return arrow_map(docs.select("doc_id", "text"), each, "doc_id bigint, score double")


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """From labels of documents whose fold by id, of 5, is not 0."""
    return train(docs, labels.where(remainder(5) != 0))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, learn(docs, labels)).select("doc_id", (remainder(5) == 0).alias("held_out"), "score", F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns, that score at least CUT; a null text is scored as an empty one, repeated rows alike."""
    model, names = learn(docs, labels), docs.columns

    def over(batches):
        for batch in batches:
            yield batch.filter(pa.array(probabilities(batch.column(names.index("text")), model) >= CUT, pa.bool_()))
            give_back()

    return docs.mapInArrow(over, docs.schema)
