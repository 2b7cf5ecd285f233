"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A text is a bag of words: runs of letters, digits and characters beyond ASCII, in lower
case. A word is the mean of the vectors of its subwords: the word itself and its character
n-grams (3 to 5, with marks at both ends), hashed into `BUCKETS` rows of one table. So
words never seen, misspellings among them, share n-gram vectors with known ones. A
text is the mean of its words; two linear outputs over it go through a softmax. Table
and outputs are trained jointly in numpy (Adam, whole batches).

The classifier is fitted on at most `SAMPLE` labelled rows, those with the smallest hashes
of their ids, inside one task; what leaves it is one number per bucket (the mean is
linear, so a bucket's vector counts only by its product with the outputs), 1 MB.
Scoring reads every whole text. Null and empty texts get the score of the bias.

Rows without a label, an id or a text are not learnt from; an id with several labels takes
the largest. Without any labelled row the score is 0. Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickwork.llm import tokens

SAMPLE = 5000
BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
DIMENSIONS = 8
MIN_TEXTS = 4
Z_SCORE = 4.5
ROUNDS = 150
DECAY = 1e-4
RATE = 0.02
SCALE = 1000.0
REJECT_FROM = 0.7
_SLICE = 1 << 19
_MODEL = "weights binary, bias double"


def held_out(id_: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_).cast("string")) % 3 == 1, F.lit(False))


class Bags:
    """Subwords of the words of some texts: `buckets` by word, words by text."""

    def __init__(self, texts: list[str]):
        joined = " " + " ".join(texts) + " "
        points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
        inside = (points > 127) | ((points >= 48) & (points <= 57)) | ((points >= 97) & (points <= 122))
        values = np.where(inside, tokens.mix(points.astype(np.uint64)), np.uint64(1))
        edge = np.diff(inside.astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
        bounds = np.cumsum([1] + [len(t) + 1 for t in texts])
        self.first = np.searchsorted(self.starts, bounds)
        self.spans = tokens.Spans(values)
        self.hashes = self.spans.of(self.starts, self.ends)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bucket of the n-gram at each place, and which of these places each word has."""
        buckets = (self.spans.runs(n) % np.uint64(BUCKETS)).astype(np.int32)
        begin = self.starts - 1
        return buckets, begin, np.maximum(self.ends + 2 - n, begin)

    def word_buckets(self) -> np.ndarray:
        return (self.hashes % np.uint64(BUCKETS)).astype(np.int32)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Mean over words of the mean weight of their subwords, by text; 0 without words."""
        total = weights[self.word_buckets()].astype(np.float64)
        count = np.ones(len(total))
        for n in GRAMS:
            buckets, lo, hi = self.grams(n)
            sums = np.r_[0.0, np.cumsum(weights[buckets], dtype=np.float64)]
            total += sums[np.minimum(hi, len(buckets))] - sums[np.minimum(lo, len(buckets))]
            count += hi - lo
        sums = np.r_[0.0, np.cumsum(total / count)]
        words = np.diff(self.first)
        return (sums[self.first[1:]] - sums[self.first[:-1]]) / np.maximum(words, 1)


def _slices(texts: list[str | None]) -> Iterator[list[str]]:
    part: list[str] = []
    size = 0
    for text in texts:
        text = (text or "").lower()
        if part and size + len(text) > _SLICE:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text) + 1
    if part:
        yield part


class _Adam:
    def __init__(self, value: np.ndarray):
        self.value, self.m, self.v, self.t = value, np.zeros_like(value), np.zeros_like(value), 0

    def step(self, grad: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.01 * (grad * grad - self.v)
        self.value -= RATE * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-8)


def _shares(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, share) of all subwords, and each text's number of words.

    A share is what a bucket's vector counts for in the mean of the text's words.
    """
    out, counts, done = [], [], 0
    for part in _slices(texts):
        bags = Bags(part)
        words = np.diff(bags.first)
        text = np.repeat(np.arange(len(part)), words)
        whole = bags.word_buckets()
        grams = [bags.grams(n) for n in GRAMS]
        size = 1 + sum(hi - lo for _, lo, hi in grams)
        weight = 1 / size / words[text]
        keys, shares = [text * BUCKETS + whole], [weight]
        for buckets, lo, hi in grams:
            n = hi - lo
            at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            keys.append(np.repeat(text, n) * BUCKETS + buckets[at])
            shares.append(np.repeat(weight, n))
        key, back = np.unique(np.concatenate(keys), return_inverse=True)
        out.append((key // BUCKETS + done, key % BUCKETS, np.bincount(back, np.concatenate(shares))))
        counts.append(words)
        done += len(part)
    text, bucket, share = (np.concatenate(x) for x in zip(*out))
    return text, bucket, share, np.concatenate(counts)


def _telling(text: np.ndarray, bucket: np.ndarray, share: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Buckets whose share goes with the label beyond chance: |correlation| of `Z_SCORE` deviations,
    seen in at least `MIN_TEXTS` texts. The others would only be learnt by heart."""
    n = len(labels)
    away = labels - labels.mean()
    seen, total = np.bincount(bucket, minlength=BUCKETS), np.bincount(bucket, share, BUCKETS)
    spread = np.bincount(bucket, share * share, BUCKETS) - total * total / n
    with np.errstate(divide="ignore", invalid="ignore"):
        z = np.bincount(bucket, share * away[text], BUCKETS) / np.sqrt(spread * max(away.var(), 1e-12))
    return np.flatnonzero((seen >= MIN_TEXTS) & (np.abs(z) >= Z_SCORE) & (spread > 0))


def train(texts: list[str], labels: np.ndarray, rounds: int = ROUNDS, seed: int = 1) -> tuple[np.ndarray, float]:
    """(weight of each bucket, bias) of the logit."""
    weights = np.zeros(BUCKETS, np.float32)
    if not len(labels):
        return weights, -50.0
    labels = labels.astype(np.int64)
    text, bucket, share, _ = _shares(texts)
    kept = _telling(text, bucket, share, labels)
    number = np.full(BUCKETS, -1)
    number[kept] = np.arange(len(kept))
    own = number[bucket] >= 0
    text, feature, share = text[own], number[bucket[own]], share[own] * SCALE
    random = np.random.default_rng(seed)
    table = _Adam(random.normal(0, 0.01, (len(kept), DIMENSIONS)))
    out = _Adam(random.normal(0, 0.5, (DIMENSIONS, 2)))
    bias = _Adam(np.zeros(2))
    by_dimension = range(DIMENSIONS)
    for _ in range(rounds):
        mean = np.stack([np.bincount(text, share * table.value[feature, d], len(labels)) for d in by_dimension], axis=1)
        logits = mean @ out.value + bias.value
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(labels)), labels] -= 1
        p /= len(labels)
        back = p @ out.value.T
        grad = np.stack([np.bincount(feature, share * back[text, d], len(kept)) for d in by_dimension], axis=1)
        out.step(mean.T @ p + DECAY * out.value)
        bias.step(p.sum(axis=0))
        table.step(grad + DECAY * table.value)
    weights[kept] = table.value @ (out.value[:, 1] - out.value[:, 0]) * SCALE
    return weights, float(bias.value[1] - bias.value[0])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[bytes, float]:
    """Weights and bias learnt from at most `sample` labelled rows that are not held out."""
    given = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out())
    chosen = given.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_toxic")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(
        F.broadcast(chosen), F.col("doc_id") == F.col("_id")  # at most `sample` rows of two numbers
    )
    one = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("_toxic").alias("toxic"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((i, t, y) for b in batches for i, t, y in zip(*(c.to_pylist() for c in b.columns)))
        weights, bias = train([t for _, t, _ in got], np.array([y for *_, y in got], np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([bias])], ["weights", "bias"])

    model = one.select("doc_id", "text", F.col("toxic").cast("int")).repartition(1).mapInArrow(learn, _MODEL).first()
    return (bytes(model["weights"]), model["bias"]) if model else (np.zeros(BUCKETS, np.float32).tobytes(), -50.0)


def score(docs: DataFrame, model: tuple[bytes, float], out: str = "score") -> DataFrame:
    """`docs` with the chance from 0 to 1 that the text is toxic in `out`, in place of a column of that name."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, bias = np.frombuffer(known.value[0], np.float32), known.value[1]
        for texts in parts:
            logit = np.concatenate([Bags(p).scores(weights) for p in _slices(texts.tolist())] or [np.empty(0)]) + bias
            yield pd.Series(1 / (1 + np.exp(-np.clip(logit, -50, 50))))

    return docs.withColumn(out, of(F.col("text")))


def clean(docs: DataFrame, labels: DataFrame, reject_from: float = REJECT_FROM) -> DataFrame:
    """Rows of `docs` whose score is below `reject_from`."""
    own = "_score"
    while own in docs.columns:
        own += "_"
    return score(docs, fit(docs, labels), own).where(F.col(own) < reject_from).drop(own)
