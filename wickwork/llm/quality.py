"""Quality by a convolutional network over bytes.

A text is its UTF-8 bytes, cut into chunks of `CHUNK` window starts; neighbouring chunks overlap by
`WIDTH` - 1 bytes, so every window of every text lies in one chunk. In a chunk each of
`FILTERS` filters, `WIDTH` bytes wide over byte vectors of `DIMENSIONS` numbers, is applied
at every window; the largest value of a filter, through tanh, is the chunk's feature. The features of
all chunks of a text, averaged by their number of windows, go through one logistic output. Byte vectors,
filters and output are trained jointly in numpy (Adam, small batches).

The network is fitted on at most `SAMPLE` labelled rows, those with the smallest hashes of
their ids. Of a text it learns from at most `LEARN_CHUNKS` chunks, spread evenly; they are
cut out where the text is, so the one task that learns gets at most SAMPLE * LEARN_CHUNKS *
(CHUNK + WIDTH - 1) bytes. What leaves it are tables of one row for each byte and place in a
window. Scoring reads every whole text, a bounded piece at a time.

Null and empty texts are one window of zero bytes. Rows without a label, an id or a text
are not learnt from; an id with several labels takes the largest, one with several texts the
smallest. Without any labelled row every score is 0.5. Repeated rows are scored alike. A
column named score is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickwork.llm import tokens

SAMPLE, LEARN_CHUNKS = 4000, 8
CHUNK, WIDTH = 128, 6
DIMENSIONS, FILTERS = 8, 16
#: Rounds over the sample, more of them if they have fewer than `STEPS` batches.
EPOCHS, STEPS, BATCH = 16, 300, 64
RATE, DECAY = 0.01, 1e-5
ACCEPT_FROM = 0.5
_SPAN = CHUNK + WIDTH - 1
_PIECE = 1 << 15
_LEARN = "doc_id long, label int, chunks binary, windows binary"
_MODEL = "tables binary, offsets binary, weights binary, bias double"


def held_out(id_: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_).cast("string")) % 3 == 1, F.lit(False))


def chunk_bounds(size: int) -> tuple[np.ndarray, np.ndarray]:
    """First window of each chunk of a text of `size` bytes, and the end of its windows."""
    windows = max(size, 1)
    starts = np.arange(0, windows, CHUNK)
    return starts, np.minimum(starts + CHUNK, windows)


def convolve(data: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Value of each filter at each window of `data`: (windows, filters)."""
    n = len(data) - WIDTH + 1
    out = tables[0][data[:n]]
    for place in range(1, WIDTH):
        out += tables[place][data[place: place + n]]
    return out


class Network:
    """A trained network: `tables` (place, byte, filter), `offsets`, `weights`, `bias`."""

    def __init__(self, tables: np.ndarray, offsets: np.ndarray, weights: np.ndarray, bias: float):
        self.tables, self.offsets, self.weights, self.bias = tables, offsets, weights, bias

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Logit of each text of a slice: `data`, its bytes, and the `offsets` of the texts."""
        sizes = np.diff(offsets)
        bounds = [chunk_bounds(int(s)) for s in sizes]
        # Each text is followed by zero bytes, so that every byte of it begins a window.
        places = np.r_[0, np.cumsum(np.maximum(sizes, 1) + WIDTH - 1)]
        padded = np.zeros(places[-1], np.uint8)
        for row, place in enumerate(places[:-1].tolist()):
            padded[place: place + sizes[row]] = data[offsets[row]: offsets[row + 1]]
        starts = np.concatenate([b[0] + p for b, p in zip(bounds, places)])
        ends = np.concatenate([b[1] + p for b, p in zip(bounds, places)])
        text = np.repeat(np.arange(len(sizes)), [len(b[0]) for b in bounds])
        value = np.empty(len(starts))
        at = 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + _PIECE, "right")))
            values = convolve(padded[starts[at]: ends[to - 1] + WIDTH - 1], self.tables)
            cuts = np.stack([starts[at:to], ends[at:to]], axis=1).ravel() - starts[at]
            largest = np.maximum.reduceat(values, cuts[:-1], axis=0)[::2]
            value[at:to] = np.tanh(largest + self.offsets) @ self.weights
            at = to
        windows = (ends - starts).astype(np.float64)
        return np.bincount(text, value * windows, len(sizes)) / np.bincount(text, windows, len(sizes)) + self.bias


class _Adam:
    def __init__(self, value: np.ndarray):
        self.value, self.m, self.v, self.t = value, np.zeros_like(value), np.zeros_like(value), 0

    def step(self, grad: np.ndarray, rate: float) -> None:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.01 * (grad * grad - self.v)
        self.value -= rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-8)


def train(chunks: list[np.ndarray], windows: list[np.ndarray], labels: np.ndarray, seed: int = 1) -> Network:
    """Network learnt from each text's chunks (number, `_SPAN` bytes) and their numbers of windows."""
    random = np.random.default_rng(seed)
    vectors = _Adam(random.normal(0, 0.5, (256, DIMENSIONS)))
    filters = _Adam(random.normal(0, 0.4, (WIDTH, DIMENSIONS, FILTERS)))
    offsets, weights = _Adam(np.full(FILTERS, -1.0)), _Adam(random.normal(0, 0.3, FILTERS))
    share = np.clip(labels.mean(), 0.01, 0.99) if len(labels) else 0.5
    bias = _Adam(np.array([np.log(share / (1 - share))]))
    used = np.zeros(256, bool)
    for c in chunks:
        used[np.unique(c)] = True
    batches = -(-len(labels) // BATCH)
    epochs = max(EPOCHS, -(-STEPS // batches)) if batches else 0
    steps, done = epochs * batches, 0
    for _ in range(epochs):
        order = random.permutation(len(labels))
        for lo in range(0, len(order), BATCH):
            rows = order[lo: lo + BATCH]
            own = np.concatenate([chunks[r] for r in rows])
            count = np.concatenate([windows[r] for r in rows])
            text = np.repeat(np.arange(len(rows)), [len(chunks[r]) for r in rows])
            weight = count / np.bincount(text, count)[text]
            tables = np.einsum("bd,wdf->wbf", vectors.value, filters.value).astype(np.float32)
            values = convolve(own.ravel(), tables)
            values = np.concatenate([values, np.zeros((WIDTH - 1, FILTERS), np.float32)]).reshape(len(own), _SPAN, FILTERS)[:, :CHUNK]
            values = np.where(np.arange(CHUNK)[:, None] < count[:, None, None], values, -np.inf)
            place = values.argmax(axis=1)
            largest = np.take_along_axis(values, place[:, None], 1)[:, 0]
            feature = np.tanh(largest + offsets.value)
            mean = np.stack([np.bincount(text, weight * f, len(rows)) for f in feature.T], axis=1)
            p = 1 / (1 + np.exp(-np.clip(mean @ weights.value + bias.value[0], -50, 50)))
            back = (p - labels[rows]) / len(rows)
            from_feature = back[text, None] * weight[:, None] * weights.value * (1 - feature**2)
            grads = np.zeros((WIDTH, 256, FILTERS))
            for w in range(WIDTH):
                byte = np.take_along_axis(own, place + w, 1).astype(np.int64)
                grads[w] = np.bincount((byte * FILTERS + np.arange(FILTERS)).ravel(), from_feature.ravel(), 256 * FILTERS).reshape(256, FILTERS)
            to_vectors = np.einsum("wbf,wdf->bd", grads, filters.value)
            to_filters = np.einsum("wbf,bd->wdf", grads, vectors.value)
            rate = RATE * 0.5 * (1 + np.cos(np.pi * done / steps))
            weights.step(mean.T @ back + DECAY * weights.value, rate)
            bias.step(np.array([back.sum()]), rate)
            offsets.step(from_feature.sum(axis=0), rate)
            vectors.step(to_vectors + DECAY * vectors.value, rate)
            filters.step(to_filters + DECAY * filters.value, rate)
            done += 1
    vectors.value[~used] = vectors.value[used].mean(axis=0) if used.any() else 0  # bytes never seen are like the average one
    tables = np.einsum("bd,wdf->wbf", vectors.value, filters.value).astype(np.float32)
    if not len(labels):
        return Network(tables, np.zeros(FILTERS), np.zeros(FILTERS), 0.0)
    return Network(tables, offsets.value, weights.value, float(bias.value[0]))


def _some_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, label, chunks, windows): at most `LEARN_CHUNKS` chunks of each text."""
    for batch in batches:
        out: list[tuple[bytes, bytes]] = []
        for text in batch.column(2):
            raw = np.frombuffer(text.as_buffer(), np.uint8)
            starts, ends = chunk_bounds(len(raw))
            if len(starts) > LEARN_CHUNKS:
                some = np.linspace(0, len(starts) - 1, LEARN_CHUNKS).astype(np.int64)
                starts, ends = starts[some], ends[some]
            chunks = np.zeros((len(starts), _SPAN), np.uint8)
            for i, start in enumerate(starts.tolist()):
                part = raw[start: start + _SPAN]
                chunks[i, : len(part)] = part
            out.append((chunks.tobytes(), (ends - starts).astype(np.int32).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *[pa.array(x, pa.binary()) for x in (list(zip(*out)) or [(), ()])]], ["doc_id", "label", "chunks", "windows"]
        )


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network:
    """Network learnt from at most `sample` labelled rows that are not held out."""
    given = labels.select("doc_id", "quality").where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out())
    chosen = given.groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").cast("int").alias("_label")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long"), "text").where("text IS NOT NULL").join(
        F.broadcast(chosen), F.col("doc_id") == F.col("_id")  # at most `sample` rows of two numbers
    ).select("doc_id", F.col("_label").alias("label"), F.encode("text", "utf-8").alias("text"))
    one = rows.mapInArrow(_some_chunks, _LEARN).groupBy("doc_id").agg(F.min(F.struct("chunks", "windows", "label")).alias("own"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((i, y, c, w) for b in batches for i, y, c, w in zip(*(x.to_pylist() for x in b.columns)))
        network = train(
            [np.frombuffer(c, np.uint8).reshape(-1, _SPAN) for _, _, c, _ in got],
            [np.frombuffer(w, np.int32).astype(np.float64) for *_, w in got], np.array([y for _, y, _, _ in got], np.float64),
        )
        parts = [pa.array([x.tobytes()], pa.binary()) for x in (network.tables, network.offsets, network.weights)]
        yield pa.RecordBatch.from_arrays([*parts, pa.array([network.bias])], ["tables", "offsets", "weights", "bias"])

    model = one.select("doc_id", "own.label", "own.chunks", "own.windows").repartition(1).mapInArrow(learn, _MODEL).first()
    if not model:
        return train([], [], np.empty(0))
    tables, offsets, weights = (np.frombuffer(bytes(model[k]), t) for k, t in (("tables", np.float32), ("offsets", np.float64), ("weights", np.float64)))
    return Network(tables.reshape(WIDTH, 256, FILTERS), offsets, weights, model["bias"])


def score(docs: DataFrame, network: Network) -> DataFrame:
    """`docs` with `score`, the chance from 0 to 1 that the text is of good quality."""
    known = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            column = pa.array(texts, pa.large_binary())
            out = [known.value.logits(data, offsets) for _, _, data, offsets in tokens.text_slices(column)]
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.concatenate(out) if out else np.empty(0), -50, 50))))

    return docs.withColumn("score", of(F.encode("text", "utf-8")))
