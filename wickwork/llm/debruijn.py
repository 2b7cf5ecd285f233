"""Substring dedup over words by compaction of a De Bruijn graph.

The edges of the graph are the `width`-word windows of the documents (token k-mers with
k = width); a node is an anchor, the smallest of the `K`-word substrings of a window, so
all edges that go through one occurrence of an anchor are one path. The steps are joins:

1. Each document's edges, path by path: one row (node, hash of the whole path, document,
   place), not one per edge.
2. Nodes of a single document are no repeats and fall away. A path that stands in several
   documents is compact: all its edges repeat, and are covered in every document but the
   first. At a node where all occurrences are one path (nonbranching) that is all.
3. At a branching node, the distinct paths, each in its first document only, are expanded
   to edges; an edge whose words also start in a smaller document is covered there.
4. Covered places go to their documents, overlapping ones flow together (source
   coordinates), and the words they cover are removed.

Words are [^\\x20\\x09-\\x0D]+, unchanged. Null and short texts have no windows and keep all
words. Rows without an id take no part and keep their words; rows that share an id are one
document each to themselves: they do not cover one another. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickwork.llm import spans, tokens
from wickwork.llm.common import staged

WIDTH, K = 50, 10
_TABLE = tokens.byte_table(tokens.BLANK_PARTED, lower=False)
_KEPT = "doc_id long, n_words long, n_removed long, text string"


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, _, hashes, first = tokens.words(data, offsets, _TABLE)
    return hashes, first, starts


def _edges(width: int):
    """Edges of the asked paths of each document: (edge, doc, start)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0)).astype(np.int64)
            for lo, hi, data, offsets in tokens.text_slices(batch.column(1)):
                values, rows, _ = _words(data, offsets)
                at, doc = [], []
                for row in range(hi - lo):
                    start, n = spans.unpacked(batch.column(2)[lo + row].values)
                    length = rows[row + 1] - rows[row]
                    own = np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    own = own[own + width <= length]  # paths of another row of the same id may lie beyond
                    at.append(own + rows[row])
                    doc.append(np.full(len(own), row))
                at, doc = np.concatenate(at), np.concatenate(doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens.span_hashes(values, at, at + width).view(np.int64)), pa.array(ids[lo:hi][doc]),
                     pa.array((at - rows[doc]).astype(np.int32))], ["edge", "doc", "start"],
                )

    return of


def covered_windows(docs: DataFrame, width: int = WIDTH, k: int = K) -> DataFrame:
    """(doc, start, n, more): runs of windows that also start in a document with a smaller id."""
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    paths = staged(spans.segments(docs, _words, width, k), "paths")
    compact, branching = spans.repeated(paths)
    asked = spans.by_document(branching.select("doc", "start", "n", "more"))
    edges = staged(
        docs.join(asked, F.col("doc_id") == F.col("doc")).select("doc_id", "text", "spans")
        .mapInArrow(_edges(width), "edge long, doc long, start int"), "edges",
    )
    firsts = edges.groupBy("edge").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    single = edges.join(firsts, "edge").where("doc > first").select(
        "doc", "start", F.lit(1).alias("n"), F.lit(None).cast("binary").alias("more")
    )
    return compact.unionByName(single)


def _cleaned(width: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_gone, texts = [], [], []
            for lo, hi, data, offsets in tokens.text_slices(batch.column(1)):
                starts, ends, _, first = tokens.words(data, offsets, _TABLE)
                for row in range(hi - lo):
                    a, b = first[row], first[row + 1]
                    gone = np.zeros(b - a, bool)
                    asked = batch.column(2)[lo + row]
                    if asked.is_valid:
                        own, n = spans.unpacked(asked.values)
                        fit = own + n + width - 1 <= b - a
                        gone = spans.covered_units((own[fit], n[fit]), b - a, width)
                    keep = np.flatnonzero(~gone) + a
                    raw = data.tobytes() if row == 0 else raw
                    texts.append(b" ".join([raw[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist())]))
                    n_words.append(int(b - a))
                    n_gone.append(int(gone.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()),
                 pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "text"],
            )

    return of


def remove_repeated(docs: DataFrame, width: int = WIDTH, k: int = K) -> DataFrame:
    """(doc_id, n_words, n_removed, text) of every row: the words that are left, joined by one blank."""
    covers = spans.by_document(covered_windows(docs, width, k))
    joined = docs.select("doc_id", "text").join(covers, F.col("doc_id") == F.col("doc"), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(_cleaned(width), _KEPT)
