"""Repeated windows of a corpus, found through anchors: what the two substring operators share.

A window is `width` consecutive units (bytes or words) of one text. Its anchor is the
smallest hash among its `k`-unit substrings, the first of equals. So equal windows have
equal anchors at equal places, and consecutive windows mostly share one anchor: about one
anchor in (width - k) / 2 units. All windows of a text with one anchor make a segment,
one row instead of many. Segments are compared first, as wholes; single windows only where
the segments around an anchor differ.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickwork.llm import tokens
from wickwork.llm.common import staged

SEGMENT = "h long, seg long, doc long, start int, n int, more binary, done boolean"
#: Units of each row of a slice: (values with one 64-bit hash per unit, row offsets in units,
#: first byte of each unit, or None where a unit is a byte).
Units = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray | None]]


def _anchored(values: np.ndarray, rows: np.ndarray, width: int, k: int):
    """Segments of a slice: (anchor hashes, row, first unit, end of the first units of windows, hashes)."""
    last = len(values) - width + 1
    if last <= 0:
        none = np.empty(0, np.int64)
        return none.view(np.uint64), none, none, none, None
    hashes = tokens.Spans(values)
    keys = hashes.runs(k)
    anchor = tokens.minimizers(keys, width - k + 1)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))[:last]
    inside = np.arange(last) + width <= rows[row + 1]
    new = np.ones(last, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    new |= ~inside
    begin = np.flatnonzero(new & inside)
    stops = np.flatnonzero(np.r_[new, True])
    return keys[anchor[begin]], row[begin], begin, stops[np.searchsorted(stops, begin, "right")], hashes


#: Bytes of one text that are looked at together, and rows of a batch.
PIECE_BYTES, PIECE_ROWS = tokens.SLICE_BYTES, 1024


def _pieces(column: pa.Array, units: Units, width: int, k: int):
    """(row, anchor, first window in its text, begin, end, hashes) of the segments of a batch, a bounded part at a time.

    A text longer than `PIECE_BYTES` is read in pieces. A piece that is not the last leaves out
    its last unit, which may be cut, and its last segment, which may go on: the next piece
    begins there. So segments are those of the whole text, however long it is.
    """
    for at in range(0, len(column), PIECE_ROWS):
        for lo, hi, data, offsets in tokens.text_slices(column.slice(at, PIECE_ROWS)):
            if hi - lo == 1 and len(data) > PIECE_BYTES:
                for h, start, begin, end, hashes in _long(data, units, width, k):
                    yield np.full(len(h), at + lo), h, start, begin, end, hashes
                continue
            values, rows, _ = units(data, offsets)
            h, row, begin, end, hashes = _anchored(values, rows, width, k)
            if len(h):
                yield row + at + lo, h, begin - rows[row], begin, end, hashes


def _long(data: np.ndarray, units: Units, width: int, k: int):
    at, before, size = 0, 0, PIECE_BYTES
    while True:
        last = at + size >= len(data)
        part = data[at: at + size]
        values, rows, places = units(part, np.array([0, len(part)]))
        if not last:
            values, rows = values[:-1], np.array([0, max(len(values) - 1, 0)])
        h, _, begin, end, hashes = _anchored(values, rows, width, k)
        if last:
            if len(h):
                yield h, begin + before, begin, end, hashes
            return
        onward = int(begin[-1]) if len(h) else 0
        if not onward:  # very long words: no segment is known to end in this piece
            size *= 2
            continue
        yield h[:-1], begin[:-1] + before, begin[:-1], end[:-1], hashes
        at += onward if places is None else int(places[onward])
        before, size = before + onward, PIECE_BYTES


#: Size of a filter: 64 parts of 2^20 bits, 8 MB, whatever the input.
FILTER_PARTS, FILTER_BITS = 64, 1 << 20


def _in_filter(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    part, bit = h % np.uint64(FILTER_PARTS), (h // np.uint64(FILTER_PARTS)) % np.uint64(FILTER_BITS)
    place = part * np.uint64(FILTER_BITS) + bit
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def repeated_anchors(docs: DataFrame, units: Units, width: int, k: int) -> np.ndarray:
    """Bit filter of the anchors that stand in more than one document.

    Its size is fixed. With many more anchors than bits it lets ever more pass that stand
    in one document; those are dropped later, so only the work grows, never the result.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0)).astype(np.int64)
            for row, h, *_ in _pieces(batch.column(1), units, width, k):
                doc = ids[row]
                order = np.argsort(h, kind="stable")
                at = np.flatnonzero(np.r_[True, np.diff(h[order]) != 0])
                several = np.maximum.reduceat(doc[order], at) > np.minimum.reduceat(doc[order], at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[order][at].view(np.int64)), pa.array(1 + several.astype(np.int32))], ["h", "docs"]
                )

    # A document lies in one slice, so two slices, or one with two documents, tell repeats. An anchor that
    # a long text has in two of its pieces passes too; it is dropped later.
    seen = docs.mapInArrow(of, "h long, docs int").groupBy("h").agg(F.sum("docs").alias("docs"))
    return bit_filter(seen.where("docs > 1").select("h"))


def bit_filter(hashes: DataFrame) -> np.ndarray:
    """The fixed-size filter of all values of `h`, built part by part."""

    def bits(rows):
        slot = np.asarray(rows["slot"].combine_chunks())
        one = np.zeros(FILTER_BITS, np.uint8)
        one[slot] = 1
        return pa.table({"part": rows["part"][:1], "bits": pa.array([np.packbits(one, bitorder="little").tobytes()], pa.binary())})

    slot = F.shiftrightunsigned("h", 6).bitwiseAND(FILTER_BITS - 1)
    # Distinct slots: a part gets no more rows than it has bits.
    held = hashes.select(F.col("h").bitwiseAND(FILTER_PARTS - 1).alias("part"), slot.alias("slot")).distinct()
    out = np.zeros(FILTER_PARTS * FILTER_BITS // 8, np.uint8)
    for row in held.groupBy("part").applyInArrow(bits, "part long, bits binary").toLocalIterator():
        out[row["part"] * FILTER_BITS // 8: (row["part"] + 1) * FILTER_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def maybe_among(docs: DataFrame, ids: DataFrame):
    """Column of `docs`: false only if its doc_id is surely not among `ids` (doc).

    Texts of other documents then need no shuffle to be joined with what is known of a few.
    """
    known = docs.sparkSession.sparkContext.broadcast(bit_filter(ids.select(F.xxhash64("doc").alias("h"))))

    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for hashes in parts:
            yield pd.Series(_in_filter(known.value, hashes.to_numpy(np.int64).view(np.uint64)))

    return F.pandas_udf(of, "boolean")(F.xxhash64("doc_id"))


_ROWS = 100_000  # segments that are put together at once


def segments(docs: DataFrame, units: Units, width: int, k: int, only: np.ndarray | None = None) -> DataFrame:
    """(h, seg, doc, start, n, more) of `docs` (doc, text): anchor hash, hash of the units of all
    its windows, first window and number of windows; `more` are further starts of equal
    segments of the document (int32). Texts shorter than a window have none. `only`: a
    filter of anchors (`repeated_anchors`); the rest stand in one document. Of equal segments
    put together all but that of the smallest document are `done`: known to be covered, so
    a segment of very many documents does not gather in a task."""
    wanted = None if only is None else docs.sparkSession.sparkContext.broadcast(only)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0)).astype(np.int64)
            parts = []
            for row, h, start, begin, end, hashes in _pieces(batch.column(1), units, width, k):
                if wanted is not None:
                    keep = _in_filter(wanted.value, h)
                    row, h, start, begin, end = (x[keep] for x in (row, h, start, begin, end))
                seg = hashes.of(begin, end + width - 1)
                parts.append((h, seg, row, start.astype(np.int32), (end - begin).astype(np.int32)))
                if sum(len(p[0]) for p in parts) >= _ROWS:
                    yield from _packed(ids, *map(np.concatenate, zip(*parts)))
                    parts = []
            if parts:
                yield from _packed(ids, *map(np.concatenate, zip(*parts)))

    return docs.mapInArrow(of, SEGMENT)


def _packed(ids, h, seg, row, start, n) -> Iterator[pa.RecordBatch]:
    """One row for each (document, anchor, segment); its further starts go to `more`."""
    if not len(h):
        return
    order = np.lexsort((start, seg, row))
    row, h, seg, start, n = row[order], h[order], seg[order], start[order], n[order]
    first = np.ones(len(h), bool)
    first[1:] = (row[1:] != row[:-1]) | (seg[1:] != seg[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(first)
    size = np.diff(np.r_[at, len(h)])
    more: list[bytes | None] = [None] * len(at)
    for i in np.flatnonzero(size > 1):
        more[i] = start[at[i] + 1: at[i] + size[i]].tobytes()
    h, seg, doc = h[at], seg[at], ids[row[at]]
    order = np.lexsort((doc, seg, h))
    new = np.r_[True, (h[order[1:]] != h[order[:-1]]) | (seg[order[1:]] != seg[order[:-1]])]
    begins = np.flatnonzero(new)
    done = np.empty(len(h), bool)
    done[order] = doc[order] > np.repeat(doc[order[begins]], np.diff(np.r_[begins, len(h)]))
    yield pa.RecordBatch.from_arrays(
        [pa.array(h.view(np.int64)), pa.array(seg.view(np.int64)), pa.array(doc), pa.array(start[at]),
         pa.array(n[at]), pa.array(more, pa.binary()), pa.array(done)],
        ["h", "seg", "doc", "start", "n", "more", "done"],
    )


def repeated(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(covered, open) of staged segments.

    covered: segments that also stand in a document with a smaller id: all their windows
    do. open: the first occurrence of each distinct segment at an anchor that has several,
    in more than one document; which of its windows repeat is to be seen window by window.
    """
    # For each segment that is done, one of a smaller document is among the rest, so the rest
    # have all ways of an anchor; an anchor with one way is settled by its first document.
    by_anchor, by_segment = Window.partitionBy("h"), Window.partitionBy("h", "seg")
    marked = (
        found.where("NOT done")
        .withColumns({"lo": F.min("doc").over(by_anchor), "hi": F.max("doc").over(by_anchor),
                      "ways": F.min("seg").over(by_anchor) != F.max("seg").over(by_anchor)})
        .where("lo < hi")
        .withColumn("first", F.min("doc").over(by_segment))
    )
    known = staged(marked.where("doc > first OR ways").select("h", "doc", "start", "n", "more", "first"), "known")
    done = found.where("done").select("doc", "start", "n", "more")
    covered = known.where("doc > first").select("doc", "start", "n", "more").unionByName(done)
    open_ = known.where("doc = first").select("h", "doc", "start", "n", "more")
    return covered, open_


def starts_of(start: int, more: bytes | None) -> np.ndarray:
    return np.r_[start, np.frombuffer(more, np.int32)] if more else np.array([start])


def by_document(covers: DataFrame) -> DataFrame:
    """(doc, spans): for each document its covered runs of windows, packed as they come."""
    return covers.groupBy("doc").agg(F.collect_list(F.struct("start", "n", "more")).alias("spans"))


def covered_runs(spans, length: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the maximal covered runs of a text of `length` units; spans: arrays of starts and counts
    of windows. Memory follows the spans, not the text."""
    starts, counts = spans
    order = np.argsort(starts, kind="stable")
    begin = starts[order]
    reach = np.maximum.accumulate(np.minimum(begin + counts[order] + width - 1, length))
    new = np.flatnonzero(np.r_[np.ones(min(len(begin), 1), bool), begin[1:] > reach[:-1]])
    return begin[new], reach[np.r_[new[1:], len(begin)] - 1] if len(begin) else reach


def covered_units(spans, length: int, width: int) -> np.ndarray:
    """Which of `length` units lie in a covered window; spans: arrays of starts and counts of windows."""
    change = np.zeros(length + 1, np.int8)
    begin, end = covered_runs(spans, length, width)
    change[begin] = 1
    change[end] -= 1
    return np.cumsum(change[:length], dtype=np.int8) > 0


def unpacked(spans: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and counts of one document's `spans`, with those in `more`."""
    start, n = np.asarray(spans.field("start")).astype(np.int64), np.asarray(spans.field("n")).astype(np.int64)
    more = spans.field("more")
    if more.null_count < len(more):
        extra = [(np.frombuffer(x.as_py(), np.int32), c) for x, c in zip(more, n) if x.is_valid]
        start = np.r_[start, *[x for x, _ in extra]].astype(np.int64)
        n = np.r_[n, *[np.full(len(x), c) for x, c in extra]].astype(np.int64)
    return start, n
