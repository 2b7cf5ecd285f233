"""Suffix-array dedup over bytes with longest-previous-factor arrays.

A byte is removed when a `WIDTH`-byte string that covers it also starts in a document with
a smaller id. Texts are UTF-8 bytes; matches never cross documents. The steps:

1. Windows are gathered by anchors (see `spans`). A first pass finds the anchors of more than
   one document, a second one makes segments of those alone. Segments that stand unchanged
   in a smaller document are covered as a whole.
2. Where segments around an anchor differ, the bytes of each distinct segment, in its first
   document, go to the group of the anchor. A group, or several small ones together, gets
   one suffix array over the window starts of all its segments, compared on `WIDTH` bytes.
   An anchor with more than `GROUP_BYTES` of them, as at the edges of a passage that very many
   documents share, is settled apart: its windows meet by 128-bit hashes in an aggregate that keeps
   the smallest document of each, merged in the tasks.
3. Documents are the positions of the array. In suffix order, the longest previous factor of a
   suffix is shared with the previous or the next smaller position, whichever has more in
   common with it. Where it reaches `WIDTH` bytes, an earlier document has the window:
   later copies go, the first stays.

Null texts are empty. Rows without an id take no part and lose nothing. Rows that share an id
do not cover one another. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickwork.llm import spans, tokens
from wickwork.llm.common import staged

WIDTH, K = 50, 18
#: Bytes of segments of one anchor that a suffix array is made for; anchors share one up to half of that, on average.
GROUP_BYTES = 1 << 19
_ROWS = 256
_TABLE = tokens.byte_table(range(256), lower=False)
_KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _bytes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, None]:
    return _TABLE[data], offsets, None


def _cut(width: int):
    """The bytes of the asked segments: (h, doc, start, n, bytes)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):  # pieces of a few hundred texts at once
                batch = whole.slice(at, _ROWS)
                lists = batch.column(2)
                row = np.repeat(np.arange(batch.num_rows), np.asarray(lists.value_lengths()))
                flat = lists.flatten()
                more = flat.field("more")
                starts = [spans.starts_of(s, m.as_py() if m.is_valid else None) for s, m in zip(flat.field("start").to_pylist(), more)]
                item = np.repeat(np.arange(len(starts)), [len(s) for s in starts])
                start = np.concatenate(starts).astype(np.int64)
                n = np.asarray(flat.field("n")).astype(np.int64)[item]
                texts = [t.as_buffer().to_pybytes() for t in batch.column(1)]
                sizes = np.array([len(t) for t in texts])
                fit = start + n + width - 1 <= sizes[row[item]]  # another row of the same id may be shorter
                item, start, n = item[fit], start[fit], n[fit]
                own = row[item]
                pieces = [texts[r][a:b] for r, a, b in zip(own.tolist(), start.tolist(), (start + n + width - 1).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [flat.field("h").take(pa.array(item)), batch.column(0).take(pa.array(own)), pa.array(start.astype(np.int32)),
                     pa.array(n.astype(np.int32)), pa.array(pieces, pa.binary())], ["h", "doc", "start", "n", "piece"],
                )

    return of


def suffix_array(data: np.ndarray, at: np.ndarray, tie: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes of `data` at `at`, compared on `width` bytes, then by `tie`; and the
    length of the prefix that each has in common with the one before (0 for the first), up to `width`."""
    steps = [*range(0, width - 7, 8), *([width - 8] if width % 8 else [])]
    blocks = []
    for step in steps:
        key = np.zeros(len(at), np.uint64)
        for i in range(8):  # eight bytes as one number that sorts as they do
            key = (key << np.uint64(8)) | data[at + step + i].astype(np.uint64)
        blocks.append(key)
    order = np.lexsort((tie, *blocks[::-1]))
    common = np.zeros(len(at), np.int32)
    equal = np.arange(1, len(at))  # equal to the one before in all blocks so far
    for step, key in zip(steps, blocks):
        differ = key[order[equal]] ^ key[order[equal - 1]]
        unlike = differ != 0
        bits = differ[unlike]
        common[equal[unlike]] = step + sum((bits >> np.uint64(64 - 8 * i) == 0).astype(np.int32) for i in range(1, 8))
        equal = equal[~unlike]
    common[equal] = width
    return order, common


def _smaller(value: np.ndarray, common: np.ndarray, step: int, least: int) -> np.ndarray:
    """Length that each suffix has in common with its previous (`step` -1) or next (1) smaller position.

    Every suffix links to its neighbour, then takes over the link of whom it points to until
    that one's value is smaller; all in between are not. Equal values halve the way in
    each round. A suffix whose common length falls below `least` stops, with 0.
    """
    link = np.arange(len(value), dtype=np.int64) + step
    length = common.copy() if step < 0 else np.r_[common[1:], np.zeros(1, common.dtype)]
    length[length < least] = 0
    open_ = np.flatnonzero(length)
    open_ = open_[value[link[open_]] >= value[open_]]
    while len(open_):
        to = link[open_]
        reach, onward = np.minimum(length[open_], length[to]), link[to]
        length[open_], link[open_] = reach, onward
        open_, onward = open_[reach > 0], onward[reach > 0]
        open_ = open_[value[onward] >= value[open_]]
    return length


def longest_previous(order: np.ndarray, common: np.ndarray, doc: np.ndarray, least: int = 1) -> np.ndarray:
    """Longest previous factors: the length of the longest prefix of each suffix that also starts in a
    smaller document, up to the compared width; 0 where it is below `least`."""
    value = doc[order]
    found = np.zeros(len(order), common.dtype)
    found[order] = np.maximum(_smaller(value, common, -1, least), _smaller(value, common, 1, least))
    return found


def _matched(width: int):
    def of(rows):
        n = np.asarray(rows["n"]).astype(np.int64)
        pieces = rows["piece"].combine_chunks().cast(pa.large_binary())
        bounds = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset: pieces.offset + len(pieces) + 1]
        data = np.frombuffer(pieces.buffers()[2], np.uint8)
        first = np.cumsum(n) - n
        rel = np.arange(n.sum()) - np.repeat(first, n)
        piece = np.repeat(np.arange(len(n)), n)
        at, doc = bounds[piece] + rel, np.asarray(rows["doc"])[piece]
        order, common = suffix_array(data, at, doc, width)
        # Shorter factors decide nothing; below half a window they are not followed.
        hit = longest_previous(order, common, doc, max(1, width // 2)) >= width
        before = np.r_[False, hit[:-1]] & (rel > 0)
        lo = np.flatnonzero(hit & ~before)
        after = np.r_[hit[1:], False] & np.r_[rel[1:] > 0, False]
        hi = np.flatnonzero(hit & ~after) + 1
        start = np.asarray(rows["start"])[piece[lo]] + rel[lo]
        return pa.table({"doc": pa.array(doc[lo]), "start": pa.array(start.astype(np.int32)), "n": pa.array((hi - lo).astype(np.int32))})

    return of


def _windows(width: int):
    """Each window of the pieces: (doc, start, window)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(lo, _ROWS)
                n = np.asarray(batch.column(2)).astype(np.int64)
                pieces = batch.column(3)
                sizes = np.array([len(p.as_buffer()) for p in pieces], np.int64)
                data = np.frombuffer(b"".join(pieces.to_pylist()), np.uint8)
                piece = np.repeat(np.arange(len(n)), n)
                rel = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = (np.cumsum(sizes) - sizes)[piece] + rel
                flat = np.ascontiguousarray(data[at[:, None] + np.arange(width)])
                windows = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(at), [None, pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(piece)), pa.array((np.asarray(batch.column(1))[piece] + rel).astype(np.int32)),
                     windows.cast(pa.binary())], ["doc", "start", "window"],
                )

    return of


def _hot_matched(pieces: DataFrame, width: int) -> DataFrame:
    """(doc, start, n) like `_matched`, window by window and without a group in one task."""
    each = pieces.select("doc", "start", "n", "piece").mapInArrow(_windows(width), "doc long, start int, window binary")
    # 128 bits tell windows apart.
    windows = staged(each.select("doc", "start", F.xxhash64("window").alias("a"), F.xxhash64(F.lit(1), "window").alias("b")), "windows")
    firsts = windows.groupBy("a", "b").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    return windows.join(firsts, ["a", "b"]).where("doc > first").select("doc", "start", F.lit(1).alias("n"))


def covered_windows(docs: DataFrame, width: int = WIDTH, k: int = K) -> DataFrame:
    """(doc, start, n, more): runs of byte windows that also start in a document with a smaller id."""
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    anchors = spans.repeated_anchors(docs, _bytes, width, k)
    found = staged(spans.segments(docs, _bytes, width, k, anchors), "segments")
    whole, open_ = spans.repeated(found)
    asked = staged(open_.groupBy("doc").agg(F.collect_list(F.struct("h", "start", "n", "more")).alias("spans")), "asked")
    pieces = staged(
        docs.where(spans.maybe_among(docs, asked)).join(asked, F.col("doc_id") == F.col("doc")).select("doc_id", F.encode("text", "utf-8").alias("text"), "spans")
        .mapInArrow(_cut(width), "h long, doc long, start int, n int, piece binary"), "pieces",
    )
    total = pieces.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    groups = max(1, -(-total // (GROUP_BYTES // 2)))
    by_anchor = pieces.groupBy("h").agg(F.sum(F.octet_length("piece")).alias("size"))
    hot = staged(by_anchor.where(F.col("size") > GROUP_BYTES).select("h"), "hot")
    few, many = (pieces.join(hot, "h", how) for how in ("left_anti", "left_semi")) if not hot.isEmpty() else (pieces, None)
    matched = few.groupBy(F.pmod("h", F.lit(groups)).alias("group")).applyInArrow(_matched(width), "doc long, start int, n int")
    if many is not None:
        matched = matched.unionByName(_hot_matched(many, width))
    return whole.unionByName(matched.withColumn("more", F.lit(None).cast("binary")))


def _cleaned(width: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, _ROWS) for whole in batches for at in range(0, whole.num_rows, _ROWS)):
            out: list[list] = [[], [], [], []]
            for text, asked in zip(batch.column(1), batch.column(2)):
                raw = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
                none = np.empty(0, np.int64)
                start, n = spans.unpacked(asked.values) if asked.is_valid and len(asked.values) else (none, none)
                fit = start + n + width - 1 <= len(raw)
                lo, hi = spans.covered_runs((start[fit], n[fit]), len(raw), width)
                left = zip([0, *hi.tolist()], [*lo.tolist(), len(raw)])
                values = (len(raw), int((hi - lo).sum()), len(lo), b"".join([raw[a:b] for a, b in left]))
                for column, value in zip(out, values):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *[pa.array(x, pa.int64()) for x in out[:3]], pa.array(out[3], pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return of


def remove_repeated(docs: DataFrame, width: int = WIDTH, k: int = K) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; kept: the bytes that are left."""
    covers = staged(spans.by_document(covered_windows(docs, width, k)), "covers")
    raw = docs.select("doc_id", F.encode("text", "utf-8").alias("text"), spans.maybe_among(docs, covers).alias("maybe"))
    some = raw.where("maybe").join(covers, F.col("doc_id") == F.col("doc"), "left").select("doc_id", "text", "spans")
    # Texts that surely lose nothing need no second Python worker beside that of the filter.
    whole = F.coalesce("text", F.lit(b""))
    nothing = F.lit(0).cast("long")
    rest = raw.where("NOT maybe").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(whole).cast("long").alias("n_bytes"),
        nothing.alias("n_removed"), nothing.alias("n_spans"), whole.alias("kept"),
    )
    return some.mapInArrow(_cleaned(width), _KEPT).unionByName(rest)
