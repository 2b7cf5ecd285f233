"""Ranked lexical search by the Best Position Algorithm.

A term of an item gives a document an impact, `weight * saturated count`, and an item ranks the
documents by the sum of its terms' impacts. Documents are dealt into shards of about
`SHARD_POSTINGS` postings. In its shard a term has an impact list: its documents, largest
impact first. For each item a shard

1. reads the lists of the item's terms side by side, a few entries at a time;
2. looks each new document up in all the lists directly, which gives its score and marks its
   position in every list as seen, not only in the list that was read;
3. keeps each list's best position, the end of its unbroken run of seen positions. A
   document not seen so far has at most the impact at the best position of each list, and
   none from a list that is wholly seen. This bound falls faster than that of the last positions
   read, as direct accesses fill the gaps ahead;
4. stops when the bound is strictly below the k-th best score: an equal score would still
   count, as ties go to the smaller doc_id.

The best `k` of each shard are then merged for each item. Impacts are 64-bit integers, so results
do not depend on how documents were dealt. Statistics (documents, terms, document
frequencies) are counted over all documents.

Items are dealt into blocks of about `BLOCK_TERMS` terms; only one block's terms are with the driver
and broadcast at a time, whatever the number of items. Texts are cut into words a
bounded piece at a time.

Terms: letters and digits of ASCII and all characters beyond it, only A-Z in lower case. A
null or empty text has none. Rows of one item_id (a null one too) are one item with the
terms of all; an item without terms, or whose terms no document has, has no result. Every row of the
documents is a document; rows that share a doc_id, or have none, are ranked each for
itself (null first among equal scores). Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickwork.llm.common import staged

K = 50
SHARD_POSTINGS = 1 << 20
BLOCK_TERMS = 1 << 18
#: Entries of each list read between two looks at the bound.
STEP = 32
_PIECE = 1 << 20
_KEPT = [b for b in range(256) if 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b > 0x7F]
_TO_TERMS = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _KEPT else 0x20 for b in range(256))
_POSTED = "doc_id long, n long, terms array<int>, counts array<long>"


def count_terms(text: bytes) -> Counter:
    """How often each term is in a UTF-8 text."""
    counts: Counter = Counter()
    at = 0
    while at < len(text):
        piece = text[at: at + _PIECE].translate(_TO_TERMS)
        if at + _PIECE < len(text):
            cut = piece.rfind(b" ") + 1
            while not cut:  # one term fills the piece
                piece = text[at: at + 2 * len(piece)].translate(_TO_TERMS)
                cut = len(piece) if at + len(piece) >= len(text) else piece.rfind(b" ") + 1
            piece = piece[:cut]
        counts.update(piece.split())
        at += len(piece)
    return counts


def _raw(text: pa.Scalar) -> bytes:
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            terms = list(count_terms(_raw(batch.column(1)[row])))
            for lo in range(0, len(terms), 1 << 16):
                part = pa.array(terms[lo: lo + (1 << 16)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[row].as_py()] * len(part), pa.int64()), part], ["item_id", "term"])


def _posted(known):
    """(doc_id, n, terms, counts) of each text; terms by their numbers in `known`."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: i for i, term in enumerate(known.value)}
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                batch = whole.slice(lo, 512)
                sizes, ends, terms, counts = [], [0], [], []
                for text in batch.column(1):
                    found = count_terms(_raw(text))
                    sizes.append(found.total())
                    own = sorted((number[t], c) for t, c in found.items() if t in number)
                    terms += [t for t, _ in own]
                    counts += [c for _, c in own]
                    ends.append(len(terms))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))],
                    ["doc_id", "n", "terms", "counts"],
                )

    return of


class Shard:
    """Impact lists of some documents, read in order or looked up by document."""

    def __init__(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int):
        self.docs = len(n)
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * (50 + (50 * n[doc] * n_docs) // n_terms)))
        keep = impact > 0
        doc, term, impact = doc[keep], term[keep], impact[keep]
        by_impact = np.lexsort((doc, -impact, term))
        #: The lists one after another: documents and impacts, and where each list begins.
        self.doc, self.impact = doc[by_impact], impact[by_impact]
        self.begins = np.searchsorted(term[by_impact], np.arange(len(weights) + 1))
        #: The same postings by term and document, with their places in the lists.
        by_doc = np.lexsort((doc, term))
        self.keys = term[by_doc].astype(np.int64) * self.docs + doc[by_doc]
        place = np.empty(len(by_impact), np.int64)
        place[by_impact] = np.arange(len(by_impact))
        self.place = place[by_doc]

    def look_up(self, term: int, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of `docs` (ascending) are in the list of a term, and where."""
        lo, hi = self.begins[term], self.begins[term + 1]
        own = self.keys[lo:hi]
        at = np.searchsorted(own, term * self.docs + docs)
        there = np.zeros(len(docs), bool)
        inside = at < len(own)
        there[inside] = own[at[inside]] == term * self.docs + docs[inside]
        return there, self.place[lo + at[there]] - lo

    def top(self, terms: np.ndarray, k: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents that can be among the best k with their scores, and how many were looked up."""
        terms = [int(t) for t in terms if self.begins[t] < self.begins[t + 1]]
        begins = [int(self.begins[t]) for t in terms]
        sizes = [int(self.begins[t + 1]) - b for t, b in zip(terms, begins)]
        seen = [np.zeros(size, bool) for size in sizes]
        best = [0] * len(terms)  # seen positions without a gap, from the start of each list
        known = np.zeros(self.docs, bool)
        docs, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        depth, kth, count = 0, 0, 0
        while depth < max(sizes, default=0):
            fresh = np.unique(np.concatenate(
                [self.doc[b + depth: b + min(depth + step, size)] for b, size in zip(begins, sizes) if depth < size]
            ))
            fresh = fresh[~known[fresh]]
            known[fresh] = True
            score = np.zeros(len(fresh), np.int64)
            for i, term in enumerate(terms):
                there, where = self.look_up(term, fresh)
                score[there] += self.impact[begins[i] + where]
                seen[i][where] = True
            docs.append(fresh)
            scores.append(score)
            count += len(fresh)
            depth += step
            bound = 0
            for i, (b, size) in enumerate(zip(begins, sizes)):
                if best[i] < size:
                    ahead = seen[i][best[i]:]
                    gap = int(ahead.argmin())
                    best[i] = size if ahead[gap] else best[i] + gap
                    if best[i] < size:
                        bound += int(self.impact[b + best[i] - 1]) if best[i] else int(self.impact[b])
            if count >= k:
                merged = np.concatenate(scores)
                kth = int(np.partition(merged, len(merged) - k)[len(merged) - k])
                if bound < kth:
                    break
                if len(docs) > 64:
                    docs, scores = [np.concatenate(docs)], [merged]
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        keep = scores >= max(kth, 1)
        return docs[keep], scores[keep], count


def _searched(items, weights, n_docs: int, n_terms: int, k: int):
    """The best k of a shard for each item: (item, doc_id, score)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, lengths, terms, counts, held = [], [], [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal ids, sizes, lengths, terms, counts, held
            if not ids:
                return
            id_ = pa.concat_arrays(ids)
            # By doc_id, null first, so that the first of equal scores are those that stay.
            order = np.lexsort((np.asarray(id_.fill_null(0)), ~np.asarray(id_.is_null())))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            n = np.concatenate(sizes)[order]
            doc = rank[np.repeat(np.arange(len(order)), np.concatenate(lengths))]
            shard = Shard(n, doc, np.concatenate(terms), np.concatenate(counts), weights.value, n_docs, n_terms)
            id_ = id_.take(pa.array(order))
            ids, sizes, lengths, terms, counts, held = [], [], [], [], [], 0
            found: list[tuple] = []
            for item, own in enumerate(items.value):
                docs, scores, _ = shard.top(own, k)
                best = np.lexsort((docs, -scores))[:k]
                found.append((np.full(len(best), item, np.int32), docs[best], scores[best]))
                if sum(len(x[0]) for x in found) > 100_000:
                    yield _found(found, id_)
                    found = []
            if found:
                yield _found(found, id_)

        for batch in batches:
            lists = batch.column(2)
            ids.append(batch.column(0))
            sizes.append(np.asarray(batch.column(1)))
            lengths.append(np.asarray(lists.value_lengths()))
            terms.append(np.asarray(lists.flatten()))
            counts.append(np.asarray(batch.column(3).flatten()))
            held += len(terms[-1])
            if held >= 2 * SHARD_POSTINGS:  # a task that was dealt more makes several shards
                yield from flush()
                held = 0
        yield from flush()

    return of


def _found(found: list[tuple], id_: pa.Array) -> pa.RecordBatch:
    item, doc, score = (np.concatenate(x) for x in zip(*found))
    return pa.RecordBatch.from_arrays([pa.array(item), id_.take(pa.array(doc)), pa.array(score)], ["item", "doc_id", "score"])


def _block(docs: DataFrame, items: list[tuple], k: int) -> DataFrame:
    """Results of some items: (item_id, rank, doc_id, score)."""
    spark = docs.sparkSession
    terms = sorted({t for _, own in items for t in own})
    posted = staged(docs.mapInArrow(_posted(spark.sparkContext.broadcast(terms)), _POSTED), "postings")
    n_docs, n_terms, n_postings = posted.agg(F.count_if(F.col("n") > 0), F.sum("n"), F.sum(F.size("terms"))).first()
    df = np.zeros(len(terms), np.int64)
    for row in posted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # the block's terms at most
        df[row["term"]] = row["count"]
    weights = np.array([math.floor(1000 * math.log((2 * (n_docs or 0) + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    number = {t: i for i, t in enumerate(terms)}
    share = spark.sparkContext.broadcast
    work = _searched(share([np.array([number[t] for t in own]) for _, own in items]), share(weights), n_docs or 0, max(n_terms or 0, 1), k)
    shards = max(1, -(-(n_postings or 0) // SHARD_POSTINGS))
    # Dealt by the row's place in the hash space of its contents; equal documents may lie anywhere.
    dealt = posted.where(F.size("terms") > 0).repartition(shards, F.xxhash64("doc_id", "n", "terms"))
    found = dealt.mapInArrow(work, "item int, doc_id long, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    merged = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "item int, item_id long")
    return merged.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents (doc_id, text) with the highest scores above 0
    for each of `items` (item_id, text)."""
    own = docs.select(F.col("doc_id").cast("long"), F.encode("text", "utf-8").alias("text"))
    texts = items.select(F.col("item_id").cast("long"), F.encode("text", "utf-8").alias("text"))
    asked = staged(texts.mapInArrow(_item_terms, "item_id long, term binary").distinct(), "asked")
    blocks = max(1, -(-asked.count() // block_terms))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    parts = []
    for i in range(blocks):
        rows = asked.where(block == i).groupBy("item_id").agg(F.collect_list("term").alias("terms"))
        chosen = sorted(((r["item_id"], [bytes(t) for t in r["terms"]]) for r in rows.toLocalIterator()), key=lambda x: (x[0] is not None, x[0]))
        parts.append(_block(own, chosen, k))
    return reduce(DataFrame.unionByName, parts)
