"""Benchmark decontamination with a distributed positional inverted index.

Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of texts with A-Z in lower case. A benchmark
item gives a phrase of `width` words for each place in it, or one phrase of all its words
if it has fewer; an item without words gives none.

The index is partitioned by document: a block of about a megabyte of whole texts has, for
each term of the phrases, the sorted list of places where the block holds it. It is
stored in the shared folder. A query reads the lists of a block, starts each phrase from
the list of its rarest term (over the whole corpus), and intersects it with the lists
of its next rarer terms, moved by the distance of the terms, until places are left where
all terms agree: these are exact phrase matches, as the lists hold whole places. With a
`span`, phrases also match in any order within so many words (proximity).

The terms and phrases of a benchmark go to all tasks in parts of at most `PART_PHRASES`
phrases; a larger benchmark takes several parts, each over the same texts. What is found is
rows of hit word ranges and (document, item) pairs.

Null and empty texts have no words and are not contaminated. Rows with the same doc_id
share one verdict, found over all their texts; n_words and n_hit are then of the row with
most hits. Repeated items change nothing; items without an id are one item, null in `items`.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickwork.llm import tokens
from wickwork.llm.common import staged

WIDTH = 10
PART_PHRASES = 200_000
#: Pairs of a phrase and a place of its rarest term that are looked at together.
AT_ONCE = 1 << 18
_TABLE = tokens.byte_table(tokens.ALPHANUMERIC, lower=True)
_PHRASE = "item_id long, terms array<long>"
_INDEX = "block long, docs binary, lengths binary, term long, places binary"
_FOUND = "doc_id long, n_words long, spans array<struct<start:long,end:long>>, items array<long>"
_NO_ID = -(1 << 63)  # stands for a null doc_id or item_id inside the index


def phrases(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item_id, terms): the distinct phrases of every item."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, terms = [], []
            for lo, hi, data, offsets in tokens.text_slices(batch.column(1)):
                _, _, hashes, first = tokens.words(data, offsets, _TABLE)
                hashes = hashes.view(np.int64)
                for row in range(hi - lo):
                    own = hashes[first[row]: first[row + 1]]
                    for at in range(max(1, len(own) - width + 1) if len(own) else 0):
                        ids.append(batch.column(0)[lo + row].as_py())
                        terms.append(own[at: at + width])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(terms, pa.list_(pa.int64()))], ["item_id", "terms"]
            )

    return items.select("item_id", "text").mapInArrow(of, _PHRASE).distinct()


def build_index(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """Rows of the index for sorted `terms`: (block, documents, term, places).

    `docs` and `lengths` (ids and numbers of words of the block's documents) stand on the
    block's first row only, which has no term. Places count words from the block's begin.
    """
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = known.value
        block = 0
        for batch in batches:
            ids = np.asarray(batch.column(0).fill_null(_NO_ID)).astype(np.int64)
            for lo, hi, data, offsets in tokens.text_slices(batch.column(1)):
                _, _, hashes, first = tokens.words(data, offsets, _TABLE)
                at = np.searchsorted(terms, hashes.view(np.int64)) if len(terms) else np.zeros(len(hashes), np.int64)
                at[at == len(terms)] = 0
                places = np.flatnonzero(terms[at] == hashes.view(np.int64)) if len(terms) else np.empty(0, np.int64)
                which = at[places]
                order = np.argsort(which, kind="stable")
                places, which = places[order].astype(np.int32), which[order]
                cut = np.flatnonzero(np.diff(which)) + 1
                lists = np.split(places, cut) if len(places) else []
                heads = which[np.r_[0, cut]] if len(places) else []
                n = len(lists)
                rows = [
                    pa.array([block] * (n + 1), pa.int64()),
                    pa.array([ids[lo:hi].tobytes()] + [None] * n, pa.binary()),
                    pa.array([np.diff(first).astype(np.int64).tobytes()] + [None] * n, pa.binary()),
                    pa.array(np.r_[0, terms[heads]] if n else [0], pa.int64()),
                    pa.array([None] + [x.tobytes() for x in lists], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(rows, [f.split()[0] for f in _INDEX.split(", ")])
                block += 1

    named = docs.select("doc_id", "text").mapInArrow(of, _INDEX)
    # Blocks count from 0 in each task; with the task they are told apart for good once written.
    return staged(named.withColumn("block", F.spark_partition_id().cast("long") * (1 << 32) + F.col("block")), "index")


class Phrases:
    """Phrases as arrays: term numbers and offsets from the rarest term on."""

    def __init__(self, terms: np.ndarray, item_ids: np.ndarray, lists: list[np.ndarray], counts: np.ndarray):
        width = max(map(len, lists), default=0)
        self.terms, self.items = terms, item_ids
        self.lengths = np.array([len(x) for x in lists], np.int64)
        padded = np.full((len(lists), width), -1, np.int64)
        for row, x in enumerate(lists):
            padded[row, : len(x)] = np.searchsorted(terms, x)
        rarity = np.where(padded >= 0, counts[padded] if len(counts) else 0, np.iinfo(np.int64).max)
        self.offsets = np.argsort(rarity, axis=1, kind="stable")
        self.order = np.take_along_axis(padded, self.offsets, 1)
        self.rarest = self.order[:, 0] if width else np.empty(0, np.int64)
        self.by_rarest = np.argsort(self.rarest, kind="stable")
        self.bounds = np.searchsorted(self.rarest[self.by_rarest], np.arange(len(terms) + 1))

    def matches(self, lists: dict[int, np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, start) of all exact matches among `n` words with these posting lists."""
        at = np.full(n, -1, np.int64)  # the lists together: the known term of each place
        for term, places in lists.items():
            at[places] = term
        found, starts = [], []
        for term, places in lists.items():
            own = self.by_rarest[self.bounds[term]: self.bounds[term + 1]]
            for begin in range(0, len(places), AT_ONCE):
                some = places[begin: begin + AT_ONCE].astype(np.int64)
                step = max(1, AT_ONCE // len(some))
                for lo in range(0, len(own), step):
                    phrase, start = self._agreed(own[lo: lo + step], some, at)
                    if len(phrase):
                        found.append(phrase)
                        starts.append(start)
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(found), np.concatenate(starts)

    def _agreed(self, own: np.ndarray, places: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, start) of the phrases `own` around these places of their rarest term, where all terms agree."""
        phrase = np.repeat(own, len(places))
        start = np.tile(places, len(own)) - self.offsets[phrase, 0]
        ok = (start >= 0) & (start + self.lengths[phrase] <= len(at))
        phrase, start = phrase[ok], start[ok]
        for step in range(1, self.order.shape[1]):
            if not len(phrase):
                break
            want = self.order[phrase, step]
            place = np.minimum(start + self.offsets[phrase, step], len(at) - 1)
            ok = (want < 0) | (at[place] == want)
            phrase, start = phrase[ok], start[ok]
        return phrase, start

    def near(self, lists: dict[int, np.ndarray], n: int, span: int) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, start) where all terms of a phrase stand within `span` words, in any order."""
        found, starts = [], []
        for phrase in range(len(self.lengths)):
            wanted = sorted({int(t) for t in self.order[phrase] if t >= 0}, key=lambda t: len(lists.get(t, ())))
            if not wanted or any(t not in lists for t in wanted):
                continue
            # A window of the span that holds all terms can be slid to begin with one of them.
            begins = np.unique(np.concatenate([lists[t] for t in wanted]).astype(np.int64))
            for t in wanted:
                nxt = np.searchsorted(lists[t], begins)
                ok = nxt < len(lists[t])
                ok[ok] = lists[t][nxt[ok]] < begins[ok] + span
                begins = begins[ok]
                if not len(begins):
                    break
            found.append(np.full(len(begins), phrase))
            starts.append(begins)
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(found), np.concatenate(starts)


def _search(index: DataFrame, wanted: Phrases, span: int | None) -> DataFrame:
    """(doc_id, n_words, spans, items) of all documents of the index, hit or not."""
    shared = index.sparkSession.sparkContext.broadcast(wanted)

    def of(rows):
        p: Phrases = shared.value
        head = rows.filter(pc.is_valid(rows["docs"]))
        ids = np.frombuffer(head["docs"][0].as_py(), np.int64)
        lengths = np.frombuffer(head["lengths"][0].as_py(), np.int64)
        ends = np.cumsum(lengths)
        listed = rows.filter(pc.is_valid(rows["places"]))
        numbers = np.searchsorted(p.terms, np.asarray(listed["term"]))
        lists = {int(t): np.frombuffer(x.as_py(), np.int32) for t, x in zip(numbers, listed["places"])}
        total = int(ends[-1]) if len(ends) else 0
        phrase, start = p.matches(lists, total)
        length = p.lengths[phrase]
        doc = np.searchsorted(ends, start, "right")
        ok = start + length <= ends[doc] if len(doc) else np.empty(0, bool)  # never across documents
        if span is not None:
            near, begin = p.near(lists, total, span)
            phrase, start, length = np.r_[phrase[ok], near], np.r_[start[ok], begin], np.r_[length[ok], np.full(len(near), span)]
            doc = np.searchsorted(ends, start, "right")
            length = np.minimum(length, ends[doc] - start) if len(doc) else length
            ok = np.ones(len(doc), bool)
        phrase, start, length, doc = phrase[ok], start[ok], length[ok], doc[ok]
        change = np.zeros(total + 1, np.int64)
        np.add.at(change, start, 1)
        np.add.at(change, start + length, -1)
        inside = np.cumsum(change)[:total] > 0
        begins = ends - lengths
        first = np.zeros(total + 1, bool)
        first[begins] = True  # a range never goes on in the next document
        edge = np.r_[False, inside[:-1]] & ~first[:total]
        lo = np.flatnonzero(inside & ~edge)
        later = np.r_[inside[1:], False] & ~first[1:]
        hi = np.flatnonzero(inside & ~later) + 1
        of_doc = np.searchsorted(ends, lo, "right")
        cuts = np.searchsorted(of_doc, np.arange(len(ids) + 1))
        ranges = pa.StructArray.from_arrays(
            [pa.array(lo - begins[of_doc], pa.int64()), pa.array(hi - begins[of_doc], pa.int64())], ["start", "end"]
        )
        spans = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), ranges)
        pairs = np.unique(np.stack([doc, p.items[phrase]]), axis=1) if len(doc) else np.empty((2, 0), np.int64)
        cuts = np.searchsorted(pairs[0], np.arange(len(ids) + 1))
        items = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(pairs[1], pa.int64()))
        return pa.table({"doc_id": ids, "n_words": lengths, "spans": spans, "items": items})

    return index.groupBy("block").applyInArrow(of, _FOUND)


def decontaminate(docs: DataFrame, items: DataFrame, width: int = WIDTH, span: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items): the word ranges of each document inside phrases, and the items found."""
    spark = docs.sparkSession
    wanted = staged(phrases(items, width), "phrases")
    parts = max(1, -(-wanted.count() // PART_PHRASES))
    found = None
    for part in range(parts):
        # A part has at most about PART_PHRASES phrases, whatever the size of the benchmark.
        own = wanted.where(F.pmod(F.xxhash64("terms"), F.lit(parts)) == part).toArrow()
        lists = [np.asarray(x, np.int64) for x in own["terms"].to_pylist()]
        terms = np.unique(np.concatenate(lists)) if lists else np.empty(0, np.int64)
        index = build_index(docs, terms)
        counts = np.zeros(len(terms), np.int64)
        lengths = index.where("places IS NOT NULL").groupBy("term").agg(F.sum(F.octet_length("places")).alias("n")).toArrow()
        counts[np.searchsorted(terms, np.asarray(lengths["term"]))] = np.asarray(lengths["n"]) // 4
        ids = np.asarray(own["item_id"].fill_null(_NO_ID)).astype(np.int64)
        one = _search(index, Phrases(terms, ids, lists, counts), span)
        found = one if found is None else found.unionByName(one)
    # Ranges found by several parts, or on rows of one id, may overlap: they are merged in order.
    joined = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("spans"))),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(a["end"], x["start"]))).alias("n"),
            F.greatest(a["end"], x["end"]).alias("end"),
        ),
    )["n"]
    return found.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"), joined.alias("n_hit"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.transform(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))), lambda x: F.nullif(x, F.lit(_NO_ID))
        ).alias("items"),
    ).withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID)))


def contaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """Rows of `docs` whose document holds a phrase of the benchmark."""
    hit = decontaminate(docs, items, width).where("n_hit > 0").select(F.col("doc_id").alias("_hit"))
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_hit"]), "left_semi")


def clean(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """Rows of `docs` without any phrase of the benchmark."""
    hit = decontaminate(docs, items, width).where("n_hit > 0").select(F.col("doc_id").alias("_hit"))
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_hit"]), "left_anti")
