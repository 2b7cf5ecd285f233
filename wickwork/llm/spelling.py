"""Grouping of spelling variants by a trie over letter-group counts.

Two words are near if one insertion, deletion or replacement of a code point turns one into
the other. Then their letter-group counts differ by at most one surplus (a group that has one more)
and one deficit (one less). So words are arranged in a trie whose levels are the counts
of the groups in `GROUPS`, one after another; a leaf holds the words of one count vector.

1. Words are counted over whole texts, a bounded piece at a time, and merged in the tasks
   before they are shuffled.
2. The upper levels of the trie are dealt out: a task gets one subtree, the words whose first
   counts agree. As many levels are used as are needed for every subtree to have at most
   `SUBTREE_WORDS` words. A word visits the subtrees that its budget of one surplus and one deficit
   can reach. Of two subtrees only one sends its words to the other, so each pair meets once.
3. In a subtree a depth-first search goes down level by level. A node is entered with the
   words that can still reach it and what is left of their budgets: a child with the same count
   costs nothing, one more costs the surplus, one less the deficit.
4. At a leaf, words are verified. One edit leaves the first or the second half of the shorter
   word as it is, so a leaf's words are looked up by their halves, and what is found is compared
   code point by code point.
5. A word's form is its near word of the largest count, the smallest in code-point order among
   equals, if that is `FACTOR` times its own count; its root is the last of its forms. Counts grow
   by `FACTOR` with each form, so a chain has at most 19 of them and five doublings find its end.

Words are runs of ASCII letters and U+00C0 to U+00FF, only A-Z in lower case, at least
`MIN_LENGTH` long and seen `MIN_COUNT` times. A null text has none. A null doc_id counts as an empty
string in the rule that alters runs. Repeated rows count each. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickwork.llm import tokens
from wickwork.llm.common import staged

MIN_LENGTH, MIN_COUNT, FACTOR = 7, 2, 10
#: Letters whose counts are the levels of the trie, from the top; all others are the last level.
GROUPS = ["e", "n", "t", "i", "r", "a", "o", "h", "s", "ld", "cu", "mgp"]
SUBTREE_WORDS = 1 << 14
_ALTERED = 31
_PIECE = 1 << 20
_HELD = 200_000
_PAIRS = 1 << 18
_WIDE = 64
#: Latin-1 byte to lower-case letter, or a blank. Code points beyond Latin-1 become '?' before.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)
_GROUP = np.full(256, len(GROUPS), np.int64)
for _i, _letters in enumerate(GROUPS):
    _GROUP[list(_letters.encode())] = _i
_VALUES = tokens.byte_table(range(256), lower=False)
_NEAR = "word string, n_near long, near_n long, near string"


def _utf8(word: bytes) -> bytes:
    return word if word.isascii() else word.decode("latin-1").encode()


def runs(text: str) -> Counter:
    """How often each run of at least `MIN_LENGTH` letters is in a text, in lower case, as Latin-1."""
    counts: Counter = Counter()
    at = 0
    while at < len(text):
        size = _PIECE
        while True:
            piece = text[at: at + size].encode("latin-1", "replace").translate(_LETTERS)
            cut = len(piece) if at + size >= len(text) else piece.rfind(b" ") + 1
            if cut:
                break
            size *= 2  # one run fills the piece
        counts.update([w for w in piece[:cut].split() if len(w) >= MIN_LENGTH])
        at += cut
    return counts


def altered(doc_id: str, found: Counter) -> Iterator[tuple[bytes, int]]:
    """The words that a document's runs count for: a run is short of one letter if its hash says so."""
    start = crc32(f"{doc_id}:".encode())
    for run, n in found.items():
        h = crc32(_utf8(run), start)
        if h % _ALTERED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < MIN_LENGTH:
                continue
        yield run, n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"]
        )
        held.clear()
        return batch

    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            if text.is_valid:
                found = runs(str(text.as_buffer().to_pybytes(), "utf-8", "replace"))
                for word, n in altered(doc_id.as_py() or "", found):
                    held[word] += n
                if len(held) >= _HELD:
                    yield flush()
    if held:
        yield flush()


def words(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of `docs` (doc_id, text) that are seen at least `min_count` times."""
    texts = docs.select(F.col("doc_id").cast("string"), F.encode("text", "utf-8").alias("text"))
    counted = texts.mapInArrow(_counted, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _counts(depth: int) -> list[Column]:
    """The first `depth` levels of a word in the trie."""
    return [F.length("word") - F.length(F.translate("word", letters, "")) for letters in GROUPS[:depth]]


def _depth(known: DataFrame) -> int:
    """Levels to deal out for every subtree to be small enough (all, if none are enough)."""
    levels = [c.alias(f"c{i}") for i, c in enumerate(_counts(len(GROUPS)))]
    names = [f"c{i}" for i in range(len(GROUPS))]
    sizes = known.select(*levels).groupBy(*names).count().rollup(*names).agg(
        F.sum("count").alias("size"), F.grouping_id().alias("left")
    ).groupBy("left").agg(F.max("size").alias("size"))
    largest = {len(GROUPS) - row["left"].bit_length(): row["size"] for row in sizes.collect()}  # one row a level
    return next((d for d in range(len(GROUPS)) if (largest.get(d) or 0) <= SUBTREE_WORDS), len(GROUPS))


def _visits(known: DataFrame, depth: int) -> DataFrame:
    """(key, home, word, n): a word in its own subtree and in those it can reach.

    Of two subtrees that reach one another, the one with less in the first group that differs sends.
    """
    counts = [F.col("c")[i] for i in range(depth)]

    def key(more: int | None = None, less: int | None = None) -> Column:
        moved = [c + (int(i == more) - int(i == less)) for i, c in enumerate(counts)]
        return F.when(F.lit(True) if less is None else counts[less] > 0, F.concat_ws(",", *[m.cast("string") for m in moved]))

    stops = [F.struct(key().alias("key"), F.lit(True).alias("home"))]
    stops += [F.struct(key(i).alias("key"), F.lit(False).alias("home")) for i in range(depth)]
    stops += [F.struct(key(i, j).alias("key"), F.lit(False).alias("home")) for i, j in combinations(range(depth), 2)]
    # The counts are made first, once a word.
    counted = known.select("word", "n", F.array(*_counts(depth)).cast("array<int>").alias("c"))
    return counted.select("word", "n", F.explode(F.array(*stops)).alias("stop")).select("stop.key", "stop.home", "word", "n").where("key IS NOT NULL")


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether one insertion, deletion or replacement turns one word into the other."""
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and len(b) - len(a) <= 1 and a[at + (len(a) == len(b)):] == b[at + 1:]


class Subtree:
    """One subtree of the trie and the words that visit it."""

    def __init__(self, latin: list[bytes], home: np.ndarray):
        self.words, self.home = latin, home
        self.sizes = np.array([len(w) for w in latin], np.int64)
        self.ends = np.cumsum(self.sizes)
        data = np.frombuffer(b"".join(latin), np.uint8)
        row = np.repeat(np.arange(len(latin)), self.sizes)
        levels = len(GROUPS) + 1
        self.counts = np.bincount(row * levels + _GROUP[data], minlength=len(latin) * levels).reshape(-1, levels)
        self.spans = tokens.Spans(_VALUES[data])
        wide = min(int(self.sizes.max()), _WIDE)
        column = np.arange(wide)
        starts = self.ends - self.sizes
        inside = column < self.sizes[:, None]
        padded = np.r_[data, np.zeros(wide, np.uint8)]
        self.left = np.where(inside, padded[starts[:, None] + column], 0)
        self.right = np.where(inside, padded[np.maximum(self.ends[:, None] - 1 - column, 0)], 0)
        # The trie: home words in the order of their counts; a node is a range of them.
        rows = np.flatnonzero(home)
        self.trie = rows[np.lexsort(self.counts[rows].T[::-1])]
        vectors = self.counts[self.trie]
        self.leaf = np.r_[0, np.cumsum((vectors[1:] != vectors[:-1]).any(axis=1))] if len(rows) else np.empty(0, np.int64)
        self.pending: list[tuple[np.ndarray, int]] = []
        self.held = 0
        self.found: list[np.ndarray] = []

    def pairs(self) -> np.ndarray:
        """(2, number) rows of near words, the visitor or the earlier home word first."""
        if len(self.trie):
            both = np.ones(len(self.words), bool)
            self.halves = [self._by_halves(self.trie, self.sizes[self.trie] - less, self.leaf, suffix) for less in (0, 1) for suffix in (False, True)]
            self.halves = [(keys[order], self.trie[order]) for keys in self.halves for order in [np.argsort(keys, kind="stable")]]
            self._descend(0, 0, len(self.trie), np.arange(len(self.words)), both, both)
            self._verify()
        return np.concatenate(self.found, axis=1) if self.found else np.empty((2, 0), np.int64)

    def _descend(self, level: int, lo: int, hi: int, rows: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> None:
        """Search below a node with the words `rows` and what is left of their budgets."""
        if self.leaf[lo] == self.leaf[hi - 1]:  # one vector is left: the other levels at once
            more = self.counts[self.trie[lo], level:] - self.counts[rows, level:]
            above, below = np.maximum(more, 0).sum(axis=1), np.maximum(-more, 0).sum(axis=1)
            rows = rows[(above <= surplus) & (below <= deficit)]
            if len(rows):
                self.pending.append((rows, lo))
                self.held += len(rows)
                if self.held >= _PAIRS:
                    self._verify()
            return
        column, own = self.counts[self.trie[lo:hi], level], self.counts[rows, level]
        cuts = np.flatnonzero(column[1:] != column[:-1]) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), hi - lo]):
            more = column[a] - own
            go = (more == 0) | ((more == 1) & surplus) | ((more == -1) & deficit)
            if go.any():
                more = more[go]
                self._descend(level + 1, lo + a, lo + b, rows[go], surplus[go] & (more != 1), deficit[go] & (more != -1))

    def _by_halves(self, rows: np.ndarray, shorter: np.ndarray, leaf: np.ndarray, suffix: bool) -> np.ndarray:
        """Hash of a leaf and half a word, for a pair whose shorter word has the given length."""
        half = shorter // 2
        starts, ends = self.ends[rows] - self.sizes[rows], self.ends[rows]
        part = self.spans.of(ends - (shorter - half), ends) if suffix else self.spans.of(starts, starts + half)
        return tokens.mix(part + tokens.mix(leaf.astype(np.uint64)))

    def _verify(self) -> None:
        """Compare the words that have reached leaves with the words of these leaves."""
        if not self.pending:
            return
        rows = np.concatenate([r for r, _ in self.pending])
        first = np.repeat([lo for _, lo in self.pending], [len(r) for r, _ in self.pending])
        self.pending, self.held = [], 0
        leaf, size = self.leaf[first], self.sizes[self.trie[first]]
        for less in (0, 1):
            own = self.sizes[rows] < size if less else self.sizes[rows] >= size
            asked, where = rows[own], leaf[own]
            shorter = np.minimum(self.sizes[asked], size[own])
            for suffix in (False, True):
                keys, tree = self.halves[2 * less + suffix]
                wanted = self._by_halves(asked, shorter, where, suffix)
                lo, hi = np.searchsorted(keys, wanted), np.searchsorted(keys, wanted, "right")
                some = np.flatnonzero(hi > lo)
                n = (hi - lo)[some]
                for a in range(0, len(some), _PAIRS):  # a bounded number of words, then of pairs
                    part, own_n = some[a: a + _PAIRS], n[a: a + _PAIRS]
                    while len(part):
                        fit = max(1, int(np.searchsorted(np.cumsum(own_n), _PAIRS, "right")))
                        now, now_n = part[:fit], own_n[:fit]
                        at = np.repeat(lo[now] - (np.cumsum(now_n) - now_n), now_n) + np.arange(now_n.sum())
                        self._compare(np.repeat(asked[now], now_n), tree[at], suffix)
                        part, own_n = part[fit:], own_n[fit:]

    def _compare(self, a: np.ndarray, b: np.ndarray, suffix: bool) -> None:
        once = ~self.home[a] | (a < b)  # two home words meet twice
        a, b = a[once], b[once]
        m, n = np.minimum(self.sizes[a], self.sizes[b]), np.maximum(self.sizes[a], self.sizes[b])
        wide = self.left.shape[1]

        def common(padded: np.ndarray) -> np.ndarray:
            differ = padded[a] != padded[b]
            return np.where(differ.any(axis=1), differ.argmax(axis=1), wide)

        before, after = common(self.left), common(self.right)
        near = np.where(m == n, (before < m) & (before + after == m - 1), (n - m == 1) & (before + after >= m))
        for i in np.flatnonzero(n > wide):
            near[i] = one_edit(self.words[a[i]], self.words[b[i]])
            before[i] = next((k for k, (x, y) in enumerate(zip(self.words[a[i]], self.words[b[i]])) if x != y), m[i])
        if suffix:  # found by the first half already
            near &= before < m // 2
        self.found.append(np.stack([a[near], b[near]]))


def _in_subtree(rows: pa.Table) -> pa.Table:
    """For each word of the subtree and each visitor: its near words here, and the most frequent."""
    rows = rows.combine_chunks()
    column = rows["word"].chunk(0) if rows.num_rows else pa.array([], pa.string())
    latin = [w.encode("latin-1") for w in column.to_pylist()]
    n = np.asarray(rows["n"])
    a, b = Subtree(latin, np.asarray(rows["home"])).pairs()
    word, near = np.r_[a, b], np.r_[b, a]
    rank = np.empty(len(latin), np.int64)
    rank[np.asarray(pc.sort_indices(column))] = np.arange(len(latin))
    order = np.lexsort((rank[near], -n[near], word))
    word, near = word[order], near[order]
    at = np.flatnonzero(np.r_[True, word[1:] != word[:-1]][: len(word)])
    best = near[at]
    return pa.table({
        "word": column.take(pa.array(word[at])), "n_near": pa.array(np.diff(np.r_[at, len(word)])),
        "near_n": pa.array(n[best]), "near": column.take(pa.array(best)),
    })


def near_words(known: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near): how many near words each of `known` (word, n) has, and the most frequent."""
    parts = _visits(known, _depth(known)).groupBy("key").applyInArrow(_in_subtree, _NEAR)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.less")).alias("near_n"), "best.near"
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form), where forms lead to further ones without a circle."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(5):
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = staged(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            break
    return now


def group_variants(docs: DataFrame, min_count: int = MIN_COUNT, factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of `docs` (doc_id, text)."""
    known = staged(words(docs, min_count), "words")
    close = known.join(near_words(known), "word", "left")
    chosen = F.col("near_n") >= factor * F.col("n")
    told = staged(close.select(
        "word", F.when(chosen, F.col("near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(chosen, F.col("near_n")).alias("form_n"),
    ), "forms")
    roots = _roots(told.where("form IS NOT NULL"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
