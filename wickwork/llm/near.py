"""MinHash near-dedup with odd sketches.

A text's set holds its distinct `width`-word shingles (words parted by blanks, A-Z in
lower case); fewer words give the whole sequence as one shingle, no words an empty set
that is linked with nothing. Sets with a similarity (intersection over union) of
`percent` / 100 or more are linked; links make components, each named by its smallest id.

1. One pass over the texts gives set size, fingerprint, MinHash values, band keys from
   `BANDS` times `ROWS` values (a pair at 0.8 is missed with a chance of 2.6e-5), and the odd
   sketch: each sample (number, value) flips one of 512 bits, so the XOR of two
   sketches shows the samples in which two sets differ, and its population count bounds
   how far apart they are.
2. Equal sets fold into one class. Only class representatives go on.
3. Star round: in each band bucket all members are compared with its smallest id, never
   with one another. Pairs that size or sketch rule out are dropped; all others are
   checked on their full sets. Links make components.
4. Rest round: where the members of a bucket are still in several components, members of
   different components are compared in one task: by size, by odd sketches over their whole
   sets, which have more bits the larger the sets and whose XOR count never exceeds the number
   of differing shingles, then on the full sets, nearest first, until no two components can be
   linked. Only links leave the task. A large
   group of copies is mostly one component by now, which costs nothing here.
5. Components of all links.

Null ids are kept and linked with nothing. Rows that share an id are linked by it.
Only id and text are read; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickwork.llm import tokens
from wickwork.llm.common import components, staged

WIDTH, PERCENT = 5, 80
BANDS, ROWS = 20, 4
SKETCH_LONGS = 8
#: XOR count above which a pair is not at `percent`: at 0.8 the count is 30 on average, with a deviation of 7.
MAX_XOR = 66
#: Fewest bits of an odd sketch over a whole set.
LEAST_BITS = 512
#: Members, and bytes of their sets, of a chunk of a bucket; two chunks meet in one task.
CHUNK, CHUNK_BYTES = 2048, 16 << 20
_TABLE = tokens.byte_table(tokens.BLANK_PARTED, lower=True)
_RANDOM = np.random.default_rng(4)
_A = _RANDOM.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_B = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_SKETCH = [f"s{i}" for i in range(SKETCH_LONGS)]
_SIGNED = f"id long, n long, f long, g long, bands array<long>, {', '.join(f'{s} long' for s in _SKETCH)}"


def _shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    n = max(1, len(hashes) - width + 1) if len(hashes) else 0
    acc = np.zeros(n, np.uint64)
    for step in range(min(width, len(hashes))):
        acc = tokens.mix(acc * np.uint64(0x9E3779B97F4A7C15) + hashes[step: step + n])
    return np.unique(acc)


def _minima(shingles: np.ndarray) -> np.ndarray:
    least = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        block = shingles[None, at: at + 2048] * _A[:, None]
        block += _B[:, None]
        np.minimum(least, block.min(axis=1), out=least)
    return least


def _each(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    for lo, hi, data, offsets in tokens.text_slices(column):
        _, _, hashes, first = tokens.words(data, offsets, _TABLE)
        for row in range(hi - lo):
            yield _shingles(hashes[first[row]: first[row + 1]], width)


def signatures(docs: DataFrame, id_: str, text: str, width: int) -> DataFrame:
    """(id, n, f, g, bands, s0..s7) of each row; no bands for empty sets."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            n, f, g = np.zeros(rows, np.int64), np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
            minima = np.zeros((rows, len(_A)), np.uint64)
            for row, own in enumerate(_each(batch.column(1), width)):
                n[row] = len(own)
                if len(own):
                    f[row], g[row] = tokens.mix(own).sum(dtype=np.uint64), np.bitwise_xor.reduce(tokens.mix(own + np.uint64(1)))
                    minima[row] = _minima(own)
            number = np.arange(len(_A), dtype=np.uint64) << np.uint64(32)
            bit = (tokens.mix(minima ^ number[None]) >> np.uint64(55)).astype(np.int64)  # one of 512
            flips = np.zeros((rows, 512), np.uint8)
            np.add.at(flips, (np.arange(rows)[:, None], bit), 1)
            sketch = np.packbits(flips & 1, axis=1).view(np.int64)
            keys = np.full((rows, BANDS), np.arange(BANDS, dtype=np.uint64)[None])
            for r in range(ROWS):
                keys = tokens.mix(keys * np.uint64(0x9E3779B97F4A7C15) + minima[:, r::ROWS])
            full = n > 0
            cuts = np.r_[0, np.cumsum(full * BANDS)]
            bands = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(keys[full].ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n), pa.array(f.view(np.int64)), pa.array(g.view(np.int64)), bands,
                 *[pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(SKETCH_LONGS)]],
                ["id", "n", "f", "g", "bands", *_SKETCH],
            )

    return docs.select(F.col(id_).cast("long"), text).mapInArrow(of, _SIGNED)


def _sets(docs: DataFrame, id_: str, text: str, width: int) -> DataFrame:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [own.tobytes() for own in _each(batch.column(1), width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["id", "shingles"])

    return docs.select(F.col(id_).cast("long").alias("id"), text).mapInArrow(of, "id long, shingles binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have the wanted similarity."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], ["a", "b"])

    x = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    full = pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return full.mapInArrow(of, "a long, b long")


def _possible(left: str, right: str, percent: int):
    """Size and odd sketch allow the similarity. Never false for a pair above it, but for a chance of 1e-6."""
    a, b = (lambda c: F.col(f"{left}.{c}")), (lambda c: F.col(f"{right}.{c}"))
    apart = sum((F.bit_count(a(s).bitwiseXOR(b(s))) for s in _SKETCH), F.lit(0))
    return (100 * F.least(a("n"), b("n")) >= percent * F.greatest(a("n"), b("n"))) & (apart <= MAX_XOR)


def _sketches(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """Odd sketches over whole sets: the parity of the shingles in each of `bits` places."""
    wide = np.empty((len(sets), bits // 64), np.uint64)
    for row, own in zip(wide, sets):
        flips = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
        row[:] = np.packbits(flips.astype(np.uint8)).view(np.uint64)
    return wide


def links_between(
    ids: np.ndarray, root: np.ndarray, side: np.ndarray, sets: list[np.ndarray], percent: int
) -> list[tuple[int, int]]:
    """Links that tie the components of one group of members; of two sides only pairs across them are looked at.

    Members go by set size. Sketches have twice as many bits as the smaller set has shingles,
    so sets of any size that have little in common are told apart without a look at the sets.
    """
    n = np.array([len(x) for x in sets])
    order = np.argsort(n, kind="stable")
    ids, root, side, n = ids[order], root[order].copy(), side[order], n[order]
    sets = [sets[i] for i in order]
    cross = side.min() != side.max()
    ends = np.searchsorted(n, n * 100 // percent, "right")  # what follows is too large for a link
    bits = np.maximum(LEAST_BITS, 2 << np.ceil(np.log2(n)).astype(np.int64))
    found = []
    for level in np.unique(bits).tolist():
        at, stop = np.searchsorted(bits, level), np.searchsorted(bits, level, "right")
        wide = _sketches(sets[at: ends[stop - 1]], level)
        for i in range(at, stop):
            fit = root[i + 1: ends[i]] != root[i]
            if cross:
                fit &= side[i + 1: ends[i]] != side[i]
            later = np.flatnonzero(fit) + i + 1
            if not len(later):
                continue
            apart = np.bitwise_count(wide[later - at] ^ wide[i - at]).sum(axis=1, dtype=np.int64)
            # Sets differ in at least as many shingles as sketches do in bits: nothing is lost here.
            possible = apart * (100 + percent) <= (100 - percent) * (n[later] + n[i])
            for j in later[possible][np.argsort(apart[possible], kind="stable")].tolist():
                if root[i] != root[j]:
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * both >= percent * (n[i] + n[j] - both):
                        found.append((int(ids[i]), int(ids[j])))
                        root[root == root[j]] = root[i]
    return found


def _between(percent: int):
    """Links between components of one group of members, each pair of components tied once."""

    def of(rows):
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows["shingles"].combine_chunks()]
        found = links_between(*(np.asarray(rows[c]) for c in ("id", "root", "chunk")), sets, percent)
        return pa.table({"a": pa.array([min(x) for x in found], pa.int64()), "b": pa.array([max(x) for x in found], pa.int64())})

    return of


def _rest(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components that meet in a bucket; `placed` is (id, n, band, root).

    Buckets with the same members count once. A bucket of more than `CHUNK` members, or
    `CHUNK_BYTES` of sets, is cut into chunks by a hash, and every two chunks meet in a task of
    their own.
    """
    buckets = placed.groupBy("band").agg(
        F.min("root").alias("r"), F.max("root").alias("s"), F.count(F.lit(1)).alias("m"),
        F.sum("n").alias("held"), F.bit_xor(F.xxhash64("id")).alias("x"), F.sum(F.hash("id")).alias("y"),
    ).where("r < s")
    chunks = F.greatest(F.ceil(F.col("m") / CHUNK), F.ceil(F.col("held") * 8 / CHUNK_BYTES))
    once = buckets.groupBy("m", "held", "x", "y").agg(F.min("band").alias("band")).select("band", chunks.alias("chunks"))
    cut = placed.join(once, "band").withColumn("chunk", F.pmod(F.xxhash64("id", "band"), F.col("chunks")))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).select(
        "band", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "id", "root", "chunk"
    )
    return met.join(sets, "id").groupBy("band", "lo", "hi").applyInArrow(_between(percent), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, id_: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row; see the module. `percent` from 80 on."""
    if percent < 80:
        raise ValueError("bands and sketches are laid out for a similarity of 0.8 or more")
    signed = staged(signatures(docs, id_, text, width), "signatures")
    proper = signed.where("n > 0 AND id IS NOT NULL")
    classes = staged(proper.groupBy("n", "f", "g").agg(F.min("id").alias("rep")), "classes")
    # The representative's row, one row even when rows repeat.
    reps = proper.join(classes.withColumnRenamed("rep", "id"), ["n", "f", "g", "id"], "left_semi").dropDuplicates(["id", "n", "f", "g"])
    banded = reps.select("id", "n", F.explode("bands").alias("band"))
    # The smallest member of each bucket with more than one.
    centers = banded.groupBy("band").agg(F.min("id").alias("center"), F.max("id").alias("last")).where("center < last").select("band", "center")
    member = staged(banded.join(centers, "band"), "members")
    brief = staged(
        reps.join(member.select("id").distinct(), "id", "left_semi").select("id", "n", *_SKETCH), "sketches"
    )
    star = member.where("id > center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    likely = (
        star.join(brief.alias("x"), F.col("a") == F.col("x.id")).join(brief.alias("y"), F.col("b") == F.col("y.id"))
        .where(_possible("x", "y", percent)).select("a", "b")
    )
    # A merge join at every size: which ids are wanted grows with the input.
    wanted = brief.select(F.col("id").alias("_id")).distinct().hint("merge")
    texts = docs.select(id_, text).join(wanted, F.col(id_).cast("long") == F.col("_id"), "left_semi")
    # Rows that share an id can differ; a class has the fingerprint of its own set.
    sets = staged(_sets(texts, id_, text, width).dropDuplicates(["id", "shingles"]), "sets")
    links = staged(_confirmed(likely, sets, percent).distinct(), "links")
    joined = components(links)

    placed = (
        member.join(joined.withColumnRenamed("node", "id"), "id", "left")
        .select("id", "n", "band", F.coalesce("root", "id").alias("root"))
    )
    late = staged(_rest(placed, sets, percent), "late-links")
    # Rows of one id with different texts are one document: their classes hang together.
    same = proper.join(classes, ["n", "f", "g"]).where("id > rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    twice = same.join(reps.select(F.col("id").alias("b")).distinct(), "b", "left_semi").select("a", "b")
    roots = staged(components(links.union(late).union(twice)), "roots")

    out = signed.join(classes, ["n", "f", "g"], "left").join(roots, F.col("rep") == F.col("node"), "left")
    linked = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.coalesce("root", "rep")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_), F.col("n").alias("n_shingles"), linked.alias("component_id"),
        F.coalesce(F.col("id") == linked, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Rows of `docs` that are the document of their group with the smallest id, one row for each id.

    Rows without an id are all kept.
    """
    gone = near_duplicates(docs, width=width, percent=percent).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    named = docs.where("doc_id IS NOT NULL")
    kept = named.join(gone, named["doc_id"] == gone["_gone"], "left_anti").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id IS NULL"))
