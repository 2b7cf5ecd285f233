"""Exact top-k inner products by aggregation of sorted lists without random access.

Components are whole numbers floor(256 * x). Vectors go to blocks by a hash; each block of
queries meets each block of vectors once. In such a pair, every dimension is a list of the
block's vectors sorted by component, read from the top for a positive query component and
from the bottom for a negative one. All lists are read to the same depth, values equal to
the last one included. What a vector has shown so far, with the least and the most that
unread lists can add, bounds its score from below and above; for a whole batch of queries
these are two matrix products. The vectors with the best lower bounds have their scores
resolved, which raises those bounds to the scores. Vectors whose upper bound is under the
k-th largest lower bound are out, seen or not; the depth doubles until few are left, and
their scores are resolved. The bests of all pairs of a query are then ranked.

Vectors that are null or hold null or non-finite components take no part; a shorter vector
counts as filled up with zeros. A vector is no candidate for a query of the same id. Ties go
to smaller ids. Repeated rows count once; rows without an id are left out. Scores are
64-bit. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickwork.llm.common import staged

K = 5
QUERY_BLOCK, VECTOR_BLOCK = 1024, 16_384
BATCH = 128  # queries bounded at once: two matrices of so many rows are held
FIRST_DEPTH = 4  # the first reading goes to one part in so many of each list
LEADERS = 16  # vectors of a query resolved at each depth
FEW = 64
_BEST = "query_id long, vec_id long, score long"


def whole_vectors(df: DataFrame, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v): valid vectors as whole numbers."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    valid = df.where(F.col(id_).isNotNull() & F.col(vector).isNotNull()).select(F.col(id_).cast("long").alias("id"), x.alias("x"))
    return valid.where(F.forall("x", lambda c: F.coalesce((~F.isnan(c)) & (F.abs(c) < float("inf")), F.lit(False)))).select(
        "id", F.transform("x", lambda c: F.floor(c * 256)).alias("v")
    ).dropDuplicates()


def _matrix(rows: pa.Table, width: int) -> np.ndarray:
    lists = rows["v"].combine_chunks()
    sizes = np.asarray(lists.value_lengths()).astype(np.int64)
    out = np.zeros((len(lists), width), np.int64)
    flat = np.asarray(lists.flatten()).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _exact_type(vectors: np.ndarray, queries: np.ndarray) -> type:
    """The fastest type in which no sum of these products is rounded."""
    most = float(np.abs(vectors.astype(float)).max(0, initial=0) @ np.abs(queries.astype(float)).max(0, initial=0))
    return np.float32 if most < 2**23 else np.float64 if most < 2**52 else np.int64


class SortedLists:
    """The lists of a block, one for each dimension, from the largest component down."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        lists = np.sort(vectors, axis=0)[::-1]
        self.readings = []
        depth = -(-len(ids) // FIRST_DEPTH)
        while LEADERS < depth < len(ids):
            top, bottom = lists[depth - 1], lists[-depth]
            least = [np.where(vectors >= top, vectors, lists[-1]), np.where(vectors <= bottom, vectors, lists[0])]
            most = [np.maximum(vectors, top), np.minimum(vectors, bottom)]
            self.readings.append((np.hstack(least), np.hstack(most)))
            depth *= 2

    def best(self, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of the query, id, score) of the k best of each query, ties to smaller ids."""
        mine = self.ids == own[:, None]
        left = ~mine
        split = np.hstack([np.maximum(queries, 0), np.minimum(queries, 0)])
        leaders = max(k, LEADERS)
        for least, most in self.readings if len(self.ids) > leaders else []:
            lower = split @ least.T
            lower[mine] = lower.min(initial=0) - 1
            lead = np.argpartition(lower, -leaders, axis=1)[:, -leaders:]
            score = np.einsum("qd,qld->ql", queries, self.vectors[lead])
            own_lead = np.take_along_axis(mine, lead, 1)
            score[own_lead] = np.take_along_axis(lower, lead, 1)[own_lead]
            bar = np.partition(score, -k, axis=1)[:, -k]
            left = (split @ most.T >= bar[:, None]) & ~mine
            if left.sum() <= FEW * len(queries):
                break
        rows, found = np.nonzero(left)
        if len(rows) > FEW * len(queries):  # resolved together, and cut at the k-th score
            score = queries @ self.vectors.T
            score[mine] = score.min(initial=0) - 1
            bar = np.partition(score, -k, axis=1)[:, -k] if score.shape[1] >= k else score.min(axis=1)
            rows, found = np.nonzero((score >= bar[:, None]) & ~mine)
            score = score[rows, found]
        else:
            score = np.einsum("pd,pd->p", queries[rows], self.vectors[found])
        order = np.lexsort((self.ids[found], -score, rows))
        rows, found, score = rows[order], found[order], score[order]
        top = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
        return rows[top], self.ids[found[top]], score[top].astype(np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) for whole vectors and queries (id, v)."""
    vectors, queries = staged(vectors, "vectors"), staged(queries, "queries")
    size = lambda df: df.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    (n, a), (m, b) = size(vectors), size(queries)
    width = max(a or 0, b or 0)
    n_blocks, m_blocks = max(1, -(-n // VECTOR_BLOCK)), max(1, -(-m // QUERY_BLOCK))

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int, asks: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).alias(own)
        return df.select("id", "v", block, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other), F.lit(asks).alias("asks"))

    def best(rows):
        asks = np.asarray(rows["asks"].combine_chunks())
        ids, matrix = np.asarray(rows["id"]), _matrix(rows, width)
        matrix = matrix.astype(_exact_type(matrix[~asks], matrix[asks]))
        lists, own, asked = SortedLists(ids[~asks], matrix[~asks]), ids[asks], matrix[asks]
        batches = range(0, len(own) if len(lists.ids) else 0, BATCH)
        met = [(at, *lists.best(asked[at:at + BATCH], own[at:at + BATCH], k)) for at in batches]
        none = [np.empty(0, np.int64)]
        return pa.table({
            "query_id": np.concatenate([own[at + row] for at, row, *_ in met] or none),
            "vec_id": np.concatenate([vec for *_, vec, _ in met] or none),
            "score": np.concatenate([score for *_, score in met] or none),
        })

    both = dealt(vectors, "vb", n_blocks, "qb", m_blocks, False).unionByName(dealt(queries, "qb", m_blocks, "vb", n_blocks, True))
    met = both.groupBy("vb", "qb").applyInArrow(best, _BEST).distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
