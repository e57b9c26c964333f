"""Exact top-k by inner product: columnar branch and bound.

Candidates and queries are dealt into blocks, and each pair of blocks is one bounded group.
Inside it the vectors lie dimension by dimension. Scores are accumulated one block of
dimensions after the other; after each, the part not yet seen of a score lies within the
product of the two remaining norms (Cauchy-Schwarz). The k-th best lower bound of a query
is a floor for its result, so candidates whose upper bound is below it leave, and the
survivors are compacted before the next block of dimensions. Ties stay, so the result is
exact. The k best of each pair are merged per query by (score descending, id).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window, functions as F

_EXACT = 1 << 53
_QUERIES_AT_ONCE = 64


def _vectors(table: pa.Table, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids ascending and the matrix (dimension, row) of scaled integer components, as doubles.

    Shorter vectors are filled up with zeros, which changes no inner product.
    """
    ids = table.column("id").to_numpy()
    column = table.column("v").combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    out = np.zeros((len(ids), max(int(lengths.max(initial=0)), 1)))
    row = np.repeat(np.arange(len(ids)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    order = np.argsort(ids, kind="stable")
    return ids[order], np.ascontiguousarray(out[order].T)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores; of equal ones the first positions. Best first."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        kept = np.flatnonzero(scores >= floor)
        return kept[np.argsort(-scores[kept], kind="stable")[:k]]
    return np.argsort(-scores, kind="stable")


def _remaining_norms(matrix: np.ndarray, starts: list[int]) -> np.ndarray:
    """(block, row): the norm of the components from the block's start on, rounded up."""
    tail = np.cumsum((matrix[::-1] ** 2), axis=0)[::-1]
    norms = np.sqrt(np.stack([tail[s] if s < len(matrix) else np.zeros(matrix.shape[1]) for s in starts]))
    return norms * (1 + 1e-9)


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
                 k: int, width: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Per query its id and the (ids, scores) of its k best candidates with another id."""
    dims = max(len(queries), len(vectors))
    queries, vectors = (np.pad(m, ((0, dims - len(m)), (0, 0))) for m in (queries, vectors))
    largest = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * dims
    if not largest < _EXACT:                    # beyond exact doubles: 64-bit integers, no bounds
        whole = np.clip(vectors, -(2.0**62), 2.0**62).astype(np.int64)
        out = []
        for i, query in enumerate(query_ids):
            scores = np.clip(queries[:, i], -(2.0**62), 2.0**62).astype(np.int64) @ whole
            others = np.flatnonzero(ids != query)
            best = others[_best(scores[others], k)]
            out.append((query, ids[best], scores[best]))
        return out

    starts = list(range(0, dims, width))
    left_q, left_v = (_remaining_norms(m, [*starts[1:], dims]) for m in (queries, vectors))
    out = []
    for at in range(0, len(query_ids), _QUERIES_AT_ONCE):
        several = slice(at, at + _QUERIES_AT_ONCE)
        first = queries[:width, several].T @ vectors[:width]
        for j, query in enumerate(query_ids[several]):
            alive = np.flatnonzero(ids != query)
            partial = first[j, alive]
            for b, start in enumerate(starts):
                if b:
                    partial = partial + queries[start:start + width, at + j] @ vectors[start:start + width][:, alive]
                if len(alive) > k and b + 1 < len(starts):
                    slack = left_q[b, at + j] * left_v[b, alive]
                    lower = partial - slack
                    floor = np.partition(lower, len(lower) - k)[len(lower) - k]
                    stays = partial + slack >= floor - 1e-6
                    alive, partial = alive[stays], partial[stays]
            best = _best(partial, k)
            out.append((query, ids[alive[best]], partial[best].astype(np.int64)))
    return out


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20, id: str = "vec_id", vector: str = "embedding",
          scale: int = 64, width: int = 16, query_rows: int = 1024, candidate_rows: int = 8192) -> DataFrame:
    """The `k` candidates with the highest inner product per query, own id left out.

    Components are `floor(scale * x)`. Columns: `query_id`, `rank` (from 1), `<id>`,
    `score`; ties go to the smaller id. Rows with a null id, a null vector, or a null or
    non-finite component take no part, on either side. Vectors of unequal length are filled
    up with zeros. Rows that repeat an id are all candidates; as a query the least vector
    of an id is taken. With fewer than `k` others, all are returned; an empty side gives no
    rows. Scores must fit 64 bits.
    """
    spark = queries.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        v = F.col(vector)
        finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        return df.where(F.col(id).isNotNull() & v.isNotNull() & finite).select(
            F.col(id).cast("bigint").alias("id"), v.alias("v"))

    asked = usable(queries).groupBy("id").agg(F.min("v").alias("v"))
    offered = usable(candidates)
    spread = 4 * spark.sparkContext.defaultParallelism
    query_blocks = max(1, math.ceil(asked.count() / query_rows))
    candidate_blocks = max(spread, math.ceil(offered.count() / candidate_rows))

    def block(seed: int, n: int):
        return F.pmod(F.xxhash64("id", "v", F.lit(seed)), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    pairs = (asked.withColumn("qb", block(1, query_blocks)).withColumn("is_query", F.lit(True))
             .withColumn("cb", every(candidate_blocks))
             .unionByName(offered.withColumn("cb", block(2, candidate_blocks)).withColumn("is_query", F.lit(False))
                          .withColumn("qb", every(query_blocks))))

    def search(table: pa.Table) -> pa.Table:
        is_query = table.column("is_query")
        sides = [table.filter(is_query), table.filter(pa.compute.invert(is_query))]
        found = []
        if all(s.num_rows for s in sides):
            found = search_block(*_vectors(sides[0], scale), *_vectors(sides[1], scale), k, width)
        counts = [len(ids) for _, ids, _ in found]
        empty = np.zeros(0, np.int64)
        return pa.table({
            "query_id": np.repeat(np.array([q for q, _, _ in found], np.int64), counts),
            "id": np.concatenate([empty, *(ids for _, ids, _ in found)]),
            "score": np.concatenate([empty, *(scores for _, _, scores in found)])})

    best = pairs.groupBy("qb", "cb").applyInArrow(search, "query_id bigint, id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id), "score"))
