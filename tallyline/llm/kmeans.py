"""Exact centroid clustering by equal-average equal-variance search.

For a vector x and a centroid c with n components, sums S and deviation norms V (the norm
of the components less their mean)

    |x - c|^2  =  (S_x - S_c)^2 / n  +  |deviations of x - deviations of c|^2
              >=  (S_x - S_c)^2 / n  +  (V_x - V_c)^2.

Centroids are sorted by their sum, which orders them by component mean. A search starts at
the vector's own mean and walks outward, always to the side whose next mean is nearer. It
ends when the mean inequality alone rules out that centroid, and so all farther ones. A
centroid that only both terms together rule out is passed over. What remains is decided by
the whole squared distance in 64-bit integers. The means are compared in integers too; the
deviations are doubles, so their bound is lowered by more than its rounding error.

A round is one pass: a task assigns its rows batch by batch and returns sums per cluster and
component, which Spark adds up. The driver only sees those, `k * n` numbers, whatever the
size of the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyline.session import cut_lineage

# Squared distances of `n` components up to this size in total stay below 2**63.
_LARGEST_SQUARE = 1 << 62
_COUNT = -1                                         # number of the "component" that counts rows


def scaled(vector: Column, dims: int, scale: int) -> Column:
    """The components as `floor(scale * x)`; null for a vector that is null, has another
    length, or holds a null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return F.when((F.size(vector) == dims) & finite, whole)


class Centroids:
    """The centroids of one round, sorted by sum, with what the inequalities need."""

    def __init__(self, rows: list[list[int]]):
        matrix = np.array(rows, np.int64)
        sums = matrix.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")            # sorted place -> number
        self.matrix, self.sums = matrix[self.order], sums[self.order]
        self.deviations = _deviations(self.matrix, self.sums)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid (ties: the smaller one) and the squared distance, per row."""
        rows, dims, k = len(x), x.shape[1], len(self.sums)
        largest = max(abs(int(bound)) for m in (x, self.matrix) for bound in (m.min(initial=0), m.max(initial=0)))
        if dims * (2 * largest) ** 2 > _LARGEST_SQUARE:
            raise OverflowError(f"squared distances of components up to {largest} do not fit 64 bits")
        sums = x.sum(axis=1)
        deviations = _deviations(x, sums)
        best = np.full(rows, np.iinfo(np.int64).max)
        number = np.full(rows, k)
        right = np.searchsorted(self.sums, sums)                # next centroid on either side
        left = right - 1
        active = np.arange(rows)
        while len(active):
            lo, hi, s = left[active], right[active], sums[active]
            to_left = np.where(lo >= 0, s - self.sums[np.maximum(lo, 0)], np.iinfo(np.int64).max)
            to_right = np.where(hi < k, self.sums[np.minimum(hi, k - 1)] - s, np.iinfo(np.int64).max)
            go_left = to_left <= to_right
            at, gap = np.where(go_left, lo, hi), np.where(go_left, to_left, to_right)
            # mean inequality; an equal bound may still be a tie with a smaller number
            within = (at >= 0) & (at < k) & (np.minimum(gap, 1 << 31) ** 2 <= _times(best[active], dims))
            active, at, gap, go_left = active[within], at[within], gap[within], go_left[within]
            left[active[go_left]] -= 1
            right[active[~go_left]] += 1
            bound = gap.astype(np.float64) ** 2 / dims + (deviations[active] - self.deviations[at]) ** 2
            open_ = bound * (1 - 1e-9) - 1e-6 <= best[active]
            rest, at = active[open_], at[open_]
            distance = ((x[rest] - self.matrix[at]) ** 2).sum(axis=1)
            closer = (distance < best[rest]) | ((distance == best[rest]) & (self.order[at] < number[rest]))
            best[rest[closer]], number[rest[closer]] = distance[closer], self.order[at[closer]]
        return number, best


def _deviations(x: np.ndarray, sums: np.ndarray) -> np.ndarray:
    centred = x - (sums / x.shape[1])[:, None]
    return np.sqrt((centred ** 2).sum(axis=1))


def _times(values: np.ndarray, by: int) -> np.ndarray:
    """The product, or the largest integer where it does not fit."""
    most = np.iinfo(np.int64).max
    return np.where(values > most // by, most, np.minimum(values, most // by) * by)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _round(vectors: DataFrame, centroids: Centroids, dims: int) -> dict[int, dict[int, int]]:
    """Per cluster that has rows: the sum of each component and, under -1, the number of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids.sums)
        totals = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            number, _ = centroids.nearest(x)
            order = np.argsort(number, kind="stable")
            starts = np.flatnonzero(np.diff(number[order], prepend=-1))
            if len(starts):
                filled = number[order][starts]
                totals[filled, 1:] += np.add.reduceat(x[order], starts, axis=0)
                totals[filled, 0] += np.diff(np.append(starts, len(order)))
        seen = np.flatnonzero(totals[:, 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(seen, dims + 1).astype(np.int32)),
             pa.array(np.tile(np.arange(_COUNT, dims), len(seen)).astype(np.int32)),
             pa.array(totals[seen].ravel())], ["cluster", "component", "total"])

    found: dict[int, dict[int, int]] = {}
    partial = vectors.select("v").mapInArrow(run, "cluster int, component int, total bigint")
    for row in partial.groupBy("cluster", "component").agg(F.sum("total").alias("total")).collect():
        found.setdefault(row["cluster"], {})[row["component"]] = row["total"]
    return found


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors of the `k` rows with the smallest sha-256 of `<seed>:<id>`, in that order;
    rows that repeat an id stand by their components."""
    dice = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    seeds = vectors.where(F.col("id").isNotNull()).select(dice.alias("dice"), "v").orderBy("dice", "v").limit(k)
    return [row["v"] for row in seeds.collect()]


def cluster(df: DataFrame, k: int = 16, rounds: int = 3, id: str = "vec_id", vector: str = "embedding",
            dims: int = 64, scale: int = 64, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """Assigned rows (`id`, `cluster`, `distance`) and the final centroids (`cluster`, `centroid`).

    Components are `floor(scale * x)`. Rows whose vector is null, has not `dims` components,
    or holds a null or non-finite one take no part. The first centroids are `first_centroids`.
    Each round assigns every row to the nearest centroid by squared Euclidean distance
    (ties: the smaller number) and then moves every centroid that has rows to the floors of
    their mean; at the end all rows are assigned once more. Rows with a null id are
    clustered but never a first centroid; rows that repeat an id are all clustered. With
    fewer than `k` rows to start from there are as many centroids as such rows; without any
    the result is empty. Squared distances beyond 64 bits raise an OverflowError. Other
    columns, whatever their names, are not read.
    """
    spark = df.sparkSession
    vectors = (df.select(F.col(id).alias("id"), scaled(F.col(vector), dims, scale).alias("v"))
               .where(F.col("v").isNotNull()))
    kind = df.schema[id].dataType.simpleString()
    rows = first_centroids(vectors, k, seed)
    if not rows:
        return (spark.createDataFrame([], f"`{id}` {kind}, cluster int, distance bigint"),
                spark.createDataFrame([], "cluster int, centroid array<bigint>"))
    for _ in range(rounds):
        sums = _round(vectors, Centroids(rows), dims)
        rows = [[sums[c][i] // sums[c][_COUNT] for i in range(dims)] if c in sums else row
                for c, row in enumerate(rows)]
    last = Centroids(rows)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, distance = last.nearest(_matrix(batch.column(1), dims))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(number.astype(np.int32)), pa.array(distance)], [id, "cluster", "distance"])

    assigned = vectors.select("id", "v").mapInArrow(assign, f"`{id}` {kind}, cluster int, distance bigint")
    return assigned, spark.createDataFrame(list(enumerate(rows)), "cluster int, centroid array<bigint>")


def with_inertia(assigned: DataFrame, centroids: DataFrame) -> DataFrame:
    """The assigned rows with `cluster_inertia` and `inertia` (distance summed over the
    cluster and over all) and `centroid_sha256` (of the components joined by commas)."""
    assigned = cut_lineage(assigned)
    per_cluster = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = assigned.agg(F.sum("distance")).scalar()
    sha = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    facts = centroids.join(per_cluster, "cluster").select("cluster", "cluster_inertia", sha.alias("centroid_sha256"))
    # one row a centroid, and `k` is a parameter
    return assigned.join(F.broadcast(facts), "cluster").withColumn("inertia", whole)
