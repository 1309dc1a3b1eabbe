"""Centroid clustering of integer vectors, with assignments by the threshold algorithm.

Vectors are scaled and rounded down to integers, so that every distance and every mean is exact and the result depends on
neither order nor partitioning. To find a vector's nearest centroid, each dimension has its list of the centroids sorted
by their component. The lists are walked outward from the vector's own component, one step in every dimension per round;
a centroid met for the first time has its exact distance taken. What has not been met in any list is at least as far
away as the sum over the dimensions of the squared distances at the frontiers, so the walk stops when that sum is strictly above the
best exact distance: strictly, so that a tie with a smaller number is not missed.

A round is one job: partial sums per task and cluster, combined by Spark. What comes to the driver, and goes out with the next
round's tasks, is one vector per cluster.

Defined results: vectors of another length, null ones, and those with a null or non-finite component take no part.
Repeated rows are rows; of equal hashes the smaller vector starts first. A null vec_id is clustered, but starts no
centroid. With fewer vectors with an id than clusters there are as many centroids; without any, or on an empty table, the result is empty.
A component beyond 2**27 in size (after scaling) ends the job with an error, as distances would no longer fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.session import written

SCALE = 1024
LIMIT = 1 << 27
#: Vectors that walk together.
BLOCK = 4096


def quantised(vectors: DataFrame, carry: list[str], dims: int, vec_id: str, vector: str) -> DataFrame:
    """Carried columns, `id` and `v`: the integer components of every vector that takes part."""
    x = F.col(vector)
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE))
    return (
        vectors.where((F.size(x) == dims) & whole)
        .select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)], F.col(vec_id).alias("id"), scaled.alias("v"))
        .withColumn(
            "v",
            F.when(F.forall("v", lambda c: F.abs(c) <= LIMIT), F.col("v")).otherwise(
                F.raise_error(F.lit("a component is beyond 2**27"))
            ),
        )
    )


def first_centroids(kept: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The vectors whose ids have the smallest hashes; as many rows as clusters."""
    key = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    rows = kept.where(F.col("id").isNotNull()).select(key.alias("key"), "v").orderBy("key", "v").limit(clusters)
    return np.array([row.v for row in rows.collect()], dtype=np.int64)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid of each vector (ties: the smaller number), its squared distance, and how many were compared."""
    n, dims = vectors.shape
    k = len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable")  # the lists: centroid numbers by component
    lists = np.take_along_axis(centroids, order, axis=0)
    # One step beyond either end of a list is farther than anything.
    far = np.int64(1) << 29
    padded = np.concatenate([np.full((1, dims), -far), lists, np.full((1, dims), far)])
    right = np.empty((n, dims), dtype=np.int64)
    for d in range(dims):
        right[:, d] = np.searchsorted(lists[:, d], vectors[:, d], side="left")
    left = right - 1
    dim = np.arange(dims)
    best = np.full(n, np.iinfo(np.int64).max)
    which = np.zeros(n, dtype=np.int64)
    met = np.zeros((n, k), dtype=bool)
    walking = np.arange(n)
    for _ in range(k):
        x, lo, hi = vectors[walking], left[walking], right[walking]
        down, up = x - padded[lo + 1, dim], padded[hi + 1, dim] - x
        upward = up <= down
        number = order[np.where(upward, np.minimum(hi, k - 1), np.maximum(lo, 0)), dim]
        seen = np.zeros((len(walking), k), dtype=bool)
        np.put_along_axis(seen, number, True, axis=1)
        row, c = np.nonzero(seen & ~met[walking])
        gap = x[row] - centroids[c]
        exact = np.einsum("ij,ij->i", gap, gap)
        at = walking[row]
        met[at, c] = True
        # By distance, then number: the first entry of each vector is its candidate of this round.
        by = np.lexsort((c, exact, at))
        at, first = np.unique(at[by], return_index=True)
        exact, c = exact[by][first], c[by][first]
        wins = (exact < best[at]) | ((exact == best[at]) & (c < which[at]))
        best[at[wins]], which[at[wins]] = exact[wins], c[wins]
        frontier = np.where(upward, up, down)
        on = np.einsum("ij,ij->i", frontier, frontier) <= best[walking]
        left[walking] = np.where(upward, lo, lo - 1)
        right[walking] = np.where(upward, hi + 1, hi)
        walking = walking[on]
        if not len(walking):
            break
    return which, best, met.sum(axis=1)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Numbers of first rows, and the vectors from there on."""
    column = batch.column(batch.schema.get_field_index("v"))
    dims = len(column[0]) if len(column) else 0
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)
    for begin in range(0, len(flat), BLOCK):
        yield begin, flat[begin : begin + BLOCK]


def next_centroids(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid's vectors' mean, rounded down; a centroid without vectors stays."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes = np.zeros_like(centroids), np.zeros(len(centroids), dtype=np.int64)
        for batch in batches:
            for _, some in _blocks(batch):
                which, _, _ = nearest(some, centroids)
                for c in np.unique(which).tolist():
                    sums[c] += some[which == c].sum(axis=0)
                sizes += np.bincount(which, minlength=len(centroids))
        has = np.flatnonzero(sizes)
        dims = centroids.shape[1]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(has, dims)), pa.array(np.tile(np.arange(dims), len(has))),
                pa.array(np.repeat(sizes[has], dims)), pa.array(sums[has].ravel()),
            ],
            names=["cluster", "dim", "n", "total"],
        )

    parts = kept.select("v").mapInArrow(partial, "cluster long, dim long, n long, total long")
    means = parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(28,0)")).alias("total"))
    after = centroids.copy()
    for row in means.collect():  # a row per cluster and dimension
        after[row.cluster, row.dim] = int(row.total) // row.n
    return after


def assigned(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The rows with `cluster` and `distance` in place of the vector."""
    rest = [c for c in kept.columns if c != "v"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, some in _blocks(batch):
                which, best, _ = nearest(some, centroids)
                part = batch.slice(begin, len(some))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in rest] + [pa.array(which.astype(np.int32)), pa.array(best)],
                    names=[*rest, "cluster", "distance"],
                )

    return kept.mapInArrow(work, kept.drop("v").schema.add("cluster", "integer").add("distance", "long"))


def clustered(
    vectors: DataFrame,
    carry: list[str],
    clusters: int = 8,
    rounds: int = 10,
    dims: int = 64,
    seed: str = "3:",
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Carried columns of every vector that takes part, its `cluster`, squared `distance`, `cluster_inertia`, `inertia`,
    and the cluster's final `centroid`."""
    spark = vectors.sparkSession
    kept = written(quantised(vectors, carry, dims, vec_id, vector), "quantised")
    centroids = first_centroids(kept, clusters, seed)
    names = {f"_c{i}": c for i, c in enumerate(carry)}
    if not len(centroids):
        none = kept.select(*names).limit(0).withColumnsRenamed(names)
        kinds = {"cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long", "centroid": "array<long>"}
        return none.withColumns({c: F.lit(None).cast(t) for c, t in kinds.items()})
    for _ in range(rounds):
        after = next_centroids(kept, centroids)
        if (after == centroids).all():
            break  # nothing moves any more
        centroids = after
    rows = written(assigned(kept.drop("id"), centroids), "assigned")
    final = spark.createDataFrame([(c, v.tolist()) for c, v in enumerate(centroids)], "_cluster int, centroid array<long>")
    # One row per cluster.
    sums = rows.groupBy(F.col("cluster").alias("_cluster")).agg(F.sum("distance").alias("cluster_inertia"))
    sums = sums.withColumn("inertia", rows.agg(F.sum("distance")).scalar()).join(F.broadcast(final), "_cluster")
    same: Column = F.col("cluster") == F.col("_cluster")
    return rows.join(F.broadcast(sums), same).drop("_cluster").withColumnsRenamed(names)
