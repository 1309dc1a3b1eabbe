"""Nearest neighbours by vantage-point trees, one per shard.

Vectors are dealt to shards of about `SHARD` rows by a hash of their id. A task builds a shard's
tree: each node keeps one vector as its vantage point, halves the others by their distance to it, and
remembers the least and greatest distance of either half. A search skips a half if the triangle
inequality puts all of it beyond the bound of the query: the distance of its k-th neighbour so far,
divided by `relax`. At `relax` 1 the search is exact; above it halves are skipped that
could hold only neighbours nearer by less than that factor.

Vectors are shuffled once: a task gets its shards one after the other, builds the tree of each once,
and lets all queries pass by it in blocks of `BLOCK`. It holds one shard, one block and a bound per
query; the bounds are carried from shard to shard, so later ones report only what is nearer, and
Spark cuts a task's rows to k per query before they are merged. To start with a bound that is not
infinite, queries are first measured against a bounded sample of `SEED_ROWS` vectors; any bound from
real candidates is a valid one.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component take no
part, nor do rows without an id. Rows that repeat an id count once, with the smallest of their vectors.
Vectors of different lengths are never compared. Ties are settled by the smaller id. A query
with fewer than k candidates gets all of them. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.session import written

SHARD = 8192
BLOCK = 2048
LEAF = 48
#: Rows whose distances bound the first search; the smallest hashes of all ids.
SEED_ROWS = 512
RELAX = 1.0
#: Tasks of a search at most; beyond it they get more shards.
MOST_TASKS = 20_000
#: Room for rounding in the triangle inequality.
SLACK = 1e-9


def distances(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows, summed component by component."""
    out = np.zeros((len(queries), len(vectors)))
    for i in range(queries.shape[1]):
        gap = queries[:, i, None] - vectors[None, :, i]
        out += gap * gap
    return np.sqrt(out)


class Tree:
    """A vantage-point tree over the rows of a matrix, built without recursion on values: halves are
    cut by rank, so equal vectors do no harm."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF) -> None:
        self.vectors, self.nodes, self.leaf = vectors, [], leaf
        self.root = self._build(np.arange(len(vectors)))

    def _build(self, rows: np.ndarray) -> int:
        at = len(self.nodes)
        if len(rows) <= self.leaf:
            self.nodes.append((rows,))
            return at
        self.nodes.append(())
        # The vector farthest from the middle of the rows sees the rest most spread out.
        middle = self.vectors[rows].mean(axis=0, keepdims=True)
        point = int(distances(middle, self.vectors[rows])[0].argmax())
        own = rows[point]
        rest = np.delete(rows, point)
        far = distances(self.vectors[own][None], self.vectors[rest])[0]
        order = np.argsort(far, kind="stable")
        cut = len(order) // 2
        halves, bounds = [], []
        for part in (order[:cut], order[cut:]):
            bounds += [far[part[0]], far[part[-1]]]
            halves.append(self._build(rest[part]))
        self.nodes[at] = (own, *bounds, *halves)
        return at


class Search:
    """k nearest of many queries in one tree."""

    def __init__(self, tree: Tree, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int,
                 bound: np.ndarray, relax: float) -> None:
        self.tree, self.ids, self.queries, self.query_ids, self.k = tree, ids, queries, query_ids, k
        self.relax, self.bound = relax, bound
        self.near = np.full((len(queries), k), np.inf)
        self.who = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.compared = 0
        if len(ids):
            self._visit(tree.root, np.arange(len(queries)))

    def _offer(self, some: np.ndarray, rows: np.ndarray, far: np.ndarray) -> None:
        ids = np.broadcast_to(self.ids[rows], far.shape)
        self.compared += far.size
        far = np.where((ids == self.query_ids[some, None]) | (far > self.bound[some, None]), np.inf, far)
        better = far.min(axis=1) <= self.near[some, -1]
        if not better.any():
            return
        some, far, ids = some[better], far[better], ids[better]
        far = np.concatenate([self.near[some], far], axis=1)
        ids = np.concatenate([self.who[some], ids], axis=1)
        order = np.lexsort((ids, far), axis=1)[:, : self.k]
        self.near[some] = np.take_along_axis(far, order, axis=1)
        self.who[some] = np.take_along_axis(ids, order, axis=1)
        self.bound[some] = np.minimum(self.bound[some], self.near[some, -1])

    def _may(self, some: np.ndarray, far: np.ndarray, low: float, high: float) -> np.ndarray:
        least = np.maximum(np.maximum(low - far, far - high), 0.0)
        return least * self.relax <= self.bound[some] * (1 + SLACK) + SLACK

    def _visit(self, at: int, some: np.ndarray) -> None:
        node = self.tree.nodes[at]
        if len(node) == 1:
            self._offer(some, node[0], distances(self.queries[some], self.tree.vectors[node[0]]))
            return
        own, low0, high0, low1, high1, inner, outer = node
        far = distances(self.queries[some], self.tree.vectors[own][None])[:, 0]
        self._offer(some, np.array([own]), far[:, None])
        # A half is entered once, with all queries that may find something there; the one that is
        # nearer to most of them comes first and lowers their bounds for the other.
        halves = [(inner, low0, high0), (outer, low1, high1)]
        if np.count_nonzero(far - high0 < low1 - far) * 2 < len(some):
            halves.reverse()
        for half, low, high in halves:
            go = self._may(some, far, low, high)
            if go.any():
                self._visit(half, some[go])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def usable(vector: str | Column) -> Column:
    """Whether a vector takes part."""
    v = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], bool, pa.RecordBatch]]:
    """Stretches of a sorted batch that belong to one shard and one side."""
    width, shard, asked = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
    change = (np.diff(width) != 0) | (np.diff(shard) != 0) | (np.diff(asked.astype(np.int8)) != 0)
    cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(shard)]
    for low, high in zip(cuts, cuts[1:]):
        if high > low:
            yield (int(width[low]), int(shard[low])), bool(asked[low]), batch.slice(low, high - low)


def _search(seeds: dict[int, tuple[np.ndarray, np.ndarray]], k: int, relax: float, block: int):
    """Rows sorted by shard, its vectors before the queries, both by id, to the nearest of each shard."""

    def first_bounds(width: int, ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        seed_ids, seed = seeds.get(width, (np.zeros(0, np.int64), np.zeros((0, width))))
        if len(seed) <= k:
            return np.full(len(ids), np.inf)
        far = distances(vectors, seed)
        far[seed_ids[None, :] == ids[:, None]] = np.inf
        return np.sort(far, axis=1)[:, k - 1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, own, tree, at = None, [], None, None, 0
        # Queries come in the same order in every shard, so a bound is found by its number.
        carried: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, asked, part in _runs(batch):
                width = key[0]
                if key != now:
                    now, parts, own, tree, at = key, [], None, None, 0
                ids, vectors = part.column(3).to_numpy(), _matrix(part.column(4), width)
                if not asked:
                    parts.append((ids, vectors))
                    continue
                if tree is None and parts:
                    own = np.concatenate([i for i, _ in parts])
                    tree, parts = Tree(np.concatenate([v for _, v in parts])), []
                bounds = carried.get(width, np.zeros(0))
                if at + len(ids) > len(bounds):
                    new = slice(len(bounds) - at, None)
                    bounds = np.concatenate([bounds, first_bounds(width, ids[new], vectors[new])])
                    carried[width] = bounds
                for low in range(0, len(ids) if tree else 0, block):
                    some = slice(low, low + block)
                    place = slice(at + low, at + low + len(ids[some]))
                    found = Search(tree, own, vectors[some], ids[some], k, bounds[place].copy(), relax)
                    bounds[place] = found.bound
                    real = np.isfinite(found.near)
                    if real.any():
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.repeat(ids[some], k)[real.ravel()]), pa.array(found.who[real]),
                                pa.array(found.near[real]),
                            ],
                            names=["query_id", "vec_id", "score"],
                        )
                at += len(ids)

    return work


def nearest(
    table: DataFrame, k: int = 10, every: int = 100, vec_id: str = "vec_id", vector: str = "embedding",
    relax: float = RELAX, shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found of every row whose id is divisible by `every`."""
    plain = table.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    ).where(F.col("vec_id").isNotNull() & usable("vector"))
    once = plain.groupBy("vec_id", F.size("vector").alias("width")).agg(F.min("vector").alias("vector"))
    rows = written(once, "vectors")
    shards = max(1, -(-rows.count() // shard))
    queries = rows.where(F.col("vec_id") % every == 0)
    chosen = queries.groupBy("vec_id").agg(F.min(F.struct("vector", "width")).alias("v")).select(
        "vec_id", "v.vector", "v.width"
    )
    # One pass over the ids with a bounded heap; the sample is as large for any table.
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SEED_ROWS).select("vec_id", "vector").collect()
    seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for width in {len(r.vector) for r in sample}:
        own = {r.vec_id: r.vector for r in sample if len(r.vector) == width}
        seeds[width] = (np.array(list(own)), np.array(list(own.values()), dtype=np.float64))

    held = rows.select(
        "width", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"), F.lit(False).alias("asked"), "vec_id", "vector"
    )
    sent = chosen.select(
        "width", F.explode(F.expr(f"sequence(0L, {shards - 1}L)")).alias("shard"), F.lit(True).alias("asked"), "vec_id", "vector"
    )
    tasks = min(shards, MOST_TASKS)
    dealt = held.union(sent).repartitionById(tasks, F.pmod("shard", F.lit(tasks)).cast("int"))
    ordered = dealt.sortWithinPartitions("width", "shard", "asked", "vec_id")
    partial = ordered.mapInArrow(_search(seeds, k, relax, block), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
