"""Approximate nearest neighbours by collision counting over single-projection sorted arrays."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import stored

#: Numbers of a block's vectors, and queries of a part.
BLOCK, PART = 1 << 20, 50_000
PROJECTIONS = 128
#: Windows at radius 1 reach this far to either side. A vector at distance 1 of the query then falls into a window with
#: probability 0.77, and it has to do so in 0.72 of the projections, over a standard deviation less; one at distance 1.3
#: does so in 0.65 of them.
HALF_WINDOW, THRESHOLD, GROWTH, FIRST_RADIUS = 1.21, 0.72, 1.25, 0.3


class Block:
    """An index over a bounded block of vectors: for each random projection the sorted values of all its vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int = 0):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.directions = np.random.default_rng([seed, vectors.shape[1]]).standard_normal((vectors.shape[1], PROJECTIONS))
        values = (self.vectors / self.norms[:, None]) @ self.directions
        places = np.argsort(values, axis=0, kind="stable")
        self.places = [np.ascontiguousarray(p, np.int32) for p in places.T]
        self.compared = 0
        self.sorted = [np.ascontiguousarray(v) for v in np.take_along_axis(values, places, 0).T]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, within: np.ndarray | None = None) -> Iterator[tuple[int, int, float]]:
        """`query id, vector id, cosine` of the best k found for each query, its own identifier left out.

        Virtual rehashing: the windows around a query's projections grow with the radius, and only what they newly reach
        is counted. Vectors whose count passes the threshold are compared themselves. A query is done when its k-th best
        is within the radius, or all vectors have been compared. `within`: a radius for each query that holds k others
        already; its windows open at once to that, and no further. `self.compared` counts the vectors compared.
        """
        n, least = len(self.ids), math.ceil(THRESHOLD * PROJECTIONS)
        norms = np.sqrt((queries * queries).sum(axis=1))
        centres = (queries / norms[:, None]) @ self.directions
        alive = np.arange(len(queries))
        counts = np.zeros((len(queries), n), np.int16)
        compared = np.zeros((len(queries), n), bool)
        best_s = [np.empty(0)] * len(queries)
        best_i = [np.empty(0, np.int64)] * len(queries)
        low = np.stack([np.searchsorted(s, centres[:, j]) for j, s in enumerate(self.sorted)], 1)
        high, radius = low.copy(), FIRST_RADIUS
        while len(alive):
            reach = HALF_WINDOW * (radius if within is None else within)
            new_low = np.stack(
                [np.searchsorted(s, centres[alive, j] - reach, "left") for j, s in enumerate(self.sorted)], 1
            )
            new_high = np.stack(
                [np.searchsorted(s, centres[alive, j] + reach, "right") for j, s in enumerate(self.sorted)], 1
            )
            on = np.ones(len(alive), bool)
            for a, q in enumerate(alive.tolist()):
                reached = [p[x:y] for p, x, y in zip(self.places, new_low[a].tolist(), low[q].tolist())]
                reached += [p[x:y] for p, x, y in zip(self.places, high[q].tolist(), new_high[a].tolist())]
                low[q], high[q] = np.minimum(low[q], new_low[a]), np.maximum(high[q], new_high[a])
                counts[q] += np.bincount(np.concatenate(reached), minlength=n).astype(np.int16)
                fresh = np.flatnonzero((counts[q] >= least) & ~compared[q])
                self.compared += len(fresh)
                if len(fresh):
                    compared[q, fresh] = True
                    other = fresh[self.ids[fresh] != query_ids[q]]
                    cosines = (self.vectors[other] * queries[q]).sum(axis=1) / (self.norms[other] * norms[q])
                    scores, found = np.concatenate((best_s[q], cosines)), np.concatenate((best_i[q], self.ids[other]))
                    top = np.lexsort((found, -scores))[:k]
                    best_s[q], best_i[q] = scores[top], found[top]
                near = len(best_s[q]) == k and 2 - 2 * best_s[q][-1] <= radius * radius
                on[a] = within is None and not near and not compared[q].all()
            alive, radius = alive[on], radius * GROWTH
        for q, i in enumerate(query_ids.tolist()):
            yield from ((i, int(v), float(s)) for s, v in zip(best_s[q], best_i[q]))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """`id, dim, vector` (doubles) of the rows that take part: an identifier, a vector that is not null, empty or zero,
    and no component that is null or not finite. Of rows that repeat an identifier, the smallest vector takes part."""
    v = F.col("vector")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0))
    return rows.groupBy("id").agg(F.min("vector").alias("vector")).select("id", F.size("vector").alias("dim"), "vector")


def neighbours(
    vectors: DataFrame, queries=None, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK
) -> DataFrame:
    """The k nearest of each query by cosine: `query_id, rank` (from 1)`, vec_id, score`, nearest first, ties to the
    smaller identifier.

    Every usable row is indexed, in blocks of about `block` numbers, each with its own sorted arrays. A query first
    searches the block it lies in: the distance of its k-th best there bounds how far it has to look. It then meets the
    other blocks with windows of just that radius, so few of their vectors are compared. Each meeting gives at most k rows,
    so a task holds one block and a batch of queries, whatever the sizes. Many queries are dealt in parts. Vectors of
    another length than the query's are no candidates. Fewer than k candidates: all found are returned.

    queries: a condition on the column `id`; rows that meet it are the queries.
    """
    rows = stored(usable(vectors, id_col, vector_col))
    sizes = rows.agg(F.coalesce(F.sum("dim"), F.lit(0)).alias("numbers")).first()
    condition = (F.col("id") % 50 == 0) if queries is None else queries
    blocks = max(1, -(-sizes.numbers // block))
    parts = max(1, -(-rows.filter(condition).count() // PART))
    data = rows.select("dim", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), "id", "vector")
    lots = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).cast("int").alias("part")
    every = data.select("dim", "block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("kind"), F.lit(0.0).alias("within"), "id", "vector")
    own = data.filter(condition).select("dim", "block", lots, F.lit(1).alias("kind"), F.lit(-1.0).alias("within"), "id", "vector")
    first = _met(every.union(own), k)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).alias("rank")
    ranked = ["query_id", rank, "vec_id", "score"]
    if blocks == 1:
        return first.select(*ranked).filter(F.col("rank") <= k)
    first = stored(first)
    # the chord to the k-th best; one that has fewer than k looks everywhere
    bound = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.min("score")))).otherwise(2.0).alias("bound"))
    asks = data.filter(condition).join(bound, F.col("id") == F.col("query_id"), "left").select(
        "dim", F.col("block").alias("home"), lots, F.lit(1).alias("kind"), F.coalesce("bound", F.lit(2.0)).alias("within"), "id", "vector"
    )
    asks = asks.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).filter("block != home")
    others = _met(every.union(asks.select(*every.columns)), k)
    return first.union(others).select(*ranked).filter(F.col("rank") <= k)


def _met(rows: DataFrame, k: int) -> DataFrame:
    """What queries (kind 1) find among the vectors (kind 0) of their block and part."""
    keys = ["dim", "block", "part"]
    met = rows.repartition(*keys).sortWithinPartitions(*keys, "kind")
    return met.mapInArrow(_search(k), "query_id long, vec_id long, score double")


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, index = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in range(4)], 1)
            cuts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1 if len(keys) else []
            for a, b in zip([0, *cuts], [*cuts, len(keys)]):
                if a == b:
                    continue
                key, kind = tuple(keys[a, :3].tolist()), int(keys[a, 3])
                if key != current:
                    current, held, index = key, [], None
                part = batch.slice(a, b - a)
                within, ids = part.column(4).to_numpy(), part.column(5).to_numpy()
                flat = part.column(6).flatten().to_numpy().reshape(b - a, key[0])
                if kind == 0:
                    held.append((ids, flat))
                elif held:
                    index = index or Block(np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held]))
                    for at in range(0, len(ids), 256):
                        some = slice(at, at + 256)
                        radius = None if within[at] < 0 else within[some]
                        found = list(index.search(ids[some], flat[some], k, radius))
                        q, v, s = zip(*found) if found else ((), (), ())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())],
                            ["query_id", "vec_id", "score"],
                        )

    return run
