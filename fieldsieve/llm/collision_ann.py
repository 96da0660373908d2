"""Approximate nearest neighbours by collision counting over single projections.

Every vector is projected on random lines, and each line's projections are kept as a sorted array.
Around a query's own projection a window of half-width ``radius * width / 2`` is laid on every
line; a vector inside the windows of enough lines (the collision threshold) is verified by its
exact distance. If too few vectors near enough have been found, the radius grows by ``ratio`` and
the windows are widened to both sides: the virtual rehashing, which only looks at what the wider
window adds.

The table is dealt into blocks of bounded size, each with its own sorted arrays, and the queries
into blocks as well; a task searches one block for one block of queries. The best of the blocks
are merged per query, so a block is only ever asked for its own nearest vectors.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SearchSettings:
    """``lines`` projections; a vector is verified once it lies in ``threshold`` of the windows
    (a share of the lines). ``width`` is the window at radius 1, in standard deviations of the
    block's projections; ``ratio`` is the growth of the radius. A query stops when ``k`` verified
    vectors are nearer than the radius reached stands for, ``near`` of the block's median distance
    per radius, or when ``verified`` of the block, at least ``k``, has been verified."""

    lines: int = 48
    threshold: float = 0.56
    width: float = 1.0
    ratio: float = 1.25
    verified: float = 0.35
    block: int = 16384
    query_block: int = 512
    seed: int = 7


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite and not all zero."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


class BlockIndex:
    """Sorted projections of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, s: SearchSettings):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.settings = ids[order], vectors[order], s
        rng = np.random.default_rng(s.seed)
        lines = rng.standard_normal((vectors.shape[1], s.lines))
        self.lines = lines / np.linalg.norm(lines, axis=0)
        values = self.vectors @ self.lines
        self.order = np.argsort(values, axis=0, kind="stable").T.astype(np.int32)
        self.sorted = np.sort(values, axis=0).T.copy()
        spread = float(values.std()) if len(ids) > 1 else 0.0
        self.width = s.width * (spread or 1.0)

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the ``k`` nearest found, nearest first, ties to the smaller id."""
        s, n = self.settings, len(self.ids)
        need = max(1, math.ceil(s.threshold * s.lines))
        enough = max(k + 1, math.ceil(s.verified * n))
        at = query @ self.lines
        low = np.array([np.searchsorted(v, x) for v, x in zip(self.sorted, at, strict=True)])
        high = low.copy()
        counts = np.zeros(n, dtype=np.int16)
        distance = np.full(n, np.inf)
        known = np.zeros(n, dtype=bool)
        radius = 1.0
        while True:
            half = radius * self.width / 2
            for j, (line, order) in enumerate(zip(self.sorted, self.order, strict=True)):
                lo = np.searchsorted(line, at[j] - half, side="left")
                hi = np.searchsorted(line, at[j] + half, side="right")
                if lo < low[j]:
                    counts[order[lo : low[j]]] += 1
                    low[j] = lo
                if hi > high[j]:
                    counts[order[high[j] : hi]] += 1
                    high[j] = hi
            new = np.flatnonzero((counts >= need) & ~known)
            if len(new):
                known[new] = True
                distance[new] = np.sqrt(((self.vectors[new] - query) ** 2).sum(axis=1))
            found = int(known.sum())
            if found == n or found >= enough:
                break
            # A vector this near falls into a window with a high enough chance to have been met.
            sure = half / self._reach
            if found > k and np.partition(distance[known], k)[k] <= sure:
                break
            if (low == 0).all() and (high == n).all():
                break
            radius *= s.ratio
        candidates = np.flatnonzero(known & (self.ids != query_id))
        best = candidates[np.lexsort((self.ids[candidates], distance[candidates]))][:k]
        return self.ids[best], distance[best]

    @property
    def _reach(self) -> float:
        """Standard deviations a window must cover to hold ``threshold`` of the lines, surely.

        The projections of two vectors at distance d differ by d / sqrt(dim) in standard
        deviation; within 1.5 of it lie 87 in 100 lines.
        """
        return 1.5 / math.sqrt(self.vectors.shape[1])


def _searcher(k: int, s: SearchSettings) -> Callable:
    def search(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(data) and len(queries):
            for length, same in data.groupby(data["vector"].map(len)):
                ids = same["vec_id"].to_numpy(np.int64)
                index = BlockIndex(ids, np.stack(same["vector"].to_list()).astype(np.float64), s)
                for query_id, query in zip(queries["vec_id"], queries["vector"], strict=True):
                    if len(query) == length:
                        near, score = index.search(query_id, np.asarray(query, np.float64), k)
                        found.append(
                            pd.DataFrame({"query_id": query_id, "vec_id": near, "score": score})
                        )
        if not found:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"}
            )
        return pd.concat(found, ignore_index=True)

    return search


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    settings: SearchSettings = SearchSettings(),
) -> DataFrame:
    """The ``k`` nearest vectors found for each query: query_id, rank (from 1), vec_id, score.

    Both tables have ``vec_id`` and ``vector`` (array of numbers); other columns are not read.
    Score is the Euclidean distance in double precision. Rows with a null id and vectors that are
    null, empty, zero or hold null or non-finite components take no part, nor does the row with
    the query's own id. Vectors of different length are never compared. Rows with equal id and
    vector count once. Ties go to the smaller id; fewer candidates give fewer rows, empty tables
    none.
    """
    def clean(df: DataFrame) -> DataFrame:
        vector = F.col("vector").cast("array<double>")
        kept = df.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
        return kept.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))

    every_row, every_query = clean(vectors), clean(queries)
    # Repeats go before blocks are dealt: they would fill a block's places for its nearest.
    data, asked = (df.dropDuplicates(["vec_id", "vector"]) for df in (every_row, every_query))
    # Counted with repeats, without a shuffle: blocks are smaller at most.
    n_blocks = max(1, math.ceil(every_row.count() / settings.block))
    n_asked = max(1, math.ceil(every_query.count() / settings.query_block))
    dealt = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = data.withColumn("block", dealt(n_blocks, 1)).withColumn("asked", every(n_asked))
    right = asked.withColumn("asked", dealt(n_asked, 2)).withColumn("block", every(n_blocks))
    found = (
        left.groupBy("block", "asked")
        .cogroup(right.groupBy("block", "asked"))
        .applyInPandas(_searcher(k, settings), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.distinct()
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def exact_nearest(ids: np.ndarray, vectors: np.ndarray, query_ids: Iterator[int], k: int) -> dict:
    """Brute force for tests: the ids of the ``k`` nearest of each query."""
    place = {int(v): i for i, v in enumerate(ids)}
    out = {}
    for q in query_ids:
        d = np.sqrt(((vectors - vectors[place[int(q)]]) ** 2).sum(axis=1))
        rest = np.flatnonzero(ids != q)
        out[int(q)] = ids[rest[np.lexsort((ids[rest], d[rest]))][:k]].tolist()
    return out
