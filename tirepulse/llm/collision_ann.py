"""Approximate nearest neighbours by collision-counting hashing.

Each of ``lines`` random projections keeps one sorted array of the vectors'
values. A query's window on a line is centred at the query's own value; virtual
rehashing widens the windows by a factor at a time over the same arrays, so
there are no buckets to rebuild. Only the vectors that a window newly reaches, on
either side, are counted in a round. A vector that was met on at least
``threshold`` of the lines is a candidate; windows stop widening when a query
has 10 ``k`` and a share ``verified`` of the block's vectors as candidates, and
only these are compared with it exactly. This holds for blocks of any size.

The measure is the inner product. Every vector gets one more component that
brings it to the largest norm, which turns nearest by distance into largest by
inner product for any query; the lines project the longer vectors, scores use
the original ones.

Vectors are dealt to blocks by a hash of their id, and queries to chunks; a
task handles one block against one chunk, both of bounded size. The best of
each block are merged. Every vector is indexed, every block is asked. For the
lines, all components are divided by the table's largest one, so that
their squares neither overflow nor vanish together.

Edge cases: vectors that are null, empty or zero, or hold a null or a
non-finite component, take no part, nor do rows without vec_id; shorter
vectors count as padded with zeros; rows that repeat a vec_id count once, with
the smallest of their vectors; ties go to the smaller vec_id; a query gets all
other vectors if they are fewer than ``k``; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tirepulse.llm.ship import shipped


@dataclass(frozen=True)
class CollisionParams:
    k: int = 20
    lines: int = 64
    threshold: float = 0.6            # share of the lines on which a candidate collides
    verified: float = 0.25           # share of a block's vectors that is compared exactly, beside 10 k of them
    first_width: float = 0.65         # half of the first window, in standard deviations of the projections
    widen: float = 1.08
    block_rows: int = 16384
    chunk_rows: int = 32768
    seed: int = 11


class BlockIndex:
    """Sorted projections of one block of vectors; ``longest`` and ``peak`` are the largest
    norm and component of the whole table, the norm that of components divided by ``peak``."""

    def __init__(self, vectors: np.ndarray, longest: float, params: CollisionParams, peak: float = 1.0):
        self.params, self.vectors, self.longest, self.peak = params, vectors, longest, peak
        self.lines = np.random.default_rng(params.seed).standard_normal((vectors.shape[1] + 1, params.lines))
        own = vectors / peak
        gap = np.sqrt(np.maximum(longest ** 2 - (own ** 2).sum(axis=1), 0))
        values = own @ self.lines[:-1] + gap[:, None] * self.lines[-1]
        self.order = np.ascontiguousarray(np.argsort(values, axis=0, kind="stable").T)       # rows by value, a line each
        self.values = np.ascontiguousarray(np.take_along_axis(values, self.order.T, axis=0).T)

    def _centres(self, queries: np.ndarray) -> np.ndarray:
        """Values of the queries on the lines, brought to the largest norm."""
        own = queries / np.abs(queries).max(axis=1, keepdims=True)
        return (own * (self.longest / np.sqrt((own ** 2).sum(axis=1)))[:, None]) @ self.lines[:-1]

    def candidates(self, queries: np.ndarray):
        """Yields (query, candidate rows) of each query."""
        for lo in range(0, queries.shape[0], 1024):
            for q, rows in self._some_candidates(queries[lo:lo + 1024]):
                yield lo + q, rows

    def _some_candidates(self, queries: np.ndarray):
        p, n = self.params, self.vectors.shape[0]
        need = min(n, 10 * p.k + int(p.verified * n))
        least = max(1, int(np.ceil(p.threshold * p.lines)))
        centre = self._centres(queries)
        half = p.first_width * (float(np.std(self.values)) or 1.0)
        waiting = np.arange(queries.shape[0])
        met = np.zeros((queries.shape[0], n), np.uint8 if p.lines < 256 else np.uint16)
        low = high = None
        while waiting.size:
            edges = [np.stack([np.searchsorted(v, c + edge, side=side) for v, c in zip(self.values, centre[waiting].T)])
                     for edge, side in ((-half, "left"), (half, "right"))]
            start = [edges[0], edges[0]] if low is None else [low, high]                     # nothing reached so far
            again = []
            for i, q in enumerate(waiting.tolist()):
                a, b = edges[0][:, i].tolist(), edges[1][:, i].tolist()
                was, till = start[0][:, i].tolist(), start[1][:, i].tolist()
                fresh = np.concatenate([part for line, x, y, u, v in zip(self.order, a, b, was, till)
                                        for part in (line[x:u], line[v:y])])
                met[q] += np.bincount(fresh, minlength=n).astype(met.dtype)
                rows = np.flatnonzero(met[q] >= least)
                if rows.size >= need or fresh.size == 0 and not any(a) and min(b) == n:
                    yield q, rows
                else:
                    again.append(i)
            low, high = edges[0][:, again], edges[1][:, again]
            waiting = waiting[again]
            half *= p.widen

    def search(self, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray):
        """(query id, vector id, score) of the best ``k`` candidates of each query."""
        out = []
        for q, rows in self.candidates(queries):
            rows = rows[ids[rows] != query_ids[q]]
            near = np.einsum("ij,j->i", self.vectors[rows], queries[q])
            if rows.size > 2 * self.params.k:          # those that can be among the best whatever the order of summation
                cut = np.partition(near, -2 * self.params.k)[-2 * self.params.k]
                rows = rows[near >= cut - 1e-9 * np.abs(near).max()]
            score = (self.vectors[rows] * queries[q]).sum(axis=1)
            best = np.lexsort((ids[rows], -score))[:self.params.k]
            out.append((np.full(best.size, query_ids[q]), ids[rows[best]], score[best]))
        return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    lists = column.combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    bounds = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy(zero_copy_only=False)[bounds[0]:bounds[-1]]
    out = np.zeros((len(lists), dim))
    size = np.diff(bounds)
    row = np.repeat(np.arange(size.size), size)
    out[row, np.arange(values.size) - np.repeat(bounds[:-1] - bounds[0], size)] = values
    return out


def _vectors(table: DataFrame, column: str) -> DataFrame:
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (table.filter(F.col("vec_id").isNotNull() & F.col(column).isNotNull() & fine & F.exists(column, lambda x: x != 0))
            .groupBy("vec_id").agg(F.min(F.col(column).cast("array<double>")).alias("vector")))


def nearest(table: DataFrame, queries: Column, column: str = "embedding",
            params: CollisionParams = CollisionParams()) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest vectors found for each row where ``queries`` holds."""
    shipped(table.sparkSession)
    vectors = _vectors(table, column)
    asked = vectors.filter(queries)
    n, dim, peak = vectors.agg(F.count(F.lit(1)), F.max(F.size("vector")),
                               F.max(F.array_max(F.transform("vector", F.abs)))).first()
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x / F.lit(peak)) * (x / F.lit(peak)))
    longest = vectors.agg(F.sqrt(F.max(square))).first()[0]
    n_asked = asked.count()
    blocks, chunks = max(1, -(-n // params.block_rows)), max(1, -(-n_asked // params.chunk_rows))
    dealt = lambda parts, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    stored = vectors.select(dealt(blocks, 1).alias("block"), every(chunks).alias("chunk"), F.lit(False).alias("asks"), "vec_id", "vector")
    asking = asked.select(every(blocks).alias("block"), dealt(chunks, 2).alias("chunk"), F.lit(True).alias("asks"), "vec_id", "vector")

    def answer(cell: pa.Table) -> pa.Table:
        asks = cell["asks"].to_numpy()
        ids, matrix = cell["vec_id"].to_numpy(), _matrix(cell["vector"], dim)
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if asks.any() and not asks.all():
            order = np.argsort(ids[~asks], kind="stable")
            index = BlockIndex(matrix[~asks][order], longest, params, peak)
            found = index.search(ids[~asks][order], matrix[asks], ids[asks])
        return pa.table({"query_id": found[0], "vec_id": found[1], "score": found[2]})

    best = (stored.union(asking).groupBy("block", "chunk")
            .applyInArrow(answer, "query_id long, vec_id long, score double"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (best.withColumn("rank", rank).filter(F.col("rank") <= params.k)
            .select("query_id", "rank", "vec_id", "score"))
