"""Nearest neighbours by inner product through collision counting.

Every vector is projected on ``projections`` random directions; a block of vectors keeps,
for each direction, one array of its projections in order.  A query opens a window centred on
its own projection in every array and widens all of them round by round (virtual rehashing:
a wider window merges neighbouring buckets, no array is rebuilt).  A vector that has been in
the windows of at least ``threshold`` of the directions is verified with its exact score.
The widening ends for a query once a vector as near as its k-th best so far would have been
counted often enough with probability ``certainty``; if no such end comes, all are verified.

Inner products become distances by scaling all vectors to at most unit length and adding the
coordinate that completes it; a query is scaled to unit length, with 0 for that coordinate.

All rows are indexed.  Blocks of vectors (by hash of id and vector) meet blocks of queries,
each pair in its own task of bounded size; the k best of each block are merged.  Vectors
that are null, zero or hold null or non-finite components take no part, nor do those of
another length than most rows have, nor null ids.  A row is never its own neighbour: rows
with the query's id are passed over.  Rows that repeat an id are candidates each.
"""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.session import ship_package

#: Vectors of a block and queries of a block.
BLOCK = 1 << 14
QUERIES = 1 << 10
PROJECTIONS = 64
THRESHOLD = 0.55
CERTAINTY = 0.9
#: Half width of the first windows, in units of the unit sphere, and their growth.
FIRST, GROWTH = 0.8, 1.3
#: More than single precision can be off, of products of unit vectors.
_ROUGH = 1e-5

_NORMAL = NormalDist()


def _directions(dim: int, n: int, seed: int) -> np.ndarray:
    """n directions in orthonormal groups: fewer repeated views than independent ones."""
    rng = np.random.default_rng(seed)
    groups = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-n // dim))]
    return np.concatenate(groups, axis=1)[:, :n].T * math.sqrt(dim)


class Block:
    """The sorted projections of some vectors, and each vector's place in every one."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, projections: int, seed: int) -> None:
        self.ids, self.vectors, self.longest = ids, vectors, longest
        unit = vectors / longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(axis=1)))
        self.rough = unit.astype(np.float32)
        self.directions = _directions(vectors.shape[1] + 1, projections, seed)
        projected = self.directions @ np.column_stack([unit, rest]).T
        order = np.argsort(projected, axis=1)
        # all arrays behind one another, each shifted beyond the one before it
        self.shift = np.arange(projections) * (4.0 * math.sqrt(vectors.shape[1] + 1) + 1.0)
        self.sorted = (np.take_along_axis(projected, order, axis=1) + self.shift[:, None]).reshape(-1)
        self.place = np.empty(order.shape, dtype=np.uint16 if len(ids) < 1 << 16 else np.uint32)
        np.put_along_axis(self.place, order, np.arange(len(ids), dtype=self.place.dtype)[None, :], axis=1)
        self.begin = np.arange(projections) * len(ids)
        self.room = np.empty_like(self.place), np.empty(order.shape, dtype=bool)

    def collisions(self, centre: np.ndarray, width: float) -> tuple[np.ndarray, bool]:
        """In how many arrays each vector lies in the window around the centre; whether the
        windows are the whole arrays."""
        kind, n = self.place.dtype, len(self.ids)
        low = np.clip(self.sorted.searchsorted(self.shift + centre - width) - self.begin, 0, n)
        high = np.clip(self.sorted.searchsorted(self.shift + centre + width, side="right") - self.begin, 0, n)
        # places from low to before high, as one comparison of unsigned numbers
        away, inside = self.room
        np.subtract(self.place, low.astype(kind)[:, None], out=away)
        np.less(away, (high - low).astype(kind)[:, None], out=inside)
        counts = inside.view(np.uint8).sum(axis=0, dtype=np.uint16 if len(low) > 255 else np.uint8)
        return counts, bool((high - low == n).all())

    def verify(self, at: np.ndarray, query: np.ndarray, k: int, bar: float) -> tuple[np.ndarray, np.ndarray]:
        """Those of the vectors ``at`` that can be among the k best with at least the score
        ``bar``, ties included, and their inner products in double precision, each summed in
        the same order.  Single precision on the unit scale leaves out what can't."""
        scale = self.longest * float(np.linalg.norm(query))
        rough = self.rough[at] @ (query / np.linalg.norm(query)).astype(np.float32)
        bar = max(bar / scale, float(np.partition(rough, -k)[-k]) if len(at) > k else -np.inf)
        at = at[rough >= bar - _ROUGH]
        return at, (self.vectors[at] * query).sum(axis=1)

    def search(self, query: np.ndarray, own: int, k: int, threshold: int, certainty: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of up to k nearest found, best first, ties to the smaller id."""
        length = float(np.linalg.norm(query))
        centre = self.directions @ np.append(query / length, 0.0)
        surely = _ratio(len(centre), threshold, certainty)
        seen = self.ids == own
        ids, scores = np.zeros(0, dtype=np.int64), np.zeros(0)
        width = FIRST
        while True:
            counts, everything = self.collisions(centre, width)
            fresh = np.flatnonzero(~seen if everything else (counts >= threshold) & ~seen)
            if len(fresh):
                seen[fresh] = True
                fresh, score = self.verify(fresh, query, k, scores[-1] if len(ids) == k else -np.inf)
                ids, scores = np.concatenate([ids, self.ids[fresh]]), np.concatenate([scores, score])
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
            if everything:
                return ids, scores
            wider = width * GROWTH
            if len(ids) == k:
                # the radius of the k-th best asks for windows of this width
                needed = surely * math.sqrt(max(0.0, 2.0 - 2.0 * scores[-1] / (self.longest * length)))
                if width >= needed:
                    return ids, scores
                wider = min(wider, needed)
            width = wider


@lru_cache(maxsize=64)
def _ratio(m: int, threshold: int, certainty: float) -> float:
    """Width over distance at which a vector lies in ``threshold`` of m windows with
    probability ``certainty``: projections differ normally, with the distance as spread."""
    z, low, high = _NORMAL.inv_cdf(certainty), threshold / m, 1.0
    for _ in range(60):
        p = (low + high) / 2
        low, high = (low, p) if p * m - z * math.sqrt(m * p * (1 - p)) >= threshold else (p, high)
    return _NORMAL.inv_cdf((min(high, 1 - 1e-12) + 1) / 2)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, all components finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1)


def search(data: DataFrame, queries: DataFrame, *, id: str = "vec_id", vector: str = "embedding", k: int = 20,
           projections: int = PROJECTIONS, threshold: float = THRESHOLD, certainty: float = CERTAINTY, seed: int = 42,
           block: int = BLOCK, query_block: int = QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k nearest of each row of ``queries``
    among ``data``, both with ``id`` and ``vector`` columns.  Equal queries (id and vector)
    are searched once; other rows that share an id are ranked together."""
    def clean(df: DataFrame) -> DataFrame:
        v = F.col(f"`{vector}`").cast("array<double>")
        return df.select(F.col(f"`{id}`").cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))

    rows, asked = clean(data), clean(queries).distinct()
    by_size = (rows.groupBy(F.size("v").alias("dim")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("sq"))
        .orderBy(F.desc("n"), "dim").limit(1).first())
    schema = "query_id long, vec_id long, score double"
    if by_size is None:
        return data.sparkSession.createDataFrame([], schema).select("query_id", F.lit(0).alias("rank"), "vec_id", "score")
    dim, n, longest = by_size["dim"], by_size["n"], math.sqrt(by_size["sq"])
    n_queries = asked.where(F.size("v") == dim).count()
    blocks, groups = -(-n // block), max(1, -(-n_queries // query_block))
    least = min(max(1, math.ceil(threshold * projections)), projections)

    def part(df: DataFrame, own: str, count: int, other: str, times: int) -> DataFrame:
        return (df.where(F.size("v") == dim).withColumn(own, F.pmod(F.xxhash64("id", "v"), F.lit(count)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(times - 1)))))

    def work(_key, left: pa.Table, right: pa.Table) -> pa.Table:
        found = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0)]
        if len(left) and len(right):
            left = left.combine_chunks()
            index = Block(np.asarray(left["id"]), _matrix(left["v"].combine_chunks()), longest, projections, seed)
            for q, v in zip(np.asarray(right["id"]).tolist(), _matrix(right["v"].combine_chunks()), strict=True):
                ids, scores = index.search(v, q, k, least, certainty)
                for out, x in zip(found, (np.full(len(ids), q), ids, scores), strict=True):
                    out.append(x)
        return pa.table({c: np.concatenate(x) for c, x in zip(("query_id", "vec_id", "score"), found, strict=True)})

    ship_package(data.sparkSession)
    near = (part(rows, "b", blocks, "g", groups).groupBy("b", "g").cogroup(part(asked, "g", groups, "b", blocks).groupBy("b", "g"))
            .applyInArrow(work, schema))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
