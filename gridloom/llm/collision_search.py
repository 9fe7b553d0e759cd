"""Nearest neighbours by inner product, with collision-counting hashing.

Vectors are scaled by the largest norm and get one more component that makes
them unit vectors, so the largest inner product with a query is the least
distance to the scaled query. An index holds ``PROJECTIONS`` sorted arrays, one
per direction. A window around the query's projection in every array holds what
collides with it; a vector that collides in ``THRESHOLD`` arrays or more is a
candidate, and its inner product is computed exactly. Windows are half-width
times radius wide, and radii are the levels of one geometric sequence: going to
the next level is a rehashing that touches no array. A vector within the radius
collides in one array with probability 0.8 at least, so the threshold loses it
with probability ``MISS`` at most, whatever the data look like.

Rows are dealt to blocks by a hash of their id, and every block has an index of
its own, so counts never leave a task. The first block is searched from a small
radius that grows until the 20 nearest lie within it. The blocks that follow are
searched in waves, each of four times as many blocks as all before it: the
20th best score so far fixes the radius, and only rows that reach it are
returned. So radii shrink as more rows are seen, and a query returns some 60
rows for every fourfold growth of the table. Blocks and query blocks are
bounded; the number of their pairs grows with rows times queries, as the query
set is a fixed share of the rows.

Defined results: vectors that are null, empty, zero or hold a null or non-finite
component take no part, nor do rows without an id; of the rows of one id the
least vector counts; vectors of different lengths never meet; ties go to the
smaller id; a query with fewer candidates gets them all; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.session import materialize

NEAREST = 20
#: Rows whose id is divisible by this are the queries.
QUERY_EVERY = 20
PROJECTIONS = 128
#: Half-width of a window at radius 1: a normal variable lies within it with probability COLLIDE.
HALF_WIDTH, COLLIDE = 1.2815515655446004, 0.8
#: Chance that the threshold loses a vector at the radius.
MISS = 0.07
#: Radii are LEAST * GROWTH**i; beyond 2, the largest distance of unit vectors, a window holds everything.
LEAST, GROWTH, MOST = 1e-3, 1.03, 2.0
#: Rows of an index block, and queries that one task searches in it.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 1024
#: Rows of a block whose distances choose the level to begin with.
PILOT = 256
_SEED = 20240517


def threshold(projections: int = PROJECTIONS) -> int:
    """The largest number of collisions that a vector at the radius reaches with probability 1 - MISS or more."""
    below = 0.0
    for hits in range(projections + 1):
        below += math.comb(projections, hits) * COLLIDE ** hits * (1 - COLLIDE) ** (projections - hits)
        if below > MISS:
            return hits
    return projections


THRESHOLD = threshold()


def level(radius: np.ndarray) -> np.ndarray:
    """Index of the first level that is no smaller than each radius."""
    return np.ceil(np.log(np.maximum(radius, LEAST) / LEAST) / math.log(GROWTH) - 1e-9).astype(int)


def level_radius(index: np.ndarray) -> np.ndarray:
    radius = LEAST * GROWTH ** np.asarray(index, float)
    return np.where(radius >= MOST, np.inf, radius)


def directions(dim: int, count: int = PROJECTIONS) -> np.ndarray:
    """Random directions of length sqrt(dim), orthogonal in sets of up to dim."""
    rng, sets = np.random.default_rng(_SEED), []
    while sum(s.shape[1] for s in sets) < count:
        sets.append(np.linalg.qr(rng.standard_normal((dim, dim)))[0])
    return np.concatenate(sets, axis=1)[:, :count] * math.sqrt(dim)


class Index:
    """Sorted arrays of the projections of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, scale: float):
        self.ids, self.vectors, self.scale = ids, vectors, scale
        unit = vectors / scale
        self.lift = np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(axis=1)))
        self.axes = directions(vectors.shape[1] + 1)
        projected = (unit @ self.axes[:-1] + self.lift[:, None] * self.axes[-1]).T
        self.order = np.argsort(projected, axis=1, kind="stable")
        self.sorted = np.take_along_axis(projected, self.order, axis=1)

    def project(self, queries: np.ndarray, norms: np.ndarray) -> np.ndarray:
        return (queries / norms[:, None]) @ self.axes[:-1]

    def windows(self, projected: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of each query's window in every array."""
        half = HALF_WIDTH * radius + 1e-9
        low, high = (np.empty((len(radius), len(self.sorted)), np.int64) for _ in range(2))
        for j, values in enumerate(self.sorted):
            low[:, j] = np.searchsorted(values, projected[:, j] - half, "left")
            high[:, j] = np.searchsorted(values, projected[:, j] + half, "right")
        return low, high

    def colliding(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Rows that lie in the windows of THRESHOLD arrays or more."""
        n = len(self.ids)
        if (high - low).sum() * 2 > n * len(low):
            # Wide windows: what lies outside is counted instead.
            outside = [part for j, (a, b) in enumerate(zip(low.tolist(), high.tolist()))
                       for part in (self.order[j, :a], self.order[j, b:])]
            return np.flatnonzero(np.bincount(np.concatenate(outside), minlength=n) <= len(low) - THRESHOLD)
        inside = [self.order[j, a:b] for j, (a, b) in enumerate(zip(low.tolist(), high.tolist()))]
        return np.flatnonzero(np.bincount(np.concatenate(inside), minlength=n) >= THRESHOLD)

    def distances(self, scores: np.ndarray, norms: np.ndarray | float) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (scores / norms) / self.scale))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray,
               nearest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, rows, scores) of the nearest rows found, best first.

        A query with a floor is searched once, at the radius of the floor, for
        rows that score no less. One without starts at the level of the nearest
        of a few rows, and the level grows until enough rows lie within it.
        """
        norms = norm(queries)
        known = ~np.isnan(floors)
        some = self.vectors[:PILOT]
        radius = self.distances(np.nan_to_num(floors), norms)
        for i in np.flatnonzero(~known):
            radius[i] = self.distances((some * queries[i]).sum(axis=1), norms[i]).min()
        levels, projected = level(radius), self.project(queries, norms)
        waiting = np.arange(len(queries))
        while len(waiting):
            radius = level_radius(levels[waiting])
            low, high = self.windows(projected[waiting], radius)
            again = []
            for k, i in enumerate(waiting.tolist()):
                rows = self.colliding(low[k], high[k])
                rows = rows[self.ids[rows] != query_ids[i]]
                scores = (self.vectors[rows] * queries[i]).sum(axis=1)
                if known[i]:
                    keep = scores >= floors[i]
                    rows, scores = rows[keep], scores[keep]
                elif np.isfinite(radius[k]) and (self.distances(scores, norms[i]) <= radius[k]).sum() < nearest:
                    again.append(i)
                    continue
                best = np.lexsort((self.ids[rows], -scores))[:nearest]
                yield i, rows[best], scores[best]
            waiting = np.array(again, int)
            levels[waiting] += 1


def norm(vectors: np.ndarray) -> np.ndarray:
    """Length of each vector; components may be so large that their squares are not finite."""
    most = np.abs(vectors).max(axis=1)
    return most * np.sqrt(((vectors / most[:, None]) ** 2).sum(axis=1))


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(rows, -1)


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search_task(scale: float, nearest: int):
    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not vectors.num_rows or not queries.num_rows:
            return _FOUND.empty_table()
        index = Index(vectors.column("vec_id").to_numpy(), _matrix(vectors.column("embedding"), vectors.num_rows), scale)
        query_ids = queries.column("vec_id").to_numpy()
        floors = queries.column("floor").to_numpy().astype(np.float64)
        out = [(np.full(len(rows), query_ids[i]), index.ids[rows], scores) for i, rows, scores in index.search(
            query_ids, _matrix(queries.column("embedding"), queries.num_rows), floors, nearest)]
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], schema=_FOUND)
    return search


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding, dim and norm of the rows that take part, one per id."""
    e = F.col("embedding")
    sound = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    most = F.array_max(F.transform(e, lambda x: F.abs(x.cast("double"))))
    squares = F.aggregate(e, F.lit(0.0), lambda s, x: s + F.pow(x.cast("double") / F.col("most"), F.lit(2.0)))
    return (vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & sound)
            .groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
            .withColumn("most", most)
            .select("vec_id", "embedding", F.size("embedding").alias("dim"), (F.col("most") * F.sqrt(squares)).alias("norm")))


def _dealt(blocks: int, salt: int) -> Column:
    return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(blocks)).cast("int")


def _best(found: DataFrame, nearest: int) -> DataFrame:
    """The best rows of each query, with their rank."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", "vec_id", "score", F.row_number().over(order).alias("rank")).filter(
        F.col("rank") <= nearest)


def search(vectors: DataFrame, nearest: int = NEAREST, query_every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest rows of every row whose id query_every divides."""
    rows = materialize(usable(vectors))
    is_query = F.col("vec_id") % query_every == 0
    # The only figures the driver sees: two counts and the largest norm.
    total, asked, scale = rows.agg(F.count("*"), F.count_if(is_query), F.max("norm")).first()
    blocks, query_blocks = max(1, math.ceil(total / BLOCK_ROWS)), max(1, math.ceil(asked / BLOCK_QUERIES))
    dealt = rows.select("dim", _dealt(blocks, 1).alias("block"), "vec_id", "embedding")
    queries = materialize(rows.filter(is_query).select("dim", _dealt(query_blocks, 2).alias("query_block"), "vec_id",
                                                       "embedding"))
    task = _search_task(scale, nearest)
    best, low, high = None, 0, 1
    while low < blocks:
        held = dealt.filter((F.col("block") >= low) & (F.col("block") < high)).withColumn(
            "query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
        if best is None:
            asking = queries.withColumn("floor", F.lit(None).cast("double"))
        else:
            floor = best.filter(F.col("rank") == nearest).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
            asking = queries.join(floor, "vec_id", "left")
        asking = asking.withColumn("block", F.explode(F.sequence(F.lit(low), F.lit(min(high, blocks) - 1))))
        keys = ("dim", "block", "query_block")
        found = held.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(
            task, "query_id long, vec_id long, score double")
        if best is not None:
            found = found.unionByName(best.select("query_id", "vec_id", "score"))
        best = materialize(_best(found, nearest))
        low, high = high, high * 4
    return best.select("query_id", "rank", "vec_id", "score")
