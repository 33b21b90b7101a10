"""Nearest neighbours by low-dimensional stable projections and kd-trees.

Vectors are brought to unit length, where the nearest by distance have the largest cosine, and
projected on a few random normal directions. The squared distance of two projections, over that of
the vectors, follows a chi-square distribution. Each block of rows has a kd-tree of its projections. A
query takes the tree's leaves by growing projected distance and computes exact cosines, until a
nearer vector than its k-th would have to project this far with a probability below 1 - SURE.

Every row is indexed. Queries, a stated set, meet every block of rows in blocks of at most
QUERY_BLOCK, so no task holds more than one block of each. Nearest rows of the blocks are merged.

Defined results: vectors that are null, empty, zero, or hold a null or non-finite component take no
part, nor do rows without a vec_id; rows that repeat a vec_id count once, with the least vector;
vectors are compared with those of their own length; equal cosines go by the smaller vec_id; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from trackmill.llm.common import partitions, stored, table

NEAREST = 5
QUERY_EACH = 50
DIMENSIONS = 8
SURE = 0.9
LEAF = 32
QUERY_BLOCK = 2048
#: Projections this near count as equal, whatever the order of additions.
EQUAL = 1e-9

FOUND = pa.schema(
    [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("checked", pa.int64())]
)


def chi_square(x: np.ndarray, dimensions: int) -> np.ndarray:
    """Distribution function for an even number of dimensions."""
    half, term, total = x / 2, np.ones_like(x), np.zeros_like(x)
    for k in range(dimensions // 2):
        total = total + term
        term = term * half / (k + 1)
    return 1 - np.exp(-half) * total


def _limit(sure: float, dimensions: int) -> float:
    """Where the distribution function reaches ``sure``."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(np.array(middle), dimensions) < sure else (low, middle)
    return high


def directions(size: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(size)).standard_normal((size, dimensions))


class KdTree:
    """Points in leaves of at most ``leaf``, halved at the median of the widest axis; boxes of leaves."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.leaves: list[np.ndarray] = []
        stack = [np.arange(len(points))]
        while stack:
            some = stack.pop()
            if len(some) <= leaf:
                self.leaves.append(some)
                continue
            axis = int(np.ptp(points[some], axis=0).argmax())
            order = some[np.argpartition(points[some, axis], len(some) // 2)]
            stack += [order[: len(some) // 2], order[len(some) // 2 :]]
        self.low = np.array([points[x].min(axis=0) for x in self.leaves])
        self.high = np.array([points[x].max(axis=0) for x in self.leaves])

    def distances(self, queries: np.ndarray) -> np.ndarray:
        """Squared distance of each query to each leaf's box."""
        out = np.zeros((len(queries), len(self.leaves)))
        for axis in range(queries.shape[1]):
            q = queries[:, axis, None]
            gap = np.maximum(0, np.maximum(self.low[:, axis] - q, q - self.high[:, axis]))
            out += gap**2
        return out


def search(
    ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
    nearest: int = NEAREST, sure: float = SURE, dimensions: int = DIMENSIONS,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query the ids and cosines of the nearest rows found (-1: none), and how many
    cosines were computed."""
    norms, query_norms = np.linalg.norm(rows, axis=1), np.linalg.norm(queries, axis=1)
    flat = directions(rows.shape[1], dimensions)
    points = (rows / norms[:, None]) @ flat
    tree = KdTree(points)
    away = tree.distances((queries / query_norms[:, None]) @ flat)
    turn = np.argsort(away, axis=1)
    away = np.take_along_axis(away, turn, axis=1)
    width = max(map(len, tree.leaves))
    members = np.full((len(tree.leaves), width), -1)
    for i, leaf in enumerate(tree.leaves):
        members[i, : len(leaf)] = leaf
    best = np.full((len(queries), nearest), -np.inf)
    best_id = np.full((len(queries), nearest), -1, dtype=np.int64)
    checked = np.zeros(len(queries), dtype=np.int64)
    limit = _limit(sure, dimensions)
    open_ = np.arange(len(queries))
    for step in range(len(tree.leaves)):
        farthest = np.maximum(0, 2 - 2 * best[open_, -1])  # squared, on the sphere
        going = ~(away[open_, step] > np.minimum(farthest, 1e9) * limit + EQUAL)
        open_ = open_[going]
        if not len(open_):
            break
        some = members[turn[open_, step]]
        cosine = np.einsum("qwd,qd->qw", rows[some], queries[open_]) / (norms[some] * query_norms[open_, None])
        own = ids[some]
        cosine[(some < 0) | (own == query_ids[open_, None])] = -np.inf
        checked[open_] += (some >= 0).sum(axis=1)
        all_cosines = np.concatenate([best[open_], cosine], axis=1)
        all_ids = np.concatenate([best_id[open_], own], axis=1)
        order = np.lexsort((all_ids, -all_cosines), axis=1)[:, :nearest]
        best[open_] = np.take_along_axis(all_cosines, order, axis=1)
        best_id[open_] = np.take_along_axis(all_ids, order, axis=1)
    best_id[np.isneginf(best)] = -1
    return best_id, best, checked


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if len(column) else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _search_block(nearest: int, sure: float):
    def found(key, rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not (rows.num_rows and queries.num_rows):
            return FOUND.empty_table()
        size = key[0].as_py()
        query_ids = queries["query_id"].to_numpy()
        ids, scores, checked = search(
            rows["vec_id"].to_numpy(), _matrix(rows["vector"], size), query_ids, _matrix(queries["query"], size),
            nearest, sure,
        )
        there = ids >= 0
        there |= ~np.isneginf(scores)
        return pa.table(
            {
                "query_id": np.repeat(query_ids, nearest)[there.ravel()],
                "vec_id": ids[there],
                "score": scores[there],
                "checked": np.repeat(checked, nearest)[there.ravel()],
            },
            schema=FOUND,
        )

    return found


def _usable(vectors: DataFrame) -> DataFrame:
    """vec_id, size, vector (as double) of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    return (
        vectors.select("vec_id", vector.alias("vector"))
        .filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
        .filter(finite & some)
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector"))
        .withColumn("size", F.size("vector"))
    )


def nearest_rows(vectors: DataFrame, chosen: Column, nearest: int = NEAREST, sure: float = SURE) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of each row that ``chosen`` names."""
    blocks = partitions(vectors.sparkSession)
    rows = stored(_usable(vectors))
    queries = rows.filter(chosen)
    query_blocks = -(-queries.count() // QUERY_BLOCK)
    part = F.explode(F.sequence(F.lit(0), F.lit(max(0, query_blocks - 1)))).alias("part")
    dealt = rows.select("*", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), part)
    asked = queries.select(
        F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), (F.col("size") + 0).alias("size"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(max(1, query_blocks))).cast("int").alias("part"),
    )
    keys = ["size", "block", "part"]
    found = (
        dealt.groupBy(*keys)
        .cogroup(asked.groupBy(*keys))
        .applyInArrow(_search_block(nearest, sure), "query_id long, vec_id long, score double, checked long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= nearest)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_rows(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EACH == 0)
