"""Nearest neighbours by inner product: stable projections, a kd-tree, a chi-square stop.

Vectors get one more component that makes all of them equally long, so that the largest
inner product is the least distance whatever their norms. A Gaussian projection to
``PROJECTED`` dimensions maps a distance d to d times the root of a chi-square variable, and
a kd-tree over the projections gives a query's projected neighbours in growing distance,
leaf by leaf. Each is verified on the original vectors; the search stops once the next
projected distance is so large that a point nearer than the k-th found so far would have
come earlier with probability ``CONFIDENCE``.

All vectors are indexed: they are dealt to blocks of bounded size, each with its own tree,
and the query set is dealt to groups; a task searches one group in one block, and a
query's best of all blocks are merged by rank.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no
part, nor do rows without an id. Of rows with one id the least vector counts. Vectors meet
only vectors with as many components. Fewer candidates than k give all of them; empty
tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusq.session import written

PROJECTED = 8  # even, for the closed form of the chi-square distribution
CONFIDENCE = 0.97
LEAF = 128
BLOCK_ROWS = 20_000
GROUP_QUERIES = 1_000
SEED = 20


def chi_square_cdf(x: float, degrees: int = PROJECTED) -> float:
    """For even degrees of freedom."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half**i / math.factorial(i) for i in range(degrees // 2))


@lru_cache(maxsize=None)
def stopping_ratio(confidence: float, degrees: int = PROJECTED) -> float:
    """The squared ratio of projected to true distance below which a share ``confidence`` lies."""
    low, high = 0.0, 1e3
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, degrees) < confidence else (low, middle)
    return high


@lru_cache(maxsize=4)
def projection(dimensions: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dimensions, PROJECTED))


class Tree:
    """The leaves of a kd-tree: which points each holds, and its bounding box."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.leaves, stack = [], [np.arange(len(points))]
        while stack:
            own = stack.pop()
            if len(own) <= leaf:
                self.leaves.append(own)
                continue
            axis = int(np.ptp(points[own], axis=0).argmax())
            half = len(own) // 2
            split = own[np.argpartition(points[own, axis], half)]
            stack += [split[:half], split[half:]]
        self.low = np.array([points[o].min(0) for o in self.leaves])
        self.high = np.array([points[o].max(0) for o in self.leaves])

    def by_distance(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaves in growing squared distance of their boxes from ``at``, and these distances."""
        outside = np.maximum(0, np.maximum(self.low - at, at - self.high))
        squared = (outside**2).sum(1)
        order = np.argsort(squared, kind="stable")
        return order, squared[order]


def search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, norm: float, k: int,
           confidence: float = CONFIDENCE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of the neighbours found for each query; ``norm`` is at least the
    length of any vector."""
    lift = np.sqrt(np.maximum(0, norm**2 - (vectors**2).sum(1)))
    plane = projection(vectors.shape[1] + 1)
    tree = Tree(np.column_stack([vectors, lift]) @ plane)
    projected = queries @ plane[:-1]
    held = [vectors[o] for o in tree.leaves]
    ratio = stopping_ratio(confidence)
    out = []
    for number, query in enumerate(queries):
        order, squared = tree.by_distance(projected[number])
        far = norm**2 + float(query @ query)
        scores, found, kth, n = [], [], -math.inf, 0
        for leaf, reach in zip(order.tolist(), squared.tolist()):
            # The k-th nearest so far lies at squared distance norm^2 + |q|^2 - 2 score.
            if n >= k and reach >= ratio * max(0.0, far - 2 * kth):
                break
            values = held[leaf] @ query
            own = ids[tree.leaves[leaf]]
            use = (values >= kth) & (own != query_ids[number]) if n >= k else own != query_ids[number]
            if use.any():
                scores.append(values[use])
                found.append(own[use])
                n += int(use.sum())
                if n >= k:
                    s, f = np.concatenate(scores), np.concatenate(found)
                    best = np.lexsort((f, -s))[:k]
                    scores, found, n = [s[best]], [f[best]], len(best)
                    kth = float(scores[0][-1])
        if n:
            s, f = np.concatenate(scores), np.concatenate(found)
            best = np.lexsort((f, -s))[:k]
            out.append((np.full(len(best), query_ids[number]), f[best], s[best]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*out))


def takes_part(vector: Column) -> Column:
    """Whether a vector is complete, finite and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(rows, -1)


def nearest(df: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector: str = "embedding",
            confidence: float = CONFIDENCE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row for which ``is_query`` holds."""
    rows = (
        df.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
        .filter(F.col("id").isNotNull() & takes_part(F.col("vector")))
        .groupBy("id").agg(F.min("vector").alias("vector"), F.bool_or("is_query").alias("is_query"))
        .withColumn("size", F.size("vector"))
    )
    rows = written(rows, "vectors")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    n, n_queries, norm = rows.agg(F.count("*"), F.count_if("is_query"), F.max(length)).first()
    norm = float(norm or 1.0) * (1 + 1e-12)
    blocks, groups = max(1, ceil(n / BLOCK_ROWS)), max(1, ceil(n_queries / GROUP_QUERIES))
    deal = lambda parts, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    points = rows.select("size", deal(blocks, 1).alias("block"), every(groups).alias("group"), "id", "vector")
    queries = rows.filter("is_query").select("size", every(blocks).alias("block"), deal(groups, 2).alias("group"), "id", "vector")

    def search_block(mine: pa.Table, asked: pa.Table) -> pa.Table:
        if mine.num_rows and asked.num_rows:
            found = search(mine["id"].to_numpy(), _matrix(mine["vector"], mine.num_rows),
                           asked["id"].to_numpy(), _matrix(asked["vector"], asked.num_rows), norm, k, confidence)
        else:
            found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, found))))

    keys = ("size", "block", "group")
    found = points.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(
        search_block, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
