"""Exact top-k inner products by branch and bound in a ball tree per shard.

Rows are dealt to shards by a hash of their id, each shard builds a ball tree, and a query
visits its nodes in the order of their upper bounds ``q.c + |q| r``, until the bound falls
below its current k-th score.  Every query is first searched in its own shard; the k-th
score found there goes along to all other shards, so these start with a tight bound.
Queries and shards meet in blocks of bounded size.

Components are turned into whole numbers ``floor(scale * x)``, and scores are exact as long
as they stay below 2^53.  Vectors that are null, hold null or non-finite components, or
have no id take no part; vectors of different lengths are not compared.  Rows that repeat
an id count once, with the greatest vector.  Ties go to the smaller id.  An empty table
gives an empty result.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormgauge.llm.common import staged
from stormgauge.llm.lattice import matrix, usable

SHARD_ROWS = 8192
BLOCK_QUERIES = 2048
LEAF_ROWS = 64


@dataclass
class BallTree:
    """Nodes over a reordered matrix: centre, radius, row range and children (-1: leaf)."""

    ids: np.ndarray
    rows: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    left: np.ndarray
    right: np.ndarray


def build(ids: np.ndarray, rows: np.ndarray) -> BallTree:
    order = np.arange(len(ids))
    centre, radius, begin, end, left, right = [], [], [], [], [], []
    open_nodes = [(0, len(ids), -1, False)]
    while open_nodes:
        a, b, parent, is_right = open_nodes.pop()
        node = len(centre)
        if parent >= 0:
            (right if is_right else left)[parent] = node
        part = rows[order[a:b]]
        middle = part.mean(axis=0)
        centre.append(middle)
        radius.append(np.sqrt(((part - middle) ** 2).sum(axis=1).max()))
        begin.append(a)
        end.append(b)
        left.append(-1)
        right.append(-1)
        if b - a > LEAF_ROWS and radius[-1] > 0:
            # along the line between a far row and the row farthest from it
            far = part[((part - middle) ** 2).sum(axis=1).argmax()]
            other = part[((part - far) ** 2).sum(axis=1).argmax()]
            half = (b - a) // 2
            split = np.argpartition(part @ (other - far), half)
            order[a:b] = order[a:b][split]
            open_nodes += [(a, a + half, node, False), (a + half, b, node, True)]
    return BallTree(
        ids[order], rows[order], np.array(centre), np.array(radius),
        *(np.array(x) for x in (begin, end, left, right)),
    )


def search(
    tree: BallTree, query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``(query, id, score)`` that may be among the best k of each query.

    ``least`` is a score that the k-th best is known to reach (minus infinity: unknown).
    """
    norm = np.linalg.norm(queries, axis=1)
    bound = queries @ tree.centre.T + norm[:, None] * tree.radius
    # room for rounding, as bounds are not whole numbers
    bound += 1e-6 + 1e-9 * norm[:, None] * (np.linalg.norm(tree.centre, axis=1) + tree.radius)
    out: list[list] = [[], [], []]
    for i, own in enumerate(query_ids.tolist()):
        floor, best = least[i], []  # best: heap of (score, -id)
        upper, query = bound[i], queries[i]
        heap = [(-upper[0], 0)]
        while heap:
            top, node = heapq.heappop(heap)
            if -top < floor:
                break
            if tree.left[node] >= 0:
                for child in (tree.left[node], tree.right[node]):
                    if upper[child] >= floor:
                        heapq.heappush(heap, (-upper[child], child))
                continue
            a, b = tree.begin[node], tree.end[node]
            score = tree.rows[a:b] @ query
            for at in np.flatnonzero(score >= floor).tolist():
                entry = (score[at], -int(tree.ids[a + at]))
                if -entry[1] == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
                if len(best) == k:
                    floor = max(floor, best[0][0])
        out[0] += [own] * len(best)
        out[1] += [-e[1] for e in best]
        out[2] += [int(e[0]) for e in best]
    return tuple(np.array(c, np.int64) for c in out)


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _searched(table: pa.Table, asked: pa.Table, k: int) -> pa.Table:
    def columns(t):
        vector = t.column("vector").combine_chunks()
        d = len(vector[0])
        return t.column("vec_id").to_numpy(), matrix(vector, d)

    if not table.num_rows or not asked.num_rows:
        return _FOUND.empty_table()
    tree = build(*columns(table))
    least = asked.column("least").combine_chunks().fill_null(-np.inf).to_numpy(zero_copy_only=False)
    found = search(tree, *columns(asked), least, k)
    return pa.Table.from_arrays([pa.array(c) for c in found], schema=_FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: float = 256.0,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best other rows of each query row.

    ``is_query`` is a condition over ``vec_id``.
    """
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector")
    ).where(usable("vector") & F.col("vec_id").isNotNull())
    whole = F.transform("vector", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    rows = rows.select("vec_id", whole.alias("vector"))
    rows = rows.groupBy("vec_id").agg(F.max("vector").alias("vector"))
    rows = staged(rows.withColumn("dim", F.size("vector")), "vectors")

    # shards and blocks by vector length: a handful of numbers
    sizes = rows.groupBy("dim").agg(
        F.ceil(F.count("*") / SHARD_ROWS).alias("shards"),
        F.greatest(F.lit(1), F.ceil(F.count_if(is_query) / BLOCK_QUERIES)).alias("blocks"),
    )
    rows = rows.join(sizes, "dim").select(
        "dim",
        "vec_id",
        "vector",
        "shards",
        "blocks",
        F.pmod(F.xxhash64("vec_id"), "shards").alias("shard"),
        F.pmod(F.xxhash64(F.lit(1), "vec_id"), "blocks").alias("block"),
    )
    key = ["dim", "shard", "block"]
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    held = rows.select("dim", "shard", "vec_id", "vector", every)
    # columns of their own, as both sides come from the same table
    asked = rows.where(is_query).select(*(F.col(c).alias(c) for c in rows.columns))
    unknown = F.lit(None).cast("double").alias("least")
    schema = "query_id long, vec_id long, score long"

    def search_cells(queries: DataFrame) -> DataFrame:
        return (
            held.groupBy(*key)
            .cogroup(queries.groupBy(*key))
            .applyInArrow(lambda one, two: _searched(one, two, k), schema)
        )

    home = search_cells(asked.select(*key, "vec_id", "vector", unknown))
    home = staged(home, "home")
    known = home.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    known = known.select(
        F.col("query_id").alias("vec_id"), F.when(F.col("n") == k, F.col("least")).cast("double").alias("least")
    )
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard")
    away = asked.withColumnRenamed("shard", "home").join(known, "vec_id", "left")
    away = away.select("dim", "block", "vec_id", "vector", "least", "home", others)
    away = search_cells(away.where("shard <> home"))
    return _best(home.union(away), k).select("query_id", "rank", "vec_id", "score")
