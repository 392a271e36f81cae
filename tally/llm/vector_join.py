"""Nearest neighbours by a block matrix join: int8 product tiles with error bounds, exact products of what survives.

A tile holds a block of queries and a block of candidates. Vectors are rounded to int8 with a scale of their own, so a
tile of inner products is one product of small integers, and the norms of what rounding took away bound the error of
each. A pair whose upper bound stays below the k-th best lower bound can't be among the k nearest; the others are
computed again in double precision, and each query's tiles are merged by a heap. Nothing is lost, so recall is 1.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERY_BLOCK = 512
CANDIDATE_BLOCK = 2048


def usable(vector: str) -> Column:
    """Vectors without null or non-finite components that aren't null, empty or zero."""
    v = F.col(vector)
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(v.isNotNull() & whole & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrices(table: pa.Table, side: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By dimension: ids and vectors in double precision."""
    lists = table[f"{side}_vector"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy().astype(np.float64)
    begins = np.cumsum(sizes) - sizes
    ids = table[f"{side}_id"].to_numpy()
    return {int(d): (ids[sizes == d], flat[begins[sizes == d][:, None] + np.arange(d)]) for d in np.unique(sizes)}


def _rounded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 numbers, scale, norm of the rounded vector, norm of the error)."""
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = 1.0  # components too small to divide
    q = np.rint(x / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    return q, scale, np.sqrt((back * back).sum(axis=1)), np.sqrt(((x - back) ** 2).sum(axis=1))


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed from the first component to the last."""
    return np.cumsum(x * y, axis=1)[:, -1]


def nearest_in_tile(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> list[tuple[int, list[int], list[float]]]:
    """(query id, ids, scores) of each query's k nearest among the candidates, nearest first, its own id left out."""
    q8, qs, qn, qe = _rounded(q)
    c8, cs, cn, ce = _rounded(c)
    wide = np.float32 if q.shape[1] * 127 * 127 < 1 << 24 else np.float64  # either holds these sums of integers exactly
    product = (q8.astype(wide) @ c8.astype(wide).T).astype(np.float64) * qs[:, None] * cs
    error = (np.outer(qn, ce) + np.outer(qe, cn) + np.outer(qe, ce)) * (1 + 1e-6) + 1e-12 * np.outer(qn + qe, cn + ce)
    own = q_ids[:, None] == c_ids
    lower = np.where(own, -np.inf, product - error)
    at = min(k, lower.shape[1]) - 1
    bar = -np.partition(-lower, at, axis=1)[:, at]
    survive = ~own & (product + error >= bar[:, None])
    found = []
    for i in range(len(q_ids)):
        near = np.flatnonzero(survive[i])
        scores = exact(q[i], c[near])
        order = np.lexsort((c_ids[near], -scores))[:k]  # ties to the smaller id
        if len(order):
            found.append((int(q_ids[i]), c_ids[near[order]].tolist(), scores[order].tolist()))
    return found


def merged(lists: Iterable[Iterable[tuple[float, int]]], k: int) -> list[tuple[float, int]]:
    """The first k of sorted lists of (-score, id), by a heap over the lists' heads."""
    return list(islice(heapq.merge(*lists), k))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), the id and score (inner product) of each query's k nearest, ties to the smaller id.

    ``is_query`` tells the queries among the rows; candidates are all rows but those of the query's own id. Unusable
    vectors (see ``usable``) and null ids take no part; vectors are compared with those of their own dimension. Rows that
    repeat an id are one query, by the smallest vector, and each a candidate. With k candidates or fewer all are
    returned; an empty table gives an empty one; further columns are left behind. Blocks are dealt by random numbers,
    not by keys, so they are of one size whatever repeats; a tile's memory depends on the block sizes alone. A query's
    merge reads k rows per block of candidates.
    """
    rows = vectors.withColumn("q__", is_query).select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector"), F.coalesce("q__", F.lit(False)).alias("query"))
    rows = rows.where(F.col("id").isNotNull() & usable("vector"))
    queries = rows.where("query").groupBy("id").agg(F.min("vector").alias("vector"))
    n = rows.agg(F.count("*").alias("all"), F.count_if("query").alias("queries")).first()
    q_blocks, c_blocks = max(1, math.ceil(n["queries"] / query_block)), max(1, math.ceil(n["all"] / candidate_block))

    def dealt(df: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int, seed: int) -> DataFrame:
        block = (F.rand(seed) * own_blocks).cast("int").alias(own)
        named = df.select(F.col("id").alias(f"{own}_id"), F.col("vector").alias(f"{own}_vector"), block)
        return named.select("*", F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1))).alias(other))

    left = dealt(queries, "qb", q_blocks, "cb", c_blocks, 1)
    right = dealt(rows.select("id", "vector"), "cb", c_blocks, "qb", q_blocks, 2)

    def tile(q: pa.Table, c: pa.Table) -> pa.Table:
        found: list[tuple[int, list[int], list[float]]] = []
        if q.num_rows and c.num_rows:
            theirs = _matrices(c, "cb")
            for d, (ids, x) in _matrices(q, "qb").items():
                if d in theirs:
                    found += nearest_in_tile(ids, x, *theirs[d], k)
        query, ids, scores = zip(*found, strict=True) if found else ((), (), ())
        return pa.table({"query_id": pa.array(query, pa.int64()), "ids": pa.array(ids, pa.list_(pa.int64())), "scores": pa.array(scores, pa.list_(pa.float64()))})

    def merge(tiles: pa.Table) -> pa.Table:
        lists = zip(tiles["ids"].to_pylist(), tiles["scores"].to_pylist(), strict=True)
        best = merged([[(-s, i) for i, s in zip(ids, scores, strict=True)] for ids, scores in lists], k)
        return pa.table(
            {
                "query_id": pa.array([tiles["query_id"][0].as_py()] * len(best), pa.int64()),
                "rank": pa.array(range(1, len(best) + 1), pa.int32()),
                "vec_id": pa.array([i for _, i in best], pa.int64()),
                "score": pa.array([-s for s, _ in best], pa.float64()),
            }
        )

    near = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(tile, "query_id long, ids array<long>, scores array<double>")
    best = near.groupBy("query_id").applyInArrow(merge, "query_id long, rank int, vec_id long, score double")
    return best.select("query_id", "rank", F.col("vec_id").alias(id_column), "score")
