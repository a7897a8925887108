"""Exact top-k by inner product: tiled matrix products, selection per tile, lists merged as a tree.

Queries are hashed into blocks and candidates into shards of bounded size. A shard meets every block in
a task of its own, which multiplies the two matrices, keeps each query's best and emits only those.
A query's lists then meet ``FAN_IN`` shards at a time, level by level, so no task sees more than
``FAN_IN * k`` entries of a query. The query set is a stated share of the rows and grows with them, so
it is never broadcast.

Components are scaled to whole numbers, floor(scale * x) in double precision, and scores are exact
64-bit sums. Ties go to the smaller vec_id, and a query never finds itself. Defined results: vectors
that are null or hold null or non-finite components take no part; vectors of different length do not
meet; of rows that repeat a vec_id the smallest vector counts; rows without vec_id take no part; with
fewer than k candidates all are returned. Sums beyond 64 bits wrap as longs do. Other columns take no
part and may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docfleet.llm.work import Work

BLOCK_ROWS = 16_384
SHARD_ROWS = 16_384
STEP_ROWS = 256
FAN_IN = 16
LISTS = "query_id bigint, vec_id bigint, score bigint, _node bigint"


def scaled(vectors: DataFrame, column: str, scale: int) -> DataFrame:
    """vec_id and _v, the whole-number vector, one row per id."""
    usable = F.col(column).isNotNull() & ~F.exists(column, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    whole = F.transform(column, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return (
        vectors.filter(F.col("vec_id").isNotNull() & usable).select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("_v"))
        .groupBy("vec_id").agg(F.min("_v").alias("_v"))
    )


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("vec_id").to_numpy()
    flat = table.column("_v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    order = np.argsort(ids)
    return ids[order], flat.reshape(len(ids), -1)[order]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products, by floating point only where it is exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _tile(k: int):
    def best(key, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        empty = {"query_id": [], "vec_id": [], "score": [], "_node": []}
        out = {c: [np.zeros(0, np.int64)] for c in empty}
        if queries.num_rows and candidates.num_rows:
            ids, vectors = _matrix(candidates)
            own, matrix = _matrix(queries)
            for at in range(0, len(own), STEP_ROWS):
                scores = _products(matrix[at : at + STEP_ROWS], vectors)
                for q, row in zip(own[at : at + STEP_ROWS], scores):
                    place = np.searchsorted(ids, q)
                    others, values = ids, row
                    if place < len(ids) and ids[place] == q:
                        others, values = np.delete(ids, place), np.delete(row, place)
                    if len(values) > k:
                        # ids ascend, so of equal scores the first ones count
                        least = np.partition(values, len(values) - k)[len(values) - k]
                        above = np.flatnonzero(values > least)
                        level = np.flatnonzero(values == least)[: k - len(above)]
                        chosen = np.concatenate([above, level])
                        others, values = others[chosen], values[chosen]
                    out["query_id"].append(np.full(len(values), q))
                    out["vec_id"].append(others)
                    out["score"].append(values)
                    out["_node"].append(np.full(len(values), key[2].as_py(), np.int64))
        return pa.table({c: pa.array(np.concatenate(v), pa.int64()) for c, v in out.items()})

    return best


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, column: str = "embedding", scale: int = 256, work: Work | None = None) -> DataFrame:
    """For each row with ``is_query`` (a condition on vec_id): query_id, rank, vec_id, score of its k best."""
    work = work or Work(vectors.sparkSession, "topk")
    rows = work.save(scaled(vectors, column, scale).withColumn("_d", F.size("_v")), "scaled")
    queries = rows.filter(is_query)
    count, asked = rows.count(), queries.count()
    shards, blocks = max(1, -(-count // SHARD_ROWS)), max(1, -(-asked // BLOCK_ROWS))
    spread = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    left = queries.withColumn("_block", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(blocks)).cast("int")).withColumn("_shard", F.explode(spread(shards)))
    # a cogroup wants its two sides to have no column in common, not even one of the same origin
    right = rows.select(*[F.col(c).alias(c) for c in rows.columns]).withColumn("_shard", F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.lit(shards)).cast("int")).withColumn("_block", F.explode(spread(blocks)))
    keys = ["_d", "_block", "_shard"]
    lists = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_tile(k), LISTS)
    nodes = shards
    entry = F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("v"), F.col("score").alias("t"))
    while True:
        nodes = -(-nodes // FAN_IN)
        lists = (
            lists.groupBy("query_id", F.floor(F.col("_node") / FAN_IN).alias("_node"))
            .agg(F.slice(F.sort_array(F.collect_list(entry)), 1, k).alias("_best"))
        )
        if nodes == 1:
            break
        lists = lists.select("query_id", "_node", F.explode("_best").alias("_e")).select("query_id", F.col("_e.v").alias("vec_id"), F.col("_e.t").alias("score"), "_node")
    return lists.select("query_id", F.posexplode("_best").alias("_r", "_e")).select(
        "query_id", (F.col("_r") + 1).cast("int").alias("rank"), F.col("_e.v").alias("vec_id"), F.col("_e.t").alias("score")
    )
