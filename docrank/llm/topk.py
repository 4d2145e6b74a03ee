"""Exact top-k inner-product search by tiled matrix products.

Vectors become integers, ``floor(scale * x)``; the score of a query and a
vector is their integer inner product. Spark deals vectors to shards by a hash
of the id and queries to blocks, and brings every (block, shard) pair together
in one task: a matrix product a few hundred queries at a time, of which each
query keeps its k best (partial selection, ties to the smaller id). The lists
of the shards meet in a tree: each level merges ``fan_in`` lists of a query
and keeps k rows again, so no task sees more than ``fan_in * k`` rows of one.

Defined cases: vectors that are null or hold null, NaN or infinite components,
and rows without an id, take no part; only vectors of equal length are
compared, and an empty one scores 0; of several rows with one id all are
candidates, and the least vector is the query; rows with the query's id are
not its candidates. Empty tables give no rows.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STEP = 256  # queries multiplied at a time in a tile


def _matrix(column: pa.Array, scale: float) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(values.flatten(), np.float64)
    return np.floor(scale * flat).reshape(len(values), len(flat) // max(1, len(values)))


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products, exact: doubles while every sum stays below 2**53, whole numbers beyond."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if most < 2.0**53:
        return q @ c.T
    if most < 2.0**63:
        return q.astype(np.int64) @ c.astype(np.int64).T
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(q) @ whole(c).T, -(2**63) + 1, 2**63 - 1)


def best(scores: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k highest scores of one query, ties to the earlier column; ``own`` masks its own rows."""
    if own.any():
        at = np.flatnonzero(~own)
        return at[best(scores[at], np.zeros(len(at), bool), k)]
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    return at[np.argsort(-scores[at], kind="stable")[:k]]


def exact_topk(queries: DataFrame, vectors: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
               scale: float = 64.0, block_rows: int = 4096, shard_rows: int = 8192, fan_in: int = 32) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best vectors."""
    if not isinstance(k, int) or k <= 0:
        raise ValueError("k is a positive integer")

    def usable(df: DataFrame) -> DataFrame:
        x = F.col(vector_col)
        finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
        return df.where(F.col(id_col).isNotNull() & x.isNotNull() & finite).select(
            F.col(id_col).cast("long").alias("id"), x.cast("array<double>").alias("vector"), F.size(x).alias("dim"))

    asked = usable(queries).groupBy("id").agg(F.min(F.struct("dim", "vector")).alias("q")).select("id", "q.*")
    there = usable(vectors)
    shards = max(1, math.ceil(there.count() / shard_rows))
    blocks = max(1, math.ceil(asked.count() / block_rows))
    place = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    left = asked.withColumn("block", place(blocks)).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    right = there.withColumn("shard", F.pmod(F.xxhash64("id", "vector"), F.lit(shards)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def tile(key: tuple, q: pa.Table, c: pa.Table) -> pa.Table:
        q, c = q.sort_by("id"), c.sort_by("id")
        qid, cid = np.asarray(q["id"]), np.asarray(c["id"])
        out_q, out_c, out_s = [], [], []
        if len(qid) and len(cid):
            a, b = _matrix(q["vector"], scale), _matrix(c["vector"], scale)
            for lo in range(0, len(qid), STEP):
                scores = _scores(a[lo: lo + STEP], b)
                for i, row in enumerate(scores):
                    at = best(row, cid == qid[lo + i], k)
                    out_q.append(np.full(len(at), qid[lo + i])), out_c.append(cid[at]), out_s.append(row[at].astype(np.int64))
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return pa.table({"query_id": join(out_q), "vec_id": join(out_c), "score": join(out_s),
                         "part": np.full(sum(map(len, out_q)), key[1].as_py(), np.int64)})

    key = ["block", "shard", "dim"]
    lists = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        tile, "query_id long, vec_id long, score long, part long")
    parts = shards
    while True:
        parts = math.ceil(parts / fan_in)
        lists = lists.withColumn("part", F.floor(F.col("part") / fan_in))
        keys = ["query_id"] if parts <= 1 else ["query_id", "part"]
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
        lists = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        if parts <= 1:
            return lists.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
