"""Exact top-k search by inner product, with a pivot table that rules out rows.

Vectors are whole numbers: floor(1024 * x) of each component. The distances of every row to ``pivots`` pivots are
computed once and stored beside it. For a query q and a row x, each pivot p gives d(q, x) >= |d(q, p) - d(x, p)|; the
largest of these lower bounds caps the inner product at (|q|^2 + |x|^2 - bound^2) / 2. A task takes its rows in the order
of that cap and stops as soon as the next cap is below the k-th best score found, so the result is exact.

The stated query set meets the rows in blocks: blocks of at most ``query_block`` queries and ``row_block`` rows,
each pair one group, each group k rows per query out. Nothing is sent to all tasks but the pivots (a bounded sample).
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import held, table
from .vectors import best, matrix, sampled, usable

SCALE = 1024
PIVOTS = 48
ROW_BLOCK = 4096
QUERY_BLOCK = 1024
STEP = 256  # rows evaluated between two looks at the bound
SEED = 11


def whole(v):
    return F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint"))


def pivot_table(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds to (id, v, dim) the distances to the pivots of equal dimension (p)."""

    def distances(batches):
        for batch in batches:
            dims = batch["dim"].to_numpy()
            out = np.zeros((batch.num_rows, len(pivots)))
            for dim in np.unique(dims):
                if dim == pivots.shape[1] and dim:
                    some = np.flatnonzero(dims == dim)
                    x = matrix(batch["v"].take(pa.array(some)), dim, np.float64)
                    for i, p in enumerate(pivots):
                        out[some, i] = np.sqrt(((x - p) ** 2).sum(axis=1))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), len(pivots)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch["id"], batch["v"], batch["dim"], flat], names=["id", "v", "dim", "p"])

    return rows.select("id", "v", "dim").mapInArrow(distances, "id bigint, v array<bigint>, dim int, p array<double>")


def search_block(queries: pa.Table, rows: pa.Table, k: int) -> tuple[list, list, list, int]:
    """Query ids, row ids and scores of the k best rows for each query, and how many rows were evaluated."""
    dim = queries["dim"][0].as_py()
    q, x = matrix(queries["v"], dim, np.int64), matrix(rows["v"], dim, np.int64)
    qi, xi = queries["id"].to_numpy(), rows["id"].to_numpy()
    width = len(rows["p"][0])
    qp, xp = matrix(queries["p"], width, np.float64), matrix(rows["p"], width, np.float64)
    q2, x2 = (q * q).sum(axis=1), (x * x).sum(axis=1)
    ids, found, scores, seen = [], [], [], 0
    for i in range(len(q)):
        low = np.zeros(len(x))
        for j in range(width):
            np.maximum(low, np.abs(xp[:, j] - qp[i, j]), out=low)
        low = np.maximum(low * (1 - 1e-9) - 1e-6, 0)  # rounding must not raise a lower bound
        cap = (q2[i] + x2 - low * low) / 2
        order = np.argsort(-cap, kind="stable")
        order = order[xi[order] != qi[i]]
        top, top_ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at in range(0, len(order), STEP):
            if len(top) == k and cap[order[at]] + 1 < top[-1]:
                break
            some = order[at : at + STEP]
            seen += len(some)
            s, n = np.concatenate([top, x[some] @ q[i]]), np.concatenate([top_ids, xi[some]])
            first = np.lexsort((n, -s))[:k]
            top, top_ids = s[first], n[first]
        ids += [qi[i]] * len(top)
        found += top_ids.tolist()
        scores += top.tolist()
    return ids, found, scores, seen


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, pivots: int = PIVOTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows with the largest inner product for each query.

    Queries are the ids divisible by ``every``. A row is no candidate for the query with its own id; ties go to the
    smaller id; vectors of different length do not meet. See ``usable`` for what takes no part.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector).select("id", whole("v").alias("v"), "dim")
    sample = sampled(rows, pivots, SEED)
    dims = [len(r.v) for r in sample]
    dim = max(set(dims), key=dims.count) if dims else 1
    chosen = np.array([r.v for r in sample if len(r.v) == dim], np.float64).reshape(-1, dim)
    if not len(chosen) or not dim:
        chosen = np.zeros((1, max(dim, 1)))
    rows = held(pivot_table(rows, chosen), "pivots")
    queries = rows.where(F.col("id") % every == 0)
    n_rows, n_queries = rows.count(), queries.count()
    row_blocks, query_blocks = max(1, -(-n_rows // ROW_BLOCK)), max(1, -(-n_queries // QUERY_BLOCK))
    block = lambda n: F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(n)).cast("int")
    left = queries.withColumn("qb", block(query_blocks)).withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    right = rows.withColumn("rb", block(row_blocks)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        out = ([], [], [], 0)
        if a.num_rows and b.num_rows:
            out = search_block(a, b, k)
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.int64())})

    by = ("dim", "qb", "rb")
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    return best(found, k, F.desc("score")).select("query_id", "rank", "vec_id", "score")


def op5_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"))


OP5_SQL = """
WITH vecs AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(x.v AS DOUBLE[])) AS BIGINT) AS score
  FROM vecs q JOIN vecs x ON q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 10
"""
