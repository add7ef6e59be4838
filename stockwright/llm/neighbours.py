"""Approximate nearest neighbours with a hierarchical k-means tree and best-bin-first traversal.

The tree is fitted on a sample of at most ``SAMPLE`` vectors and has at most as many nodes as the sample has rows, so it is
bounded however large the table is; every row is then assigned to a leaf. A query walks the tree through a priority
queue: the node with the nearest centre is opened next, and the leaves come out in that order. How many leaves to visit is
calibrated: for a sample of rows the true neighbours over all rows are found once, and the visits widen until the wanted
share of them lies in visited leaves.

Neighbouring leaves form buckets of about ``ROW_BLOCK`` rows; a leaf that holds more (copies of one vector) is a bucket of its
own, split by the hash of the id. A bucket meets the queries that visit any of its leaves, at most ``QUERY_BLOCK`` at a time,
and each group gives back k rows per query. Distances are exact, on the original vectors.
"""
from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import held, table
from .vectors import best, matrix, usable

SAMPLE = 16_384
BRANCH = 8
LEAF_ROWS = 256
CALIBRATION = 96  # rows whose true neighbours are found to calibrate the visits
RECALL = 0.95  # aimed at in calibration
ROW_BLOCK = 4096
QUERY_BLOCK = 1024
SEED = 13


class Tree:
    """Nodes in arrays: centre, children (none for a leaf). Leaves are named by their node number."""

    def __init__(self, points: np.ndarray, leaf_points: int, branch: int = BRANCH, seed: int = SEED):
        self.dim = points.shape[1]
        rng = np.random.default_rng(seed)
        self.children: list[list[int]] = [[]]
        centres = [points.mean(axis=0) if len(points) else np.zeros(self.dim)]
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, members = todo.pop()
            if len(members) <= leaf_points:
                continue
            own, parts = split(points[members], branch, rng)
            if len(own) < 2:
                continue
            for j in range(len(own)):
                self.children[node].append(len(centres))
                centres.append(own[j])
                self.children.append([])
                todo.append((self.children[node][-1], members[parts == j]))
        self.centres = np.array(centres)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: at every node the nearest child."""
        at = np.zeros(len(x), np.int64)
        open_ = {0: np.arange(len(x))}
        while open_:
            node, rows = open_.popitem()
            if self.children[node]:
                kids = np.array(self.children[node])
                near = kids[squared(x[rows], self.centres[kids]).argmin(axis=1)]
                for kid in kids:
                    if (near == kid).any():
                        open_[int(kid)] = rows[near == kid]
            else:
                at[rows] = node
        return at

    def in_order(self) -> list[int]:
        """All leaves, siblings side by side."""
        out, todo = [], [0]
        while todo:
            node = todo.pop()
            todo += reversed(self.children[node])
            if not self.children[node]:
                out.append(node)
        return out

    def leaves(self, q: np.ndarray, visits: int | None = None) -> list[int]:
        """The first leaves in best-bin-first order."""
        queue, out = [(0.0, 0)], []
        while queue and (visits is None or len(out) < visits):
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not kids:
                out.append(node)
            else:
                for kid, d in zip(kids, squared(q[None], self.centres[kids])[0].tolist()):
                    heapq.heappush(queue, (d, kid))
        return out


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None] - 2 * x @ c.T, 0)


def split(x: np.ndarray, branch: int, rng, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """k-means: the centres that have members, and the centre of each row."""
    distinct = np.unique(x, axis=0)
    if len(distinct) < 2:
        return distinct, np.zeros(len(x), np.int64)
    centres = distinct[rng.choice(len(distinct), min(branch, len(distinct)), replace=False)]
    for _ in range(rounds):
        parts = squared(x, centres).argmin(axis=1)
        used = np.unique(parts)
        centres = np.stack([x[parts == j].mean(axis=0) for j in used])
    parts = squared(x, centres).argmin(axis=1)
    used, parts = np.unique(parts, return_inverse=True)
    return centres[used], parts


def nearest(q: np.ndarray, qi: np.ndarray, x: np.ndarray, xi: np.ndarray, k: int):
    """Per query the k nearest rows other than its own, ties to the smaller id: (query number, row number, distance)."""
    for i in range(len(q)):
        rows = np.flatnonzero(xi != qi[i])
        diff = x[rows] - q[i]
        d = np.sqrt((diff * diff).sum(axis=1))
        if len(d) > k:
            some = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
            rows, d = rows[some], d[some]
        for j in np.lexsort((xi[rows], d))[:k]:
            yield i, rows[j], d[j]


def fit(rows: DataFrame, n_rows: int, sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS) -> Tree:
    """The tree of the most frequent dimension among the sampled rows."""
    got = rows.select("id", "v", "dim", F.xxhash64(F.lit(SEED), "id").alias("h")).orderBy("h", "id").limit(sample).drop("h").toArrow()
    dims = got["dim"].to_numpy()
    dim = int(np.bincount(dims).argmax()) if len(dims) else 1
    points = matrix(got.filter(pa.array(dims == dim))["v"], dim, np.float64) if len(dims) else np.zeros((0, 1))
    return Tree(points, max(4, int(leaf_rows * min(1.0, len(points) / max(n_rows, 1)))))


def assigned(rows: DataFrame, tree: Tree) -> DataFrame:
    """Adds each row's leaf. Vectors of another dimension than the tree's share one leaf per dimension, number -1 - dim."""

    def assign(batches):
        for batch in batches:
            dims = batch["dim"].to_numpy()
            leaf = -1 - dims.astype(np.int64)
            some = np.flatnonzero(dims == tree.dim)
            if len(some):
                leaf[some] = tree.assign(matrix(batch["v"].take(pa.array(some)), tree.dim, np.float64))
            yield pa.RecordBatch.from_arrays([batch["id"], batch["v"], batch["dim"], pa.array(leaf)], names=["id", "v", "dim", "leaf"])

    return rows.select("id", "v", "dim").mapInArrow(assign, f"id bigint, v {rows.schema['v'].dataType.simpleString()}, dim int, leaf bigint")


def calibrate(rows: DataFrame, tree: Tree, k: int, recall: float = RECALL, size: int = CALIBRATION) -> int:
    """Leaves to visit so that the wanted share of the true neighbours of a sample of rows lies in them."""
    got = rows.where(F.col("dim") == tree.dim).select("id", "v", F.xxhash64(F.lit(SEED + 1), "id").alias("h")).orderBy("h", "id").limit(size).drop("h").toArrow()
    if not got.num_rows:
        return 1
    q, qi, dim = matrix(got["v"], tree.dim, np.float64), got["id"].to_numpy(), tree.dim

    def scan(batches):
        for batch in batches:
            some = np.flatnonzero(batch["dim"].to_numpy() == dim)
            if not len(some):
                continue
            x, xi, leaf = matrix(batch["v"].take(pa.array(some)), dim, np.float64), batch["id"].to_numpy()[some], batch["leaf"].to_numpy()[some]
            out = list(nearest(q, qi, x, xi, k))
            yield pa.RecordBatch.from_pydict({
                "query_id": [int(qi[i]) for i, _, _ in out], "vec_id": [int(xi[j]) for _, j, _ in out],
                "score": [float(d) for *_, d in out], "leaf": [int(leaf[j]) for _, j, _ in out]})

    found = rows.mapInArrow(scan, "query_id bigint, vec_id bigint, score double, leaf bigint")
    truth = best(found, k, F.asc("score")).select("query_id", "leaf").collect()  # size * k rows
    order = {int(i): {leaf: n for n, leaf in enumerate(tree.leaves(v), 1)} for i, v in zip(qi, q)}
    need = np.array([order[r.query_id][r.leaf] for r in truth])
    visits = 1
    while len(need) and (need <= visits).mean() < recall:
        visits += max(1, visits // 8)
    return visits


def search(vectors: DataFrame, k: int = 10, every: int = 100, recall: float = RECALL, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance): the k nearest rows found for each query.

    Queries are the ids divisible by ``every``. A row is no candidate for the query with its own id; ties go to the
    smaller id; vectors of different length do not meet. See ``usable`` for what takes no part; zero vectors do not.
    """
    plain = held(usable(vectors, key, vector, zero=False), "vectors")
    tree = fit(plain, plain.count())
    rows = held(assigned(plain, tree), "leaves")
    visits = calibrate(rows, tree, k, recall)

    # One number per leaf: bounded like the tree, plus one per odd dimension.
    counts = {r.leaf: r["count"] for r in rows.groupBy("leaf").count().collect()}
    bucket, splits, filled = {}, {}, 0
    for leaf in [*tree.in_order(), *sorted(n for n in counts if n < 0)]:
        n = counts.get(leaf, 0)
        if leaf < 0 or not splits or filled + n > ROW_BLOCK:
            splits[len(splits)] = 1
            filled = 0
        filled += n
        bucket[leaf] = len(splits) - 1
        splits[bucket[leaf]] = max(1, -(-filled // ROW_BLOCK))

    def walk(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                dim = row["dim"][0].as_py()
                found: dict[int, list[int]] = {}
                for leaf in tree.leaves(matrix(row["v"], dim, np.float64)[0], visits) if dim == tree.dim else [-1 - dim]:
                    found.setdefault(bucket[leaf], []).append(leaf)
                again = pa.array([0] * len(found))
                yield pa.RecordBatch.from_arrays(
                    [row["id"].take(again), row["v"].take(again), row["dim"].take(again), pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.list_(pa.int64()))],
                    names=["id", "v", "dim", "bucket", "leaves"])

    kind = f"id bigint, v {rows.schema['v'].dataType.simpleString()}, dim int, bucket bigint, leaves array<bigint>"
    visited = held(rows.where(F.col("id") % every == 0).select("id", "v", "dim").mapInArrow(walk, kind), "visits")
    busy = {r.bucket: r["count"] for r in visited.groupBy("bucket").count().collect()}
    spark = vectors.sparkSession
    plan = spark.createDataFrame([(leaf, b, splits[b], -(-busy.get(b, 0) // QUERY_BLOCK)) for leaf, b in bucket.items()], "leaf bigint, bucket bigint, rows bigint, queries bigint")
    plan = plan.where("queries > 0")
    block = lambda c: F.pmod(F.xxhash64(F.lit(SEED), "id"), F.col(c))
    every_block = lambda c: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1))
    left = visited.join(F.broadcast(plan.drop("leaf").distinct()), "bucket").withColumn("qb", block("queries")).withColumn("rb", every_block("rows"))
    right = rows.join(F.broadcast(plan), "leaf").withColumn("rb", block("rows")).withColumn("qb", every_block("queries"))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        out = []
        if a.num_rows and b.num_rows:
            dim = a["dim"][0].as_py()
            qi, xi, leaf = a["id"].to_numpy(), b["id"].to_numpy(), b["leaf"].to_numpy()
            q, x = matrix(a["v"], dim, np.float64), matrix(b["v"], dim, np.float64)
            for n, own in enumerate(a["leaves"].to_pylist()):
                some = np.flatnonzero(np.isin(leaf, own))
                out += [(int(qi[n]), int(xi[some[j]]), float(d)) for _, j, d in nearest(q[n : n + 1], qi[n : n + 1], x[some], xi[some], k)]
        return pa.table({"query_id": pa.array([r[0] for r in out], pa.int64()), "vec_id": pa.array([r[1] for r in out], pa.int64()), "score": pa.array([r[2] for r in out], pa.float64())})

    by = ("bucket", "qb", "rb")
    left, right = left.select("id", "v", "dim", "leaves", *by).groupBy(*by), right.select("id", "v", "dim", "leaf", *by).groupBy(*by)
    found = left.cogroup(right).applyInArrow(meet, "query_id bigint, vec_id bigint, score double")
    return best(found, k, F.asc("score")).select("query_id", "rank", "vec_id", "score")


def op8_ann(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "embeddings"))
