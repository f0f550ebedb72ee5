"""Approximate nearest neighbours with a hierarchical k-means tree and best-bin-first search.

The tree is fitted on a bounded sample; every vector is put into its leaf.  A query takes leaves from a priority queue of tree nodes
ordered by distance to their centres.  How many leaves are visited is found by calibration: the true neighbours of some queries are computed over
all vectors, and visits widen until enough of them lie in the visited leaves.  Leaves are dealt into blocks of bounded size.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalpost.llm.common import stored

SAMPLE, BRANCHES, LEAF = 20_000, 8, 128
BLOCK, CALIBRATION = 4096, 128


@dataclass
class Tree:
    """Nodes in order of making; a node's children follow each other, a leaf has none and a leaf number instead."""

    centres: np.ndarray
    child: np.ndarray  # first child, or -1
    children: np.ndarray  # number of children
    leaf: np.ndarray  # number of the leaf, or -1
    leaves: int

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        at = np.zeros(len(vectors), np.int64)
        while True:
            inner = np.flatnonzero(self.child[at] >= 0)
            if not len(inner):
                return self.leaf[at]
            for node in np.unique(at[inner]):
                some = inner[at[inner] == node]
                first = self.child[node]
                centres = self.centres[first:first + self.children[node]]
                gaps = (centres ** 2).sum(axis=1)[None, :] - 2 * vectors[some] @ centres.T
                at[some] = first + np.argmin(gaps, axis=1)

    def order(self, query: np.ndarray, visits: int, held: np.ndarray | None = None, enough: int = 0) -> list[int]:
        """The first leaves of a best-bin-first search: ``visits`` of them, and more until they hold ``enough`` vectors."""
        queue, out, got = [(0.0, 0)], [], 0
        while queue and (len(out) < visits or got < enough):
            _, node = heapq.heappop(queue)
            while self.child[node] >= 0:
                first = self.child[node]
                gaps = ((self.centres[first:first + self.children[node]] - query) ** 2).sum(axis=1)
                near = int(np.argmin(gaps))
                for i, gap in enumerate(gaps.tolist()):
                    if i != near:
                        heapq.heappush(queue, (gap, int(first + i)))
                node = int(first + near)
            out.append(int(self.leaf[node]))
            got += 0 if held is None else int(held[out[-1]])
        return out


def grow(sample: np.ndarray, branches: int = BRANCHES, leaf: int = LEAF, seed: int = 7) -> Tree:
    """k-means, then k-means within every cluster, until clusters are small or cannot be divided."""
    rng = np.random.default_rng(seed)
    centres, child, children, leaves = [sample.mean(axis=0)], [-1], [0], [-1]
    todo, number = [(0, np.arange(len(sample)))], 0
    while todo:
        node, rows = todo.pop(0)
        points = sample[rows]
        distinct = np.unique(points, axis=0) if len(rows) > leaf else points[:1]
        if len(rows) <= leaf or len(distinct) < 2:
            leaves[node] = number
            number += 1
            continue
        means = distinct[rng.choice(len(distinct), min(branches, len(distinct)), replace=False)]
        for _ in range(8):
            own = np.argmin((means ** 2).sum(axis=1)[None, :] - 2 * points @ means.T, axis=1)
            used = np.unique(own)
            means = np.stack([points[own == k].mean(axis=0) for k in used])
        own = np.argmin((means ** 2).sum(axis=1)[None, :] - 2 * points @ means.T, axis=1)
        if len(np.unique(own)) < 2:
            leaves[node] = number
            number += 1
            continue
        child[node], children[node] = len(centres), len(means)
        for k in range(len(means)):
            todo.append((len(centres), rows[own == k]))
            centres.append(means[k])
            child.append(-1)
            children.append(0)
            leaves.append(-1)
    return Tree(np.stack(centres), np.array(child), np.array(children), np.array(leaves), number)


def matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def nearest(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int):
    """(query position, vector position, distance) of the k nearest vectors of each query but its own, ties to the smaller id."""
    out = []
    by_id = np.argsort(ids, kind="stable")
    vectors, ids = vectors[by_id], ids[by_id]
    rough = max(1, (1 << 21) // max(1, vectors.size))
    for at in range(0, len(queries), rough):
        gaps = ((vectors[None, :, :] - queries[at:at + rough, None, :]) ** 2).sum(axis=2)
        gaps[ids[None, :] == query_ids[at:at + rough, None]] = np.inf
        best = np.argsort(gaps, axis=1, kind="stable")[:, :k + len(ids) - len(np.unique(ids))]
        for i in range(len(best)):
            seen: set[int] = set()
            for j in best[i]:
                if len(seen) < k and np.isfinite(gaps[i, j]) and ids[j] not in seen:
                    seen.add(ids[j])
                    out.append((at + i, by_id[j], float(np.sqrt(gaps[i, j]))))
    return out


def _best(rows: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k)


def meetings(index: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Rows (leaf, block, part, id, v, query): the vectors of a leaf and the queries that visit it, both dealt into blocks of about ``size``.

    Every block of vectors meets every block of queries of its leaf, called a part, in one group, so a group is bounded whatever the leaf holds.
    """
    def numbers(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("leaf").agg(F.ceil(F.count("*") / F.lit(size)).cast("int").alias(name))

    counts = F.broadcast(stored(numbers(index, "blocks").join(numbers(wanted, "parts"), "leaf"), "blocks"))  # one row per leaf of the bounded tree

    def dealt(rows: DataFrame, own: str, number: str, other: str, others: str, query: bool) -> DataFrame:
        place = F.pmod(F.xxhash64("id"), F.col(number)).cast("int").alias(own)
        rows = rows.join(counts, "leaf").select("leaf", place, F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(other), "id", "v", F.lit(query).alias("query"))
        return rows.select("leaf", "block", "part", "id", "v", "query")

    return dealt(index, "block", "blocks", "part", "parts", False).union(dealt(wanted, "part", "parts", "block", "blocks", True))


def search(df: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 100, k: int = 10, recall: float = 0.97,
           sample: int = SAMPLE) -> tuple[DataFrame, dict]:
    """Neighbours (``query_id``, ``rank``, ``vec_id``, ``score``) of the rows whose key is divisible by ``every``, and what calibration found.

    ``score`` is the Euclidean distance in double precision.  The tree is fitted on about ``sample`` rows chosen by hash; calibration
    uses at most ``CALIBRATION`` queries, also chosen by hash, and their true neighbours over all rows.

    Vectors that are null, zero, or hold a null or a value that is not finite take no part, nor do null keys and vectors
    of another length than the most frequent one.  A row is not its own neighbour; rows that repeat a key count as one, at their smallest distance.
    An empty table gives no rows.
    """
    good = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")).filter(
        F.col("id").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    sizes = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    spark = df.sparkSession
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    if sizes is None:
        return spark.createDataFrame([], empty), {"recall": 1.0, "visits": 0}
    good = good.filter(F.size("v") == sizes["n"])
    part = F.pmod(F.xxhash64("id", F.lit("tree")), F.lit(1 << 30)) / F.lit(1 << 30)
    fitted = good.filter(part < sample / sizes["count"]).select("v").limit(2 * sample).toArrow()
    if not fitted.num_rows:
        fitted = good.select("v").limit(sample).toArrow()
    tree = grow(matrix(fitted.column("v")))
    sent = spark.sparkContext.broadcast(tree)  # bounded by the sample

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = sent.value.leaf_of(matrix(batch.column("v"))) if batch.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], ["id", "v", "leaf"])

    index = stored(good.mapInArrow(place, "id bigint, v array<double>, leaf bigint"), "index")
    queries = index.filter(F.col("id") % every == 0).select("id", "v").dropDuplicates(["id"])
    number = queries.count()
    chosen = queries.filter(F.pmod(F.xxhash64("id", F.lit("calibrate")), F.lit(1 << 30)) / F.lit(1 << 30) < CALIBRATION / max(1, number))
    tested = chosen.limit(2 * CALIBRATION).toArrow()
    if not tested.num_rows:
        tested = queries.limit(CALIBRATION).toArrow()
    if not tested.num_rows:
        return spark.createDataFrame([], empty), {"recall": 1.0, "visits": 0}
    probes = spark.sparkContext.broadcast((tested.column("id").to_numpy(), matrix(tested.column("v"))))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, points = probes.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                own, leaf = some.column("id").to_numpy(), some.column("leaf").to_numpy()
                found = nearest(matrix(some.column("v")), own, points, ids, k)
                yield pa.RecordBatch.from_arrays([pa.array([ids[q] for q, _, _ in found], pa.int64()), pa.array([own[j] for _, j, _ in found], pa.int64()),
                                                  pa.array([d for _, _, d in found], pa.float64()), pa.array([leaf[j] for _, j, _ in found], pa.int64())],
                                                 ["query_id", "vec_id", "score", "leaf"])

    true = _best(index.mapInArrow(exact, "query_id bigint, vec_id bigint, score double, leaf bigint"), k).select("query_id", "leaf").collect()
    rank = {int(i): {leaf: r for r, leaf in enumerate(tree.order(p, tree.leaves))} for i, p in zip(tested.column("id").to_numpy(), matrix(tested.column("v")))}
    needed = np.sort([rank[r["query_id"]][r["leaf"]] for r in true]) if true else np.zeros(1, np.int64)
    visits = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1
    reached = float((needed < visits).mean())

    blocks = stored(index.groupBy("leaf").agg(F.count("*").alias("held")), "leaves")  # one row per leaf of the bounded tree
    held = np.zeros(tree.leaves, np.int64)
    for leaf, n in blocks.collect():
        held[leaf] = n

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [sent.value.order(p, visits, held, k + 1) for p in matrix(batch.column("v"))] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int64()))], ["id", "v", "leaves"])

    wanted = stored(queries.mapInArrow(leaves, "id bigint, v array<double>, leaves array<bigint>"), "wanted")
    met = meetings(index, wanted.select("id", "v", F.explode("leaves").alias("leaf")), BLOCK)

    def compare(table: pa.Table) -> pa.Table:
        asks = table.column("query").to_numpy()
        ids, points = table.column("id").to_numpy(), matrix(table.column("v"))
        own, asked = np.flatnonzero(~asks), np.flatnonzero(asks)
        found = nearest(points[own], ids[own], points[asked], ids[asked], k) if len(own) and len(asked) else []
        return pa.table({"query_id": pa.array([ids[asked[q]] for q, _, _ in found], pa.int64()), "vec_id": pa.array([ids[own[j]] for _, j, _ in found], pa.int64()),
                         "score": pa.array([d for _, _, d in found], pa.float64())})

    near = met.groupBy("leaf", "block", "part").applyInArrow(compare, "query_id bigint, vec_id bigint, score double")
    near = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    out = _best(near, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    return out, {"recall": reached, "visits": visits, "leaves": tree.leaves}
