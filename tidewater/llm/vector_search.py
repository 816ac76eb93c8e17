"""Nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first.

Largest inner product becomes smallest distance by one more coordinate that
gives all rows the same norm (queries get 0 there). A tree of k-means splits is
fitted on a bounded sample (``SAMPLE`` vectors, by hash); every row of the
table is then dealt to its leaf. A query walks the tree with a priority queue
of nodes by distance and so ranks the leaves. The number of leaves it visits is
widened until the recall of a bounded set of calibration queries, whose true
neighbours come from all rows, reaches ``RECALL``; that number serves all queries.

Leaves and the queries that visit them meet in blocks of bounded size, so a
leaf that holds a third of all rows is many tasks. Scores are inner products of
the original vectors in double precision.

Defined results: vectors that are NULL, zero, of another length than most, or
hold NULL or non-finite numbers take no part; an id is answered once and never
its own neighbour; ties go to the smaller id; with fewer candidates than asked
for, all are returned; an empty table gives no rows.
"""
from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import small_batches
from tidewater.session import materialise

SAMPLE = 20_000  # vectors the tree is fitted on
BRANCHES, LEAF = 8, 10  # children of a node, least sampled vectors to split a leaf
LEAF_ROWS = 1000  # rows of the table in a leaf that is not split further
CALIBRATION, RECALL = 200, 0.97  # queries the number of visits is set by, and their recall
ROWS = 4096  # vectors, and queries, in a block


@dataclass
class Node:
    """A split with its children's centres, or a leaf with its number."""

    centres: np.ndarray | None
    children: list["Node"]
    leaf: int = -1


@dataclass
class Tree:
    """The tree and the largest squared norm, which the added coordinate completes."""

    root: Node
    leaves: int
    norm2: float

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.norm2 - (vectors * vectors).sum(axis=1), 0)
        return np.hstack([vectors, np.sqrt(rest)[:, None]])

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out = np.zeros(len(vectors), np.int32)

        def walk(node: Node, rows: np.ndarray, points: np.ndarray) -> None:
            if node.centres is None:
                out[rows] = node.leaf
                return
            near = _nearest(points, node.centres)
            for k, child in enumerate(node.children):
                mine = near == k
                if mine.any():
                    walk(child, rows[mine], points[mine])

        walk(self.root, np.arange(len(vectors)), self.lifted(vectors))
        return out

    def ranked_leaves(self, query: np.ndarray, visits: int) -> list[int]:
        """The first ``visits`` leaves, best bin first."""
        point, found, order = np.append(query, 0.0), [], 0
        queue = [(0.0, 0, self.root)]
        while queue and len(found) < visits:
            _, _, node = heapq.heappop(queue)
            if node.centres is None:
                found.append(node.leaf)
                continue
            gaps = ((node.centres - point) ** 2).sum(axis=1)
            for gap, child in zip(gaps.tolist(), node.children):
                order += 1
                heapq.heappush(queue, (gap, order, child))
        return found


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


def fit_tree(sample: np.ndarray, norm2: float, largest: int) -> Tree:
    """Split by k-means until a node holds at most ``largest`` sampled vectors."""
    random, count = np.random.default_rng(5), 0
    tree = Tree(Node(None, []), 0, norm2)

    def grow(points: np.ndarray) -> Node:
        nonlocal count
        distinct = np.unique(points, axis=0) if len(points) > largest else points
        if len(distinct) <= max(largest, BRANCHES):
            count += 1
            return Node(None, [], count - 1)
        centres = distinct[random.choice(len(distinct), BRANCHES, replace=False)]
        for _ in range(12):
            near = _nearest(points, centres)
            centres = np.stack([points[near == k].mean(axis=0) if (near == k).any() else centres[k] for k in range(BRANCHES)])
        near = _nearest(points, centres)
        used = [k for k in range(BRANCHES) if (near == k).any()]
        if len(used) < 2:
            count += 1
            return Node(None, [], count - 1)
        return Node(centres[used], [grow(points[near == k]) for k in used])

    tree.root = grow(tree.lifted(sample)) if len(sample) else Node(None, [], 0)
    tree.leaves = max(count, 1)
    return tree


def clean_vectors(table: DataFrame) -> DataFrame:
    """vec_id and vec (doubles) of the rows that take part."""
    vec = F.transform("embedding", lambda x: x.cast("double"))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).filter("vec_id IS NOT NULL AND vec IS NOT NULL")
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = materialise(rows.filter(F.coalesce(fine, F.lit(False))), "vectors")
    usual = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vec") == (usual["n"] if usual else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def best_pairs(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> pd.DataFrame:
    """The k best rows of a block for each query, ties to the smaller id.

    A matrix product finds the candidates; scores are then summed pair by pair,
    so that equal vectors have equal scores in whatever block they are.
    """
    products = queries @ vectors.T
    products[query_ids[:, None] == ids[None, :]] = -np.inf
    out = []
    for i in range(len(queries)):
        row = products[i]
        if len(row) > k:
            least = np.partition(row, len(row) - k)[len(row) - k]
            near = np.flatnonzero((row >= least - 1e-9 * (1 + abs(least))) & (row > -np.inf))
        else:
            near = np.flatnonzero(row > -np.inf)
        scores = (vectors[near] * queries[i]).sum(axis=1)
        order = np.lexsort((ids[near], -scores))[:k]
        out.append((np.full(len(order), query_ids[i]), ids[near][order], scores[order]))
    if not out:
        return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
    query_id, vec_id, score = (np.concatenate(x) for x in zip(*out))
    return pd.DataFrame({"query_id": query_id, "vec_id": vec_id, "score": score})


def _top(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


FOUND = "query_id long, vec_id long, score double"


def brute_force(rows: DataFrame, queries: pd.DataFrame, k: int) -> DataFrame:
    """The true neighbours of a bounded set of queries: each task compares its rows, a block at a time."""
    matrix, query_ids = np.stack(queries["vec"].to_list()), queries["vec_id"].to_numpy()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            if not len(batch):
                continue
            found = best_pairs(matrix, query_ids, _matrix(batch.column("vec")), batch.column("vec_id").to_numpy(), k)
            best = found if best is None else pd.concat([best, found])
            best = best.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).groupby("query_id").head(k)
        if best is not None:
            yield pa.RecordBatch.from_pandas(best, preserve_index=False)

    return _top(rows.select("vec_id", "vec").mapInArrow(compare, FOUND), k)


def search(table: DataFrame, is_query, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest rows of each row where ``is_query`` holds."""
    spark = table.sparkSession
    small_batches(spark, 2048)
    rows = clean_vectors(table)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    norm2 = rows.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)).alias("n")).first()["n"]
    if norm2 is None:
        return empty
    drawn = rows.select("vec_id", "vec", F.xxhash64("vec_id", "vec").alias("order")).orderBy("order", "vec_id").limit(SAMPLE)
    sample = np.array([r["vec"] for r in drawn.select("vec").collect()])
    # Leaves grow in number with the table, until the sample cannot tell more of them apart.
    tree = fit_tree(sample, norm2, max(LEAF, LEAF_ROWS * len(sample) // rows.count()))
    shared = spark.sparkContext.broadcast(tree)  # bounded by SAMPLE

    def to_leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.assign(_matrix(batch.column("vec"))) if len(batch) else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], names=["leaf", "vec_id", "vec"])

    dealt = materialise(rows.select("vec_id", "vec").mapInArrow(to_leaf, "leaf int, vec_id long, vec array<double>"), "leaves")
    # One row per query id; of rows that repeat an id, the least vector asks.
    queries = rows.filter(is_query).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    probes = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION).toPandas()
    if probes.empty:
        return empty
    visits = _visits(dealt, probes, tree, k)

    def to_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = [shared.value.ranked_leaves(v, visits) for v in _matrix(batch.column("vec"))] if len(batch) else []
            yield pa.RecordBatch.from_arrays([pa.array(leaves, pa.list_(pa.int32())), *batch.columns], names=["leaves", "vec_id", "vec"])

    asked = queries.mapInArrow(to_leaves, "leaves array<int>, vec_id long, vec array<double>")
    asked = materialise(asked.select(F.explode("leaves").alias("leaf"), "vec_id", "vec"), "asked")
    # Rows and queries per leaf (as many entries as the tree has leaves) set the number of blocks.
    blocks = lambda df, name: df.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / ROWS).cast("int").alias(name))
    sizes = F.broadcast(blocks(dealt, "row_blocks").join(blocks(asked, "query_blocks"), "leaf"))
    deal = lambda blocks, salt: F.pmod(F.xxhash64("vec_id", "vec", F.lit(salt)), F.col(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    left = dealt.join(sizes, "leaf").withColumn("rb", deal("row_blocks", 1)).withColumn("qb", every("query_blocks"))
    right = asked.join(sizes, "leaf").withColumn("qb", deal("query_blocks", 2)).withColumn("rb", every("row_blocks"))
    block = ["leaf", "rb", "qb"]

    def meet(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(rows) or not len(queries):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        vectors, ids = _matrix(rows.column("vec")), rows.column("vec_id").to_numpy()
        points, asking = _matrix(queries.column("vec")), queries.column("vec_id").to_numpy()
        found = [best_pairs(points[i : i + 256], asking[i : i + 256], vectors, ids, k) for i in range(0, len(points), 256)]
        return pa.Table.from_pandas(pd.concat(found), preserve_index=False)

    pairs = (
        left.select(*block, "vec_id", "vec").groupBy(*block)
        .cogroup(right.select(*block, "vec_id", "vec").groupBy(*block))
        .applyInArrow(meet, FOUND)
    )
    return _top(pairs, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _visits(dealt: DataFrame, probes: pd.DataFrame, tree: Tree, k: int) -> int:
    """Leaves to visit: widened until the calibration queries' recall is reached."""
    truth = brute_force(dealt, probes, k).select("query_id", "vec_id").toPandas()
    wanted = truth["vec_id"].drop_duplicates().tolist()  # at most CALIBRATION * k ids
    leaf = dealt.filter(F.col("vec_id").isin(wanted)).select("vec_id", "leaf").toPandas().groupby("vec_id")["leaf"].min()
    place = {q: {n: i for i, n in enumerate(tree.ranked_leaves(v, tree.leaves))} for q, v in zip(probes["vec_id"], map(np.array, probes["vec"]))}
    needed = sorted(place[q][leaf[v]] + 1 for q, v in zip(truth["query_id"], truth["vec_id"]))
    return int(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))) - 1)]) if needed else 1
