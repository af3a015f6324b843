"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are grown on a bounded sample and are small enough to go to every
task; all vectors are then indexed by their leaf in each tree. A query searches
all trees through one priority queue, nearest half-spaces first, until the
leaves it reached hold enough vectors. Rows and queries meet by leaf, where
distances are exact, and each leaf answers with its best few only. Leaves are
cut into blocks of rows and blocks of queries, so that no task holds more than
one block of each. Leaves of all trees are numbered through.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.plans.storage import materialise

TREES = 4
# Vectors the trees are grown on: those with the smallest hashes of their ids.
SAMPLE = 8192
LEAF = 64
NEIGHBOURS = 10
# A query visits leaves until they hold this share of the indexed vectors, counting a vector
# once per tree. Vectors without structure need most of the leaves; clustered ones a few.
VISIT = 1.5
# Rows of a leaf that meet its queries in one task; larger leaves are split.
BLOCK_ROWS = 16_384
# Queries of a leaf that meet its rows in one task; more of them meet the rows in several.
BLOCK_QUERIES = 4_096
SEED = 11


@dataclass
class Tree:
    """Inner nodes with a hyperplane; a child below zero is leaf ``-child - 1``."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    leaves: int

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        at = np.zeros(len(vectors), np.int64) if len(self.offsets) else np.full(len(vectors), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            side = np.einsum("ij,ij->i", vectors[inner], self.normals[node]) > self.offsets[node]
            at[inner] = self.children[node, side.astype(np.int64)]
        return -at - 1


def grow(sample: np.ndarray, rng: np.random.Generator, leaf: int = LEAF) -> Tree:
    """Split at the median of projections on the direction between two random rows."""
    normals, offsets, children = [], [], []
    leaves = 0

    def build(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > leaf:
            a, b = sample[rng.choice(rows, 2, replace=False)]
            normal = a - b
            length = np.linalg.norm(normal)
            projected = sample[rows] @ normal / (length or 1.0)
            cut = float(np.median(projected))
            if length and (projected <= cut).any() and (projected > cut).any():
                node = len(offsets)
                normals.append(normal / length)
                offsets.append(cut)
                children.append([0, 0])
                children[node] = [build(rows[projected <= cut]), build(rows[projected > cut])]
                return node
        leaves += 1
        return -leaves

    build(np.arange(len(sample)))
    width = sample.shape[1]
    return Tree(
        np.array(normals).reshape(-1, width), np.array(offsets), np.array(children, np.int64).reshape(-1, 2), leaves
    )


def search(forest: list[Tree], query: np.ndarray, weights: list[np.ndarray], enough: float) -> list[tuple[int, int]]:
    """(tree, leaf) in the order of the shared queue until they weigh ``enough``."""
    margins = [t.normals @ query - t.offsets for t in forest]
    queue = [(-np.inf, i, 0 if len(t.offsets) else -1) for i, t in enumerate(forest)]
    heapq.heapify(queue)
    visited, weight = [], 0.0
    while queue and weight < enough:
        rank, tree, node = heapq.heappop(queue)
        if node < 0:
            visited.append((tree, -node - 1))
            weight += weights[tree][-node - 1]
            continue
        margin = margins[tree][node]
        low, high = forest[tree].children[node]
        # a half-space is as near as the farthest cut on the way to it
        heapq.heappush(queue, (max(rank, margin), tree, int(low)))
        heapq.heappush(queue, (max(rank, -margin), tree, int(high)))
    return visited


def usable(vector: Column) -> Column:
    """Not null, not empty, every component a finite number, not all zero."""
    value = F.coalesce(vector, F.array().cast("array<double>"))
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return finite & F.exists(value, lambda x: x != 0)


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of equal length as float64."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _block_of(numbers: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    spread = (numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return (spread % blocks.astype(np.uint64)).astype(np.int64)


def _indexer(forest: list[Tree], first: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"))
            leaves = np.stack([t.leaf_of(vectors) + f for t, f in zip(forest, first)], axis=1).astype(np.int32)
            ends = np.arange(0, leaves.size + 1, len(forest), dtype=np.int32)
            yield _with_leaves(batch, ends, leaves.ravel())

    return run


def _searcher(forest, first, weights, enough) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            visited = [
                [first[tree] + leaf for tree, leaf in search(forest, v, weights, enough)] for v in _matrix(batch.column("vector"))
            ]
            ends = np.cumsum([0, *map(len, visited)]).astype(np.int32)
            yield _with_leaves(batch, ends, np.array([leaf for leaves in visited for leaf in leaves], np.int32))

    return run


def _with_leaves(batch: pa.RecordBatch, ends: np.ndarray, leaves: np.ndarray) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(leaves))
    names = ["row", "id", "vector"]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), lists], [*names, "leaves"])


PLACE = ["leaf", "block", "ask"]
MEET = "leaf int, block int, ask int, row long, id long, vector array<double>"


def _meeting(batch: pa.RecordBatch, which: np.ndarray, place: list[np.ndarray]) -> pa.RecordBatch:
    taken = pa.array(which, pa.int64())
    wide = batch.column("vector").take(taken).cast(pa.list_(pa.float64()))
    arrays = [*(pa.array(x, pa.int32()) for x in place), batch.column("row").take(taken), batch.column("id").take(taken), wide]
    return pa.RecordBatch.from_arrays(arrays, [*PLACE, "row", "id", "vector"])


def _meetings(
    blocks: np.ndarray, copies: np.ndarray, of_rows: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each row, or query, in its own of the ``blocks`` of its leaves, once for each of the ``copies`` it meets there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096 if of_rows else 64):
                batch = whole.slice(at, 4096 if of_rows else 64)
                lists = batch.column("leaves")
                which = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
                leaf = lists.flatten().to_numpy()
                number = batch.column("row").to_numpy()[which]
                own = _block_of(number, np.maximum(blocks[leaf], 1))
                for other in range(int(copies[leaf].max(initial=0))):
                    met = copies[leaf] > other
                    facing = np.full(met.sum(), other)
                    sides = [own[met], facing] if of_rows else [facing, own[met]]
                    yield _meeting(batch, which[met], [leaf[met], *sides])

    return run


_FOUND = "query long, query_id long, row long, vec_id long, score double"


def _answers(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The k nearest rows of a block for each of its queries, with exact distances."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        parts: list[list[np.ndarray]] = [[], [], [], [], []]
        if rows.num_rows and queries.num_rows:
            numbers, ids = rows.column("row").to_numpy(), rows.column("id").to_numpy()
            vectors = _matrix(rows.column("vector").combine_chunks())
            asked = _matrix(queries.column("vector").combine_chunks())
            for number, query_id, query in zip(queries.column("row").to_numpy(), queries.column("id").to_numpy(), asked):
                difference = vectors - query
                score = np.sqrt(np.einsum("ij,ij->i", difference, difference))
                near = np.arange(len(ids))
                if len(near) > k:
                    near = np.flatnonzero(score <= np.partition(score, k - 1)[k - 1])
                near = near[np.lexsort((numbers[near], ids[near], score[near]))][:k]
                found = (np.full(len(near), number), np.full(len(near), query_id), numbers[near], ids[near], score[near])
                for part, values in zip(parts, found):
                    part.append(values)
        names = ["query", "query_id", "row", "vec_id", "score"]
        kinds = [pa.int64()] * 4 + [pa.float64()]
        return pa.table([pa.array(np.concatenate(p) if p else [], kind) for p, kind in zip(parts, kinds)], names)

    return run


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEIGHBOURS,
    trees: int = TREES,
    visit: float = VISIT,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for every query, ties to smaller ids.

    Rows with a null id, and vectors that are null, zero, hold null or non-finite
    components or have another length than most, take no part. Of the rows with a
    query's id and its vector, one is the query itself and no candidate; all other
    rows are, repeated ids and copies included, and each gives an answer of its
    own. Queries that share an id are answered one by one. Copies of one vector
    weigh as one in the search.
    """
    def clean(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).where(
            F.col("id").isNotNull() & usable(F.col("vector"))
        )

    rows, asked = clean(vectors), clean(queries)
    common = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows, asked = (df.where(F.size("vector") == common["n"]) for df in (rows, asked))
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toPandas()["vector"]  # SAMPLE rows
    sample = np.stack([np.asarray(v, np.float64) for v in picked])
    rng = np.random.default_rng(SEED)
    forest = [grow(sample, rng) for _ in range(trees)]
    first = [sum(t.leaves for t in forest[:i]) for i in range(trees)]
    leaves = sum(t.leaves for t in forest)

    def written(df: DataFrame, place: Callable, label: str) -> DataFrame:
        """With a number that tells repeated rows apart, and leaves; frozen by being written."""
        kind = df.schema["vector"].dataType.simpleString()
        numbered = df.select(F.monotonically_increasing_id().alias("row"), "id", "vector")
        return materialise(numbered.mapInArrow(place, f"row long, id long, vector {kind}, leaves array<int>"), label)

    indexed = written(rows, _indexer(forest, first), "leaves")
    # one row per leaf of the forest, whose size is bounded by the sample
    by_leaf = indexed.select(F.explode("leaves").alias("leaf"), F.xxhash64("vector").alias("v"))
    sizes = by_leaf.groupBy("leaf", "v").agg(F.count("*").alias("n")).groupBy("leaf").agg(
        F.count("*").alias("distinct"), F.sum("n").alias("n")
    )
    weight, blocks, asks = np.zeros(leaves), np.zeros(leaves, np.int64), np.zeros(leaves, np.int64)
    for r in sizes.collect():
        weight[r["leaf"]] = r["distinct"]
        blocks[r["leaf"]] = -(-r["n"] // BLOCK_ROWS)
    weights = [weight[f : f + t.leaves] for f, t in zip(first, forest)]
    searched = written(asked, _searcher(forest, first, weights, visit * weights[0].sum()), "visits")
    visits = searched.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.count("*").alias("n"))
    for r in visits.collect():
        asks[r["leaf"]] = -(-r["n"] // BLOCK_QUERIES)

    left = indexed.mapInArrow(_meetings(blocks, asks, of_rows=True), MEET)
    right = searched.mapInArrow(_meetings(asks, blocks, of_rows=False), MEET)
    # one more than asked for: the query itself may be among them
    found = left.groupBy(*PLACE).cogroup(right.groupBy(*PLACE)).applyInArrow(_answers(k + 1), _FOUND)
    # the same row comes from several trees
    once = found.groupBy("query", "query_id", "row", "vec_id").agg(F.min("score").alias("score"))
    of_query = Window.partitionBy("query")
    order = F.row_number().over(of_query.orderBy("score", "vec_id", "row"))
    ranked = once.withColumn("rank", order).where(F.col("rank") <= k + 1)
    itself = F.min(F.when((F.col("vec_id") == F.col("query_id")) & (F.col("score") == 0), F.col("rank"))).over(of_query)
    others = ranked.withColumn("itself", F.coalesce(itself, F.lit(k + 1))).where(F.col("rank") != F.col("itself"))
    rank = (F.col("rank") - (F.col("rank") > F.col("itself")).cast("int")).cast("int").alias("rank")
    return others.select("query_id", rank, "vec_id", "score")
