"""Near copies by the Jaccard similarity of word shingles.

Two texts are linked when their sets of shingles have at least the given share
in common. Candidates come from SimHash first, as in ``simhash``: fingerprints
of the sets within three bits, found in buckets of three blocks out of six. A
pair at 0.8 differs in about ten of 64 bits, so MinHash bands give the
candidates out of its reach: 200 minima in 40 bands of five, so that a pair at
0.8 shares none with a chance of 1.3e-7, and a closer one with less. Every link
is verified on the exact sets. Equal sets count once, and a bucket gives one
candidate per member; only buckets that the links of both leave apart then have
their members compared with each other, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import bounded_batches
from textloom.llm.components import components
from textloom.llm.simhash import majority, near_edges, shingle_hashes
from textloom.plans.storage import materialise

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 40
ROWS = 5
# Shingles of one side of a comparison: 8 bytes each.
BLOCK_SHINGLES = 1 << 19

_FACTORS = np.array([xxhash.xxh64_intdigest(b"factor %d" % i) | 1 for i in range(BANDS * ROWS)], np.uint64)
_SHIFTS = np.array([xxhash.xxh64_intdigest(b"shift %d" % i) for i in range(BANDS * ROWS)], np.uint64)


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """Distinct shingle hashes in order; a text without words has the hash of the empty shingle."""
    return np.unique(np.array(shingle_hashes(text, shingle), np.uint64))


def buckets_of(found: np.ndarray) -> list[int]:
    """The bucket of each band; sets that agree on all minima of a band share it."""
    least = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for at in range(0, len(found), 256):  # bounded memory for very long texts
        least = np.minimum(least, (found[at : at + 256, None] * _FACTORS + _SHIFTS).min(axis=0))
    return [xxhash.xxh64_intdigest(part.tobytes(), band) for band, part in enumerate(least.reshape(BANDS, ROWS))]


def _bytes(text: pa.Scalar) -> bytes:
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def _longs(rows: list) -> pa.Array:
    flat = np.concatenate([np.asarray(r, np.uint64) for r in rows]) if rows else np.empty(0, np.uint64)
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _signatures(shingle: int) -> Column:
    def made(texts: pa.Array) -> pa.Array:
        sets = [shingle_set(_bytes(t), shingle) for t in texts]
        keys = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
        sizes = pa.array([len(s) for s in sets], pa.int64())
        prints = pa.array(np.array([majority(s) for s in sets], np.uint64).view(np.int64))
        buckets = _longs([buckets_of(s) for s in sets])
        return pa.StructArray.from_arrays([keys, sizes, prints, buckets], ["key", "size", "fp", "buckets"])

    return F.arrow_udf(_typed(made), "key binary, size long, fp long, buckets array<long>")


def _sets(shingle: int) -> Column:
    def made(texts: pa.Array) -> pa.Array:
        sets = [shingle_set(_bytes(t), shingle) for t in texts]
        keys = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
        return pa.StructArray.from_arrays([keys, _longs(sets)], ["key", "shingles"])

    return F.arrow_udf(_typed(made), "key binary, shingles array<long>")


def _typed(made: Callable[[pa.Array], pa.Array]) -> Callable[[pa.Array], pa.Array]:
    made.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return made


def _verified(pairs: DataFrame, sets: DataFrame, per_mille: int) -> DataFrame:
    """Pairs (a, b) of keys whose sets are similar."""
    left = sets.select(F.col("key").alias("a"), F.col("shingles").alias("_left"))
    right = sets.select(F.col("key").alias("b"), F.col("shingles").alias("_right"))
    both = F.size(F.array_intersect("_left", "_right"))
    either = F.size("_left") + F.size("_right") - both
    return pairs.join(right, "b").join(left, "a").where(1000 * both >= per_mille * either).select("a", "b")


def _compare(per_mille: int) -> Callable[[pa.Table], pa.Table]:
    """Edges that connect all similar sets of one group, breadth first."""

    def compare(group: pa.Table) -> pa.Table:
        keys, column = group.column("key").to_pylist(), group.column("shingles").combine_chunks()
        sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        _, flat = np.unique(column.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        left, edges = np.ones(len(keys), bool), []
        marked = np.zeros(len(flat), np.int64)
        while left.any():
            root = int(np.argmax(left))
            left[root] = False
            front = [root]
            while front and left.any():
                at = front.pop()
                own = flat[starts[at] : starts[at] + sizes[at]]
                marked[own] = 1
                both = np.add.reduceat(marked[flat], starts)
                marked[own] = 0
                near = np.flatnonzero(left & (1000 * both >= per_mille * (sizes + sizes[at] - both)))
                left[near] = False
                front += near.tolist()
                edges += [(keys[at], keys[i]) for i in near]
        return pa.table({"a": pa.array([e[0] for e in edges], pa.binary()), "b": pa.array([e[1] for e in edges], pa.binary())})

    compare.__annotations__ = {"group": pa.Table, "return": pa.Table}
    return compare


def _apart(members: DataFrame, edges: DataFrame, block_shingles: int) -> DataFrame:
    """(bucket, one, other, key): members of buckets that ``edges`` leave unconnected, dealt to pairs of blocks.

    Buckets of two are settled by their one candidate. Of buckets with the same
    members one is enough. A bucket of many shingles is cut into blocks, and
    every two blocks meet, so any two members do.
    """
    root = components(edges).select(F.col("node").alias("key"), "root")
    labelled = members.join(root, "key", "left").withColumn("root", F.coalesce("root", "key"))
    found = labelled.groupBy("bucket").agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("sum"),
        F.sum("size").alias("shingles"),
        F.min("root").alias("low"),
        F.max("root").alias("high"),
    )
    unsettled = found.where("n > 2 AND low != high").groupBy("n", "sum", "shingles").agg(F.min("bucket").alias("bucket"))
    blocks = unsettled.select("bucket", F.ceil(F.col("shingles") / block_shingles).cast("int").alias("blocks"))
    dealt = members.join(blocks, "bucket").withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
    met = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select("bucket", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("other"), "key")


def simhash_pairs(distinct: DataFrame) -> DataFrame:
    """(a, b) pairs of keys with the same fingerprint or with linked ones; each is one that its fingerprint's least key is in."""
    prints = materialise(distinct.groupBy("fp").agg(F.min("key").alias("least"), F.count("*").alias("n")), "copies-prints")
    shared = prints.where("n > 1").select("fp", "least")
    same = distinct.join(shared, "fp").where("key != least").select(F.col("least").alias("a"), F.col("key").alias("b"))
    edges = near_edges(prints.select("fp")).distinct()
    one = prints.select(F.col("fp").alias("a"), F.col("least").alias("_a"))
    other = prints.select(F.col("fp").alias("b"), F.col("least").alias("_b"))
    near = edges.join(one, "a").join(other, "b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
    return same.union(near)


def links(
    rows: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float, block_shingles: int
) -> DataFrame:
    """(a, b) edges that connect all keys of ``rows`` with similar sets."""
    per_mille = round(1000 * similarity)
    distinct = materialise(
        rows.groupBy("key").agg(
            F.min("id").alias("first"),
            F.first("size").alias("size"),
            F.first("fp").alias("fp"),
            F.first("buckets").alias("buckets"),
        ),
        "copies-distinct",
    )
    printed = materialise(simhash_pairs(distinct), "copies-printed")
    placed = distinct.select("key", "size", F.explode("buckets").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("key").alias("least")).where("n > 1")
    members = materialise(placed.join(shared.drop("n"), "bucket"), "copies-members")
    stars = members.where("key != least").select(F.col("least").alias("a"), F.col("key").alias("b")).union(printed).distinct()
    # only texts that meet another one are cut into shingles again
    met = members.select("key").union(printed.select("a")).union(printed.select("b")).distinct()
    needed = materialise(met.join(distinct.select("key", "first"), "key"), "copies-needed")
    again = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # an id can have several texts: the key tells them apart
    texts = again.join(needed.select("first").distinct(), F.col("id").eqNullSafe(F.col("first")), "left_semi")
    cut = texts.select(_sets(shingle)("text").alias("s")).select("s.key", "s.shingles")
    sets = materialise(cut.join(needed.select("key"), "key", "left_semi").dropDuplicates(["key"]), "copies-sets")
    edges = materialise(_verified(stars, sets, per_mille), "copies-edges")
    apart = _apart(members.drop("least"), edges, block_shingles).distinct().join(sets, "key")
    more = apart.groupBy("bucket", "one", "other").applyInArrow(_compare(per_mille), "a binary, b binary")
    return edges.unionByName(materialise(more.distinct(), "copies-more"))


def near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """(id, component_id): the smallest id reachable over links, one row per input row.

    Texts shorter than a shingle are one shingle as a whole; null texts and
    those without words are copies of each other. Null ids take part in links;
    a component of null ids only has a null component. Repeated rows stay.
    """
    bounded_batches(docs.sparkSession)
    made = docs.select(F.col(id_col).alias("id"), _signatures(shingle)(text_col).alias("s"))
    rows = materialise(made.select("id", "s.key", "s.size", "s.fp", "s.buckets"), "copies")
    root = components(links(rows, docs, id_col, text_col, shingle, similarity, block_shingles))
    smallest = rows.groupBy("key").agg(F.min("id").alias("first"))
    linked = smallest.join(root, smallest["key"] == root["node"], "left").select(
        "key", "first", F.coalesce("root", "key").alias("root")
    )
    lowest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = linked.join(lowest, "root").select("key", "component_id")
    return rows.select("id", "key").join(classes, "key").select(F.col("id").alias(id_col), "component_id")
