"""SimHash near-duplicate components.

Fingerprints of 64 bits are linked when they differ in at most three. Six
blocks of bits are formed; three differing bits leave at least three blocks
alone, so every linked pair agrees on one of the 20 choices of three blocks.
Distinct fingerprints meet in buckets keyed by such a choice and its bits, are
verified there, and leave as one edge per fingerprint, never as pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import bounded_batches, fresh
from textloom.llm.components import components
from textloom.plans.lookup import spread_join
from textloom.plans.storage import discard, materialise

SHINGLE = 3
SEED = 42
MAX_BITS = 3
BLOCKS = 6
# A bucket of more distinct fingerprints is cut by the remaining bits before it is compared.
COMPARE_AT_ONCE = 1024


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> list[int]:
    """Hashes of all word shingles of one UTF-8 text, in order; fewer words are one shingle."""
    found = text.lower().split()  # of bytes: A-Z only, ASCII white space only
    joined = b" ".join(found)
    digest = xxhash.xxh64_intdigest
    if len(found) <= shingle:
        return [digest(joined, SEED)]
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(found) - shingle + 1].tolist()
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())]


def fingerprint_of(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of one UTF-8 text, unsigned."""
    if not text.strip():
        return 0
    return majority(np.array(shingle_hashes(text, shingle), dtype="<u8"))


def majority(rows: np.ndarray) -> int:
    """The bits that over half of the hashes have."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(rows), 65_536):  # bounded memory for very long texts
        bits = np.unpackbits(rows[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(rows), bitorder="little").view("<u8")[0])


def _fingerprints(texts: pa.Array) -> pa.Array:
    made = np.fromiter(
        (fingerprint_of(t.as_buffer().to_pybytes()) if t.is_valid else 0 for t in texts), np.uint64, len(texts)
    )
    return pa.array(made.view(np.int64))


def fingerprint(text: Column) -> Column:
    """64-bit fingerprint as a long; null and texts without words have zero."""
    return F.arrow_udf(_fingerprints, "long")(text)


def as_hex(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def _block_masks(bits: list[int], blocks: int = BLOCKS, alike: int = BLOCKS - MAX_BITS) -> list[int]:
    """Masks of every choice of ``alike`` blocks out of the given bit places."""
    parts = [sum(1 << int(b) for b in part) for part in np.array_split(np.array(bits), blocks)]
    return [sum(choice) for choice in combinations(parts, alike)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _roots(prints: np.ndarray, free: int = (1 << 64) - 1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges (fingerprint, another of its component) among fingerprints equal outside ``free``.

    Up to COMPARE_AT_ONCE are compared with each other. More are dealt to
    sub-buckets by blocks of the free bits, by the same rule as above, until
    few are left or the bits are used up.
    """
    if len(prints) < 2:
        return
    places = [b for b in range(64) if free >> b & 1]
    if len(prints) <= COMPARE_AT_ONCE or len(places) < 2 * BLOCKS:
        left = prints.copy()
        while len(left):  # breadth first from the first one left
            root, front, left = left[0], left[:1], left[1:]
            while len(front) and len(left):
                near = np.zeros(len(left), bool)
                for at in range(0, len(front), 256):
                    near |= (np.bitwise_count(front[at : at + 256, None] ^ left[None]) <= MAX_BITS).any(axis=0)
                front, left = left[near], left[~near]
                if len(front):
                    yield front, np.full(len(front), root)
        return
    for mask in _block_masks(places):
        keys = prints & np.uint64(mask)
        order = np.argsort(keys, kind="stable")
        cuts = np.flatnonzero(np.diff(keys[order])) + 1
        for group in np.split(prints[order], cuts):
            yield from _roots(group, free & ~mask)


def _bucket_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of each bucket; rows come sorted by (choice, key)."""
    masks = np.array(_block_masks(list(range(64))), np.uint64)

    def edges(choice: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys = prints & masks[choice]
        cuts = np.flatnonzero((np.diff(keys) != 0) | (np.diff(choice) != 0)) + 1
        starts, ends = np.append(0, cuts), np.append(cuts, len(prints))
        for k in np.flatnonzero(ends - starts > 1).tolist():
            for a, b in _roots(prints[starts[k] : ends[k]], ~int(masks[choice[starts[k]]]) & ((1 << 64) - 1)):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        choice = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        prints = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(choice):
            continue
        if held:
            last_choice, last_print = held[-1][0][-1], held[-1][1][-1]
            same = (choice == last_choice) & (prints & masks[last_choice] == last_print & masks[last_choice])
            stay = len(same) if same.all() else int(np.argmin(same))
            if stay == len(same):
                held.append((choice, prints))
                continue
            held.append((choice[:stay], prints[:stay]))
            yield from edges(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            held, choice, prints = [], choice[stay:], prints[stay:]
        # the last bucket may go on in the next batch
        key = prints & masks[choice]
        differs = np.flatnonzero((key != key[-1]) | (choice != choice[-1]))
        cut = int(differs[-1]) + 1 if len(differs) else 0
        if cut:
            yield from edges(choice[:cut], prints[:cut])
        held = [(choice[cut:], prints[cut:])]
    if held:
        yield from edges(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))


def near_edges(prints: DataFrame, column: str = "fp") -> DataFrame:
    """(a, b) edges that connect all distinct fingerprints within MAX_BITS of each other."""
    masks = _block_masks(list(range(64)))
    keys = F.array(
        *[
            F.struct(F.lit(i).alias("choice"), F.col(column).alias("fp"), F.col(column).bitwiseAND(F.lit(_signed(m))).alias("key"))
            for i, m in enumerate(masks)
        ]
    )
    buckets = prints.select(F.inline(keys)).repartition("choice", "key").sortWithinPartitions("choice", "key")
    return buckets.select("choice", "fp").mapInArrow(_bucket_edges, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long, component_id): the smallest id reachable over links, one row per input row.

    Copies share one fingerprint and are linked once. Null and empty texts have
    fingerprint zero and are linked like any other. Null ids take part in links;
    a component of null ids only has a null component. Repeated rows stay.
    """
    bounded_batches(docs.sparkSession)
    made = docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col)).alias("fp"))
    rows = materialise(made, "simhash")
    distinct = materialise(rows.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    edges = materialise(near_edges(distinct).distinct(), "simhash-edges")
    root = components(edges)
    discard(edges)
    linked = distinct.join(root, distinct["fp"] == root["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = linked.join(smallest, "root").select("fp", "component_id")
    # copies share a fingerprint, and one of them may stand in a third of all rows
    return spread_join(rows, classes, "fp", ["id"]).select(F.col("id").alias(id_col), "fp", "component_id")


def keep_first(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    find: Callable[[DataFrame, str, str], DataFrame] = near_duplicates,
) -> DataFrame:
    """One row of each component that ``find`` gives: the one with the smallest id.

    Rows that share an id are one document: it stays if any of them is the first
    of its component, as one row. Rows with a null id have no order and all stay.
    """
    found = find(docs, id_col, text_col).where(F.col(id_col).isNotNull())
    key = fresh(docs, "_id")
    by_id = found.groupBy(F.col(id_col).alias(key)).agg(
        F.min(F.col(id_col) - F.col("component_id")).alias("_after"), F.count("*").alias("_rows")
    )
    fate = materialise(by_id.where((F.col("_after") > 0) | (F.col("_rows") > 1)), "simhash-fate")
    same = F.col(id_col) == F.col(key)
    plain = docs.join(fate.select(key), same, "left_anti")
    repeated = docs.join(fate.where("_after = 0").select(key), same, "left_semi")
    return plain.unionByName(repeated.dropDuplicates([id_col]))
