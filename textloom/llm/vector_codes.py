"""Vector codes: integer components, a codebook per part, one byte per part.

Components are made integers once, so a dimension has few distinct values. A
batch of vectors is dictionary-coded per dimension; for every distinct integer the
squared differences to all entries of its part's codebook are tabulated, and the
distances of a part are gathers from these tables by code, added up over the
part's dimensions. Codebooks are a bounded model on the driver; vectors
stay in their partitions, and a round of training sends one row of sums per
task and entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.plans.lookup import lookup_join
from textloom.plans.storage import materialise

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
# Vectors of a batch that are coded and measured at once.
BLOCK = 8192
# Sums of squared differences of integers up to this size stay within 64 bits; beyond, Python integers are used.
SAFE = 1 << 26
LONG_MAX = (1 << 63) - 1
# Sums leave a task in two pieces: components of any finite float fit.
LIMB = 10**18

Codebooks = list[np.ndarray]  # per part: entries x components, integers


def usable(vectors: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector is there and holds finite numbers only."""
    values = F.col(vector_col).cast("array<double>")
    odd = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(vector_col).isNotNull() & ~odd)


def integers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x); of Python integers where 64 bits would not do."""
    low = np.floor(values.astype(np.float64) * SCALE)
    if low.size and np.abs(low).max() > SAFE:
        flat = [int(x) for x in np.floor(values.astype(np.longdouble) * SCALE).ravel()]
        return np.array(flat, object).reshape(low.shape)
    return low.astype(np.int64)


def distances(dictionary: list[np.ndarray], codes: list[np.ndarray], book: np.ndarray) -> np.ndarray:
    """Squared distances (vectors x entries) of one part, from the dictionaries and codes of its dimensions."""
    total = None
    for d, (values, code) in enumerate(zip(dictionary, codes)):
        table = (values[:, None] - book[None, :, d]) ** 2  # distinct integers x entries
        total = table[code] if total is None else total + table[code]
    return total


def nearest(block: np.ndarray, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """Entry (vectors x parts, the lower on ties) and squared distance of every part."""
    width = books[0].shape[1]
    if any(b.dtype == object for b in books) and block.dtype != object:
        block = block.astype(object)
    entry = np.zeros((len(block), len(books)), np.int64)
    error = np.zeros((len(block), len(books)), block.dtype)
    for p, book in enumerate(books):
        coded = [_dictionary(block[:, p * width + d]) for d in range(width)]
        measured = distances([c[0] for c in coded], [c[1] for c in coded], book)
        entry[:, p] = np.argmin(measured, axis=1)  # the first of equal ones
        error[:, p] = measured[np.arange(len(block)), entry[:, p]]
    return entry, error


def _dictionary(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(column, return_inverse=True)


def _blocks(batches: Iterator[pa.RecordBatch], column: str, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of vectors of ``dims`` components, as integers; vectors of another length are left out."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            lists = part.column(column)
            part = part.filter(pa.compute.equal(pa.compute.list_value_length(lists), dims))
            if part.num_rows:
                flat = part.column(column).flatten().to_numpy(zero_copy_only=False)
                yield part, integers(flat.reshape(-1, dims))


def _sum_up(books: Codebooks, column: str, dims: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task: (part, entry, position, high, low, n) of the parts assigned to each entry; the sum is high * LIMB + low."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = dims // len(books)
        sums: dict[tuple[int, int, int], int] = {}
        counts: dict[tuple[int, int], int] = {}
        for _, block in _blocks(batches, column, dims):
            entry, _ = nearest(block, books)
            for p in range(len(books)):
                for e in np.unique(entry[:, p]).tolist():
                    mine = block[entry[:, p] == e, p * width : (p + 1) * width]
                    counts[p, e] = counts.get((p, e), 0) + len(mine)
                    for d, s in enumerate(mine.sum(axis=0).tolist()):
                        sums[p, e, d] = sums.get((p, e, d), 0) + s
        keys = list(sums)
        yield pa.RecordBatch.from_arrays(
            [
                *[pa.array([k[i] for k in keys], pa.int32()) for i in range(3)],
                pa.array([str(sums[k] // LIMB) for k in keys], pa.string()),
                pa.array([sums[k] % LIMB for k in keys], pa.int64()),
                pa.array([counts[k[:2]] for k in keys], pa.int64()),
            ],
            ["part", "entry", "position", "high", "low", "n"],
        )

    return made


def _table(flat: list[list[int]]) -> np.ndarray:
    big = any(abs(x) > SAFE for row in flat for x in row)
    return np.array(flat, object if big else np.int64)


def first_codebooks(kept: DataFrame, id_col: str, vector_col: str, parts: int, entries: int) -> Codebooks:
    """The parts of the vectors with the smallest ids, ascending; equal ids by their vectors, null ids left out.

    The first of them sets the number of components; vectors of another length take no part.
    """
    plain = kept.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    head = plain.orderBy("id", "v").limit(1).collect()
    if not head:
        return []
    dims = len(head[0]["v"])
    if dims == 0 or dims % parts:
        raise ValueError(f"vectors of {dims} components cannot be cut into {parts} equal parts")
    # ENTRIES rows, whatever the table
    rows = plain.where(F.size("v") == dims).orderBy("id", "v").limit(entries).collect()
    block = integers(np.array([r["v"] for r in rows], np.float64))
    return [_table(b.tolist()) for b in np.split(block, parts, axis=1)]


def train(
    kept: DataFrame, id_col: str, vector_col: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codebooks:
    """Codebooks after ``rounds`` of assigning all vectors and moving entries to the floor of their means."""
    books = first_codebooks(kept, id_col, vector_col, parts, entries)
    if not books:
        return books
    dims = parts * books[0].shape[1]
    for _ in range(rounds):
        partial = kept.select(vector_col).mapInArrow(
            _sum_up(books, vector_col, dims), "part int, entry int, position int, high string, low long, n long"
        )
        limbs = [F.sum(F.col(c).cast("decimal(38,0)")).cast("string").alias(c) for c in ("high", "low")]
        # at most parts * entries * components rows
        rows = partial.groupBy("part", "entry", "position").agg(*limbs, F.sum("n").alias("n")).collect()
        flat = [b.tolist() for b in books]
        for r in rows:
            flat[r["part"]][r["entry"]][r["position"]] = (int(r["high"]) * LIMB + int(r["low"])) // r["n"]
        books = [_table(b) for b in flat]
    return books


def books_digest(books: Codebooks) -> str:
    """sha256 of all components as decimals, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for row in b.tolist() for x in row).encode()).hexdigest()


def encode(kept: DataFrame, books: Codebooks, vector_col: str, others: list[str]) -> DataFrame:
    """Columns ``others``, ``code`` (binary, a byte per part) and ``error`` of every vector.

    An error beyond the range of a long is given as its largest value.
    """
    rows = kept.select(*others, vector_col)
    if not books:
        return rows.limit(0).select(*others, F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))
    dims = len(books) * books[0].shape[1]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in _blocks(batches, vector_col, dims):
            entry, error = nearest(block, books)
            codes = [row.tobytes() for row in entry.astype(np.uint8)]
            summed = [min(LONG_MAX, int(x)) for x in error.sum(axis=1).tolist()]
            kept_columns = [batch.column(c) for c in others]
            yield pa.RecordBatch.from_arrays(
                [*kept_columns, pa.array(codes, pa.binary()), pa.array(summed, pa.int64())], [*others, "code", "error"]
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in others]
    return rows.mapInArrow(made, ", ".join([*fields, "code binary", "error long"]))


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256), a row per vector that takes part.

    Vectors that are null or hold null or non-finite components do not. The
    codebooks begin with the ``entries`` smallest ids (at most 256); fewer vectors
    make smaller codebooks, and none give no rows. Equal and null ids are
    vectors of their own; null ids do not begin a codebook. ``label_error`` is
    the error summed over equal labels, nulls together. Other columns are left out.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code is a byte: 1 to 256 entries")
    kept = usable(vectors, vector_col).select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")
    )
    books = train(kept, "vec_id", "vector", parts, entries, rounds)
    coded = materialise(encode(kept, books, "vector", ["vec_id", "label"]), "vector-codes")
    # null labels need a key that equals itself
    keyed = coded.withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")))
    summed = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")
    by_label = materialise(keyed.groupBy("_key").agg(summed.alias("label_error")), "vector-labels")
    joined = lookup_join(keyed, by_label, ["_key"], salt_by=["vec_id", "code"])
    return joined.drop("_key").withColumn("codebooks_sha256", F.lit(books_digest(books)))
