"""SentencePiece encoding and decoding by a table of distinct marked words.

No piece of the vocabulary has a whitespace marker behind another character, so
no piece crosses the start of a marked word: a run of markers with the characters
up to the next one. A text is cut there, and its ids are those of its marked
words in a row.

Documents are dealt to blocks of bounded size. A block sends each of its distinct
words once, to the bucket of its hash; equal words of all blocks meet there, are
segmented once, and their ids go back to the blocks, which put them at the
words' places. A word comes once from a block, so the most frequent one is no hot
key. Words and ids travel packed, one row per block and bucket.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import bounded_batches, fresh, without

MARK = "▁"
# Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20
# Words of a bucket remembered at a time; beyond, they are segmented again.
REMEMBERED = 1 << 20


@lru_cache(maxsize=4)
def _processor(path: str):
    from sentencepiece import SentencePieceProcessor

    made = SentencePieceProcessor(model_file=path)
    for i in range(made.get_piece_size()):
        # a piece may hold markers at its start only
        if MARK in made.id_to_piece(i).lstrip(MARK):
            raise ValueError(f"piece {i} reaches over the start of a word")
    return made


def marked_words(texts: pa.Array) -> tuple[pa.StringArray, np.ndarray]:
    """The marked words of all texts in order, and for each text where its words begin.

    A space stands for the marker, and one is put in front of every text that has a character.
    """
    plain = pc.replace_substring(pc.fill_null(texts, ""), MARK, " ")
    full = pc.if_else(pc.equal(pc.binary_length(plain), 0), "", pc.binary_join_element_wise(pa.scalar(""), plain, " "))
    full = full.cast(pa.large_string()).combine_chunks() if isinstance(full, pa.ChunkedArray) else full.cast(pa.large_string())
    ends = np.frombuffer(full.buffers()[1], np.int64)[full.offset : full.offset + len(full) + 1]
    data = np.frombuffer(full.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    space = data == 0x20
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    lengths = np.diff(ends)
    begins[ends[:-1][lengths > 0]] = True  # a text that ends in spaces does not lend them to the next one
    starts = np.flatnonzero(begins)
    words = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data)
    )
    return words, np.searchsorted(starts, ends)


def segment(words: list[str], path: str) -> list[bytes]:
    """Ids of marked words, four bytes each; the processor puts a marker of its own in front, so the first one is taken off."""
    processor = _processor(path)
    alone = processor.piece_to_id(MARK)
    found = processor.encode([w[1:] for w in words], num_threads=1)
    return [array("I", ids if len(w) > 1 else [alone]).tobytes() for w, ids in zip(words, found)]


def _packed(values: np.ndarray) -> bytes:
    """Integers below 2 to the 32nd, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel().astype(np.int64) if n else np.zeros(0, np.int64)


class _Block:
    """Rows of one block."""

    def __init__(self) -> None:
        self.batches: list[pa.RecordBatch] = []
        self.bytes = 0

    def add(self, batch: pa.RecordBatch, size: int) -> None:
        self.batches.append(batch)
        self.bytes += size

    def coded(self, text_col: str, buckets: int) -> tuple[pa.Table, np.ndarray, np.ndarray, list[list[bytes]]]:
        """(rows, first word of each text, number of every word, distinct words by bucket).

        A bucket has its words by falling frequency; word r of bucket b is number
        r * buckets + b, so that frequent words have small numbers.
        """
        rows = pa.Table.from_batches(self.batches).combine_chunks()
        words, starts = marked_words(rows.column(text_col).combine_chunks())
        coded = words.dictionary_encode()
        indices = coded.indices.to_numpy(zero_copy_only=False)
        spelled = coded.dictionary.cast(pa.large_binary()).to_pylist()
        frequent = np.argsort(-np.bincount(indices, minlength=len(spelled)), kind="stable")
        numbers = np.zeros(len(spelled), np.int64)
        table: list[list[bytes]] = [[] for _ in range(buckets)]
        for i in frequent.tolist():
            word = spelled[i]
            bucket = xxhash.xxh32_intdigest(word) % buckets
            numbers[i] = len(table[bucket]) * buckets + bucket
            table[bucket].append(word)
        return rows, starts, numbers[indices], table


def _blocks(batches: Iterator[pa.RecordBatch], text_col: str, block_bytes: int) -> Iterator[tuple[int, _Block]]:
    """Consecutive rows of a task, cut where a block is full; the same rows give the same blocks."""
    number, block = TaskContext.get().partitionId() << 33, _Block()
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = 0
        while at < batch.num_rows:
            reach = np.cumsum(sizes[at:])
            take = max(1, int(np.searchsorted(reach, block_bytes - block.bytes, side="right")))
            if block.bytes and block.bytes + reach[0] > block_bytes:
                yield number, block
                number, block = number + 1, _Block()
                continue
            block.add(batch.slice(at, take), int(reach[min(take, len(reach)) - 1]))
            at += take
    if block.batches:
        yield number, block


def _distinct_words(text_col: str, block_bytes: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(bucket, block, n, lengths, words): the distinct words of a block, a row per bucket."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in _blocks(batches, text_col, block_bytes):
            table = block.coded(text_col, buckets)[3]
            full = [b for b, words in enumerate(table) if words]
            lengths = [_packed(np.fromiter(map(len, table[b]), np.int64, len(table[b]))) for b in full]
            spelled = [pa.compress(b"".join(table[b]), codec="zstd", asbytes=True) for b in full]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(full, pa.int32()),
                    pa.array(np.full(len(full), number), pa.int64()),
                    pa.array([len(table[b]) for b in full], pa.int32()),
                    pa.array(lengths, pa.binary()),
                    pa.array(spelled, pa.binary()),
                ],
                ["bucket", "block", "n", "lengths", "words"],
            )

    return made


def _segmented(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(block, bucket, n, digest, lengths, ids) from rows sorted by bucket: a word is segmented when it first comes."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, known = None, {}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["bucket"] != current or len(known) > REMEMBERED:
                    current, known = row["bucket"], {}
                ends = np.cumsum(_unpacked(row["lengths"], row["n"]))
                data = pa.decompress(row["words"], decompressed_size=int(ends[-1]), codec="zstd", asbytes=True)
                cuts = [0, *ends.tolist()]
                words = [data[a:b] for a, b in zip(cuts, cuts[1:])]
                new = [w for w in words if w not in known]
                known.update(zip(new, segment([w.decode() for w in new], path)))
                spelled = [known[w] for w in words]
                lengths = np.fromiter(map(len, spelled), np.int64, len(spelled)) // 4
                ids = _packed(np.frombuffer(b"".join(spelled), "<u4"))
                out.append((row["block"], row["bucket"], row["n"], xxhash.xxh3_64_intdigest(data) >> 1, _packed(lengths), ids))
            if out:
                types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays(columns, ["block", "bucket", "n", "digest", "lengths", "ids"])

    return made


def _payloads(
    text_col: str, kept: list[str], block_bytes: int, buckets: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(block, digest, words, starts, numbers, payload): kept columns and word numbers of a block.

    ``digest`` checks that both readings of a block saw the same words.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in _blocks(batches, text_col, block_bytes):
            rows, starts, numbers, table = block.coded(text_col, buckets)
            digest = sum(xxhash.xxh3_64_intdigest(b"".join(words)) >> 1 for words in table if words) & MASK
            sink = pa.BufferOutputStream()
            held = rows.select(kept).append_column(_ROW, pa.array(np.diff(starts), pa.int32()))
            with pa.ipc.new_stream(sink, held.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(held, max_chunksize=1 << 16)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([digest], pa.int64()),
                    pa.array([len(numbers)], pa.int64()),
                    pa.array([_packed(numbers)], pa.binary()),
                    pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                ],
                ["block", "digest", "n", "numbers", "payload"],
            )

    return made


def _assembled(kept: list[str], buckets: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Rows of one block with the ids of their words in place."""

    def made(block: pa.Table, table: pa.Table) -> pa.Table:
        if block.num_rows != 1 or sum(table.column("digest").to_pylist()) & MASK != block.column("digest")[0].as_py():
            raise RuntimeError(NOT_ALIKE)
        # the words of all buckets in a row: where each bucket's begin, how many ids each word has, and the ids
        begin, sizes, pools, at = np.zeros(buckets, np.int64), [], [], 0
        for row in table.to_pylist():
            begin[row["bucket"]] = at
            sizes.append(_unpacked(row["lengths"], row["n"]))
            pools.append(_unpacked(row["ids"], int(sizes[-1].sum())).astype(np.int32))
            at += row["n"]
        length = np.concatenate([*sizes, np.zeros(0, np.int64)])
        pool = np.concatenate([*pools, np.zeros(0, np.int32)])
        start = np.cumsum(length) - length
        numbers = _unpacked(block.column("numbers")[0].as_py(), block.column("n")[0].as_py())
        words = begin[numbers % buckets] + numbers // buckets
        ends = np.cumsum(length[words])
        total = int(ends[-1]) if len(ends) else 0
        source = np.repeat(start[words] - (ends - length[words]), length[words])
        source += np.arange(total)
        with pa.ipc.open_stream(block.column("payload")[0].as_buffer()) as reader:
            rows = reader.read_all().combine_chunks()
        texts = np.cumsum(np.append(0, rows.column(_ROW).to_numpy()))
        bounds = np.concatenate([[0], ends])[texts]
        ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(pool[source]))
        return pa.Table.from_arrays([*[rows.column(c) for c in kept], ids], [*kept, "ids"])

    made.__annotations__ = {"block": pa.Table, "table": pa.Table, "return": pa.Table}
    return made


MASK = (1 << 63) - 1
_ROW = "ids"  # a kept column of this name is replaced by the result
NOT_ALIKE = "a block was not read twice alike: give a table that reads in one order"


def encode(
    docs: DataFrame,
    vocabulary: str,
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    buckets: int | None = None,
) -> DataFrame:
    """``docs`` without their text, with ``ids array<int>``: what the library's ``encode`` gives, no begin or end id.

    ``vocabulary`` is the path of a model file, the same on all machines, whose
    pieces do not cross whitespace markers, as is checked. ``docs`` is read
    twice and has to give its rows in one order, as a scan or a written
    table does; otherwise the job fails. Null and empty texts have no ids;
    repeated rows stay; a column named ``ids`` is replaced. Distinct words are
    dealt to ``buckets`` (by default the session's shuffle partitions), which
    should hold few enough of them for the memory of a task.
    """
    bounded_batches(docs.sparkSession)
    kept = [c for c in without(docs, ["ids"]) if c != text_col]
    others = docs.select(*[F.col(f"`{c}`") for c in kept])
    text = fresh(others, "text")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text_col).cast("string").alias(text))
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) if buckets is None else buckets
    words = rows.mapInArrow(
        _distinct_words(text, block_bytes, buckets), "bucket int, block long, n int, lengths binary, words binary"
    )
    # a bucket's rows side by side in one task
    met = words.repartition("bucket").sortWithinPartitions("bucket")
    table = met.mapInArrow(_segmented(vocabulary), "block long, bucket int, n int, digest long, lengths binary, ids binary")
    blocks = rows.mapInArrow(
        _payloads(text, kept, block_bytes, buckets), "block long, digest long, n long, numbers binary, payload binary"
    )
    schema = others.withColumn("ids", F.lit(None).cast("array<int>")).schema
    return blocks.groupBy("block").cogroup(table.groupBy("block")).applyInArrow(_assembled(kept, buckets), schema)


def decode(ids: Column, vocabulary: str) -> Column:
    """Texts of id arrays by the library's ``decode``; null has no text."""

    def made(chunks: Iterator[pa.Array]) -> Iterator[pa.Array]:
        processor = _processor(vocabulary)
        for chunk in chunks:
            cuts, flat = chunk.offsets.tolist(), chunk.values.to_numpy(zero_copy_only=False).tolist()
            valid = chunk.is_valid().to_pylist()
            rows = zip(valid, cuts, cuts[1:])
            yield pa.array([processor.decode(flat[a:b]) if has else None for has, a, b in rows], pa.string())

    made.__annotations__ = {"chunks": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(made, "string")(ids)
