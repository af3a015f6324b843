"""Finding repeated windows of a corpus without listing them.

A window is W consecutive tokens (words or bytes) of one document. Each window
selects one gram of K tokens inside it, the one with the smallest hash
(winnowing), so equal windows select equal grams at the same place. Neighbouring
windows that select the same gram form a *block*; equal windows lie in blocks of
the same gram. A corpus has a few blocks per W tokens, and only they are
shuffled, as fixed-width rows without their tokens.

``settle`` sorts the blocks of each gram. Equal blocks settle each other at
once; what remains are blocks of a gram that differ somewhere, the ends of
repeats, which the operators compare with an index.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import bounded_batches, placed, rank_from
from textloom.plans.storage import materialise

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
# Tokens hashed at once; more are cut with an overlap. Places inside fit 20 bits.
CHUNK = 1 << 18
PLACE = np.uint64((1 << 20) - 1)
# Differing blocks of one gram that are compared by an index; more are cut into windows.
COMPARED = 4096

#: What a row of ``meet`` is: a block that waits for others, or one whose windows are all repeated.
WAITS, REPEATED = 0, 1
#: What ``settle`` says of a block: all its windows are repeated, compare it, or cut it into windows.
SETTLED, COMPARE, CUT = 1, 2, 3

BLOCK_COLUMNS = ["gram", "content", "doc", "span"]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64; computed once for the longest chunk."""
    if not _powers or len(_powers[0]) < n:
        up = np.full(max(n, CHUNK + 1), BASE, np.uint64)
        down = np.full(len(up), INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0][:n], _powers[1][:n]


def span_hashes(codes: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function (starts, ends) to 64-bit hashes of those stretches of ``codes``."""
    up, down = powers(len(codes) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(codes * up[:-1])])
    return lambda starts, ends: mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(values) - width + 1
    pad = -len(values) % width
    padded = np.concatenate([values, np.full(pad, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


@dataclass
class Blocks:
    gram: np.ndarray  # hash of the selected gram
    content: np.ndarray  # hash of the block's tokens, its windows and the place of the gram
    doc: np.ndarray  # place of the document in the input
    start: np.ndarray  # first window, as a token of the document
    windows: np.ndarray  # number of windows


def find_blocks(
    tokens: np.ndarray, ends: np.ndarray, window: int, gram: int, lift: Callable[[np.ndarray], np.ndarray]
) -> Blocks:
    """Blocks of documents laid end to end; ``lift`` turns tokens into uniform 64-bit codes."""
    parts: list[tuple[np.ndarray, ...]] = []
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    first = 0
    while first < len(ends):
        # whole documents up to a chunk, or a longer one in overlapping parts
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + CHUNK, side="right")))
        lo, hi = int(starts[first]), int(ends[last - 1])
        at = lo
        while True:
            stop = min(hi, at + CHUNK)
            parts.append(_chunk_blocks(lift(tokens[at:stop]), ends[first:last] - at, starts[first:last] - at, first, window, gram))
            if stop == hi:
                break
            at = stop - window + 1
        first = last
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5
    return Blocks(*columns)


def _chunk_blocks(codes, ends, starts, first, window, gram) -> tuple[np.ndarray, ...]:
    n = len(codes) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    hashes = span_hashes(codes)
    at = np.arange(len(codes) - gram + 1)
    grams = hashes(at, at + gram)
    # of equal grams the last one is selected: smaller value for the larger place
    ranked = (grams & ~PLACE) | (PLACE - at.astype(np.uint64))
    least = sliding_min(ranked, window - gram + 1)
    chosen = (PLACE - (least & PLACE)).astype(np.int64)
    # a block begins where another gram is selected, where a document begins and behind its last window
    begins = np.empty(n, bool)
    begins[0] = True
    np.not_equal(chosen[1:], chosen[:-1], out=begins[1:])
    firsts, behind = np.maximum(starts, 0), ends - window + 1
    begins[firsts[firsts < n]] = True
    begins[behind[(behind >= 0) & (behind < n)]] = True
    s0 = np.flatnonzero(begins)
    count = np.diff(np.append(s0, n))
    doc = np.searchsorted(ends, s0, side="right")
    valid = s0 + window <= ends[np.minimum(doc, len(ends) - 1)]
    s0, count, doc = s0[valid], count[valid], doc[valid]
    if not len(s0):
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    anchor = chosen[s0]
    inner = hashes(s0, s0 + count + window - 1)
    content = mixed(inner + mixed((anchor - s0).astype(np.uint64)))
    return grams[anchor], content, doc + first, s0 - starts[doc], count


def packed_span(start: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """First window and number of windows (below 4096) in one number that sorts by the first."""
    return start << 12 | windows


def unpacked(span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return span >> 12, span & 4095


def within_task(rows: list[np.ndarray], first_stays: bool) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Blocks of one task before they are shuffled: only one of equal blocks has to wait.

    ``first_stays``: the first block is an original; otherwise every one of
    several equal blocks is repeated.
    """
    gram, content, doc, span = rows
    order = np.lexsort((span, doc, content, gram))
    gram, content, doc, span = (c[order] for c in (gram, content, doc, span))
    new = np.concatenate([[True], (np.diff(gram) != 0) | (np.diff(content) != 0)])[: len(gram)]
    yield WAITS, [gram[new], content[new], doc[new], span[new]]
    again = ~new
    if not first_stays:
        again[:-1] |= ~new[1:]
    yield REPEATED, [gram[again], content[again], doc[again], span[again]]


def as_batch(kind: int, columns: list[np.ndarray]) -> pa.RecordBatch:
    """Rows (kind, gram, content, doc, span) with unsigned hashes as longs."""
    arrays = [pa.array(np.full(len(columns[0]), kind, np.int8))]
    arrays += [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64)) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, ["kind", *BLOCK_COLUMNS])


def numbered(
    docs: DataFrame, id_col: str, text_col: str, carry: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame | None]:
    """(rows (doc, text, *carry), ids): ``doc`` tells rows apart and sorts them as the ids do.

    Unique ids serve themselves, and ids is None. If ids repeat or are null, rows
    are numbered in (id, text) order, nulls first; ids maps numbers back.
    """
    column = F.col(id_col)
    counts = docs.groupBy(column.alias("i")).agg(F.count("*").alias("n"))
    if not counts.where("n > 1 OR i IS NULL").limit(1).count():
        return docs.select(column.alias("doc"), F.col(text_col).alias("text"), *carry), None
    named = docs.select(column.alias("_doc_id"), F.col(text_col).alias("text"), *carry)
    rows = placed(named, ["_doc_id", "text"], "numbered")
    made = materialise(rank_from(rows, [], "doc"), "numbered")
    return made.select("doc", "text", *carry), made.select("doc", F.col("_doc_id").alias("id"))


MEET_SCHEMA = "kind byte, gram long, content long, doc long, span long"


def settle(rows: DataFrame, first_stays: bool) -> DataFrame:
    """(kind, gram, content, doc, span) for blocks that are SETTLED, to COMPARE or to CUT.

    ``rows`` come from ``within_task`` of all tasks. They meet by gram. Rows that
    are repeated already pass through, dealt by document.
    """
    key = F.when(F.col("kind") == WAITS, F.col("gram")).otherwise(F.xxhash64("doc", "span"))
    dealt = rows.withColumn("key", key).repartition("key")
    order = ["gram", "content", "doc", "span"]
    return dealt.sortWithinPartitions("kind", *order).drop("key").mapInArrow(_settler(first_stays), MEET_SCHEMA)


def _settler(first_stays: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def columns_of(batch: pa.RecordBatch) -> list[np.ndarray]:
        return [batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 5)]

    def decide(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Whole grams."""
        gram, content, doc, span = columns
        new_gram = np.concatenate([[True], np.diff(gram) != 0])
        new_block = new_gram | np.concatenate([[True], np.diff(content) != 0])
        again = ~new_block
        if not first_stays:
            again[:-1] |= ~new_block[1:]
        yield as_batch(SETTLED, [c[again] for c in columns])
        which = np.cumsum(new_gram) - 1
        differing = np.bincount(which[new_block], minlength=which[-1] + 1)
        compare = new_block & (differing[which] > 1) & (differing[which] <= COMPARED)
        yield as_batch(COMPARE, [c[compare] for c in columns])
        cut = new_block & (differing[which] > COMPARED)
        yield as_batch(CUT, [c[cut] for c in columns])

    def cut(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Whole blocks of a gram that has too many differing ones to hold."""
        new = np.concatenate([[True], np.diff(columns[1]) != 0])
        again = ~new
        if not first_stays:
            again[:-1] |= ~new[1:]
        yield as_batch(SETTLED, [c[again] for c in columns])
        yield as_batch(CUT, [c[new] for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        cutting = False  # the gram held last is being cut; only its last block is held
        for batch in batches:
            kind = batch.column(0).to_numpy(zero_copy_only=False)
            waits = int((kind == WAITS).sum())  # they come first
            if waits < len(kind):
                yield as_batch(SETTLED, columns_of(batch.slice(waits)))
            if not waits:
                continue
            held.append(columns_of(batch.slice(0, waits)))
            size += waits
            if size < 1 << 16:
                continue
            joined = [np.concatenate(c) for c in zip(*held)]
            if cutting:
                stop = int(np.searchsorted(joined[0], joined[0][0], side="right"))
                if stop < len(joined[0]):
                    yield from cut([c[:stop] for c in joined])
                    joined, cutting = [c[stop:] for c in joined], False
            edge = int(np.searchsorted(joined[0], joined[0][-1]))  # the last gram may go on
            if edge:
                yield from decide([c[:edge] for c in joined])
            tail = [c[edge:] for c in joined]
            if cutting or 1 + int((np.diff(tail[1]) != 0).sum()) > COMPARED:
                last = int(np.searchsorted(tail[1], tail[1][-1]))  # and so may its last block
                if last:
                    yield from cut([c[:last] for c in tail])
                    tail, cutting = [c[last:] for c in tail], True
            held, size = [tail], len(tail[0])
        if size:
            joined = [np.concatenate(c) for c in zip(*held)]
            stop = int(np.searchsorted(joined[0], joined[0][0], side="right")) if cutting else 0
            if stop:
                yield from cut([c[:stop] for c in joined])
            if stop < len(joined[0]):
                yield from decide([c[stop:] for c in joined])

    return run


@dataclass(frozen=True)
class Tokens:
    """How texts become tokens, and windows over them."""

    window: int
    gram: int
    first_stays: bool
    # UTF-8 texts of a batch to (tokens, end of every text)
    read: Callable[[], Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]]
    lift: Callable[[np.ndarray], np.ndarray]
    # (text) -> function (first token, one past the last) to the bytes of that stretch
    stretch: Callable[[bytes], Callable[[int, int], bytes]]
    # (grams, [(doc, first window, windows, bytes)]) -> repeated windows as (doc, span)
    compare: Callable[[list[tuple[int, int, int, bytes]]], list[tuple[int, int]]]
    shard: int  # bytes compared at once


def raw(value: pa.Scalar) -> bytes:
    return value.as_buffer().to_pybytes() if value.is_valid else b""


def _block_rows(tokens: Tokens) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = tokens.read()
        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            texts = batch.column("text")
            ids = batch.column("doc").to_numpy(zero_copy_only=False)
            at = 0
            while at < len(ids):
                some, length, first = [], 0, at
                while at < len(ids) and length < 2 << 20:  # a few megabytes of text at a time
                    some.append(raw(texts[at]))
                    length += len(some[-1])
                    at += 1
                found = find_blocks(*read(some), tokens.window, tokens.gram, tokens.lift)
                held.append([found.gram, found.content, ids[first + found.doc.astype(np.int64)], packed_span(found.start, found.windows)])
                size += len(found.gram)
            if size > 1 << 19:
                yield from _combined(held, tokens.first_stays)
                held, size = [], 0
        if size:
            yield from _combined(held, tokens.first_stays)

    return run


def _combined(held: list[list[np.ndarray]], first_stays: bool) -> Iterator[pa.RecordBatch]:
    for kind, columns in within_task([np.concatenate(c) for c in zip(*held)], first_stays):
        for at in range(0, len(columns[0]), 1 << 16):
            yield as_batch(kind, [c[at : at + (1 << 16)] for c in columns])


def _open_blocks(tokens: Tokens) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks with their bytes, or the windows of blocks to cut, from (doc, text, blocks)."""

    def rows(doc: int, block: dict, stretch: Callable[[int, int], bytes]) -> Iterator[tuple]:
        first, n = unpacked(block["span"])
        if block["kind"] == COMPARE:
            yield COMPARE, block["gram"], doc, block["span"], stretch(first, first + n - 1 + tokens.window)
        else:
            for start in range(first, first + n):
                yield CUT, 0, doc, packed_span(start, 1), stretch(start, start + tokens.window)

    kinds = [pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def batch_of(made: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*made), kinds)]
        return pa.RecordBatch.from_arrays(columns, ["kind", "gram", "doc", "span", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[tuple] = []
            size = 0
            for doc, text, blocks in zip(batch.column("doc").to_pylist(), batch.column("text"), batch.column("blocks")):
                stretch = tokens.stretch(raw(text))
                for block in blocks.as_py():
                    for row in rows(doc, block, stretch):
                        made.append(row)
                        size += len(row[4])
                    if size > 4 << 20:
                        yield batch_of(made)
                        made, size = [], 0
            if made:
                yield batch_of(made)

    return run


def _compared(tokens: Tokens) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Repeated windows among blocks that come sorted by gram; an index holds whole grams."""

    def batch_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
        docs, spans = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(spans, pa.int64())], ["doc", "span"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple[int, int, int, bytes]] = []
        size, last = 0, None
        for batch in batches:
            for gram, doc, span, body in zip(*[c.to_pylist() for c in batch.columns]):
                if gram != last and size > tokens.shard:
                    yield batch_of(tokens.compare(shard))
                    shard, size = [], 0
                last = gram
                shard.append((doc, *unpacked(span), body))
                size += len(body)
        if shard:
            yield batch_of(tokens.compare(shard))

    return run


def repeated_windows(rows: DataFrame, tokens: Tokens) -> DataFrame:
    """(doc, spans): the repeated windows of every document of ``rows`` (doc, text) that has some."""
    bounded_batches(rows.sparkSession)
    blocks = rows.mapInArrow(_block_rows(tokens), MEET_SCHEMA)
    met = materialise(settle(blocks, tokens.first_stays), "windows-met")
    open_blocks = met.where(F.col("kind") != SETTLED)
    rows = rows.select("doc", "text")
    by_doc = open_blocks.groupBy("doc").agg(F.collect_list(F.struct("kind", "gram", "span")).alias("blocks"))
    opened = materialise(
        rows.join(by_doc, "doc").select("doc", "text", "blocks").mapInArrow(
            _open_blocks(tokens), "kind byte, gram long, doc long, span long, body binary"
        ),
        "windows-open",
    )
    compare = opened.where(F.col("kind") == COMPARE).select("gram", "doc", "span", "body")
    compared = (
        compare.repartition("gram").sortWithinPartitions("gram", "doc", "span").mapInArrow(_compared(tokens), "doc long, span long")
    )
    # windows cut from hot grams meet by their bytes; equal ones are summed up before they are shuffled
    cut = opened.where(F.col("kind") == CUT).select(F.sha2("body", 256).alias("window"), F.struct("doc", "span").alias("at"))
    seen = cut.groupBy("window").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1")
    again = cut.join(seen, "window")
    if tokens.first_stays:
        again = again.where(F.col("at") != F.col("first"))
    parts = [met.where(F.col("kind") == SETTLED).select("doc", "span"), compared, again.select("at.doc", "at.span")]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("doc").agg(F.collect_list("span").alias("spans"))


def covered(spans: list[int], window: int, size: int) -> np.ndarray:
    """True for the tokens of a document that lie in one of its repeated windows."""
    first, n = unpacked(np.array(spans, np.int64))
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, first + n - 1 + window, -1)
    return np.cumsum(steps[:-1]) > 0
