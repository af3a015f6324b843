"""Best-fit-decreasing packing of tokenised documents into sequences.

Pieces of one length are interchangeable, so the packing is decided on the
histogram of lengths, which has at most as many entries as a sequence has
tokens. A segment tree over remaining capacities finds the tightest open
sequence; a run of sequences with equal contents is handled as one. The plan
that results equals best-fit decreasing over all pieces of the corpus, and its
size is bounded by the sequence length, not by the corpus. Pieces then look up
their place by their rank among pieces of the same length.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import bounded_batches, fresh, placed, rank_from, without
from textloom.plans.storage import materialise

CAPACITY = 2048
SEPARATOR = 0
# Words remembered by one task, those of a task that packs whole documents besides, and the longest kept.
MEMORY = 350_000
PACK_MEMORY = 100_000
LONG_WORD = 48
# Marks that part from the letters before them, and the first character beyond plain Latin letters.
MARKS = ".,;:!?"
PLAIN = "\u0250"


class Tightest:
    """Segment tree over remaining capacities: how many runs are open at each."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, remaining: int, n: int) -> None:
        at = self.size + remaining
        while at:
            self.count[at] += n
            at >>= 1

    def find(self, least: int) -> int | None:
        """The smallest remaining capacity of at least ``least`` that is open."""
        at = self.size + least
        while not self.count[at]:
            while at & 1:  # a right child: nothing further right below its parent
                at >>= 1
                if at <= 1:
                    return None
            at += 1
        while at < self.size:
            at = 2 * at if self.count[2 * at] else 2 * at + 1
        return at - self.size


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing on a length histogram.

    Rows (length, first, last, sequence, per, offset): pieces of ``length`` with
    rank r in [first, last) go to sequence ``sequence + (r - first) // per`` at
    ``offset + (r - first) % per * length``.
    """
    tree = Tightest(capacity)
    runs: dict[int, list[tuple[int, int]]] = {}  # remaining -> (first sequence, number), equal contents
    rows, opened = [], 0

    def open_run(remaining: int, first: int, n: int) -> None:
        if n and remaining:
            runs.setdefault(remaining, []).append((first, n))
            tree.add(remaining, 1)

    for length in sorted((x for x in histogram if x > 0), reverse=True):
        rank, left = 0, histogram[length]
        while left:
            remaining = tree.find(length)
            if remaining is None:
                remaining, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            else:
                first, n = runs[remaining].pop()
                tree.add(remaining, -1)
            # the sequence just used stays the tightest as long as it has room
            per = remaining // length
            full, rest = divmod(min(left, n * per), per)
            placed_now = full * per + rest
            rows.append((length, rank, rank + placed_now, first, per, capacity - remaining))
            open_run(remaining - per * length, first, full)
            if rest:
                open_run(remaining - rest * length, first + full, 1)
            open_run(remaining, first + full + bool(rest), n - full - bool(rest))
            rank += placed_now
            left -= placed_now
    return rows


class _WordIds(dict):
    """Token ids of words (runs without ASCII white space), remembered while there is room.

    Most words are letters with a few marks behind them. The vocabulary's pattern
    keeps a run of letters together and the marks apart, and its normaliser only
    lower-cases them, so the letters go to the merges directly. Anything else
    takes the tokenizer's whole way.
    """

    def __init__(self, path: str, remembered: int):
        from tokenizers import Tokenizer

        super().__init__()
        self.remembered = remembered
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        self.marks: dict[str, bytes] = {"": b""}
        # the vocabulary spells bytes as characters; printable ASCII stands for itself
        self.spelling = {i: c for i, c in enumerate(_byte_characters())}

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, word: bytes) -> bytes:
        text = word.decode()
        letters = text.rstrip(MARKS)
        low = letters.lower()
        if not low.isalpha():
            return self._whole(text)
        if not low.isascii():
            if max(low) >= PLAIN or len(low) != len(letters) or not is_normalized("NFC", letters):
                return self._whole(text)
            low = low.encode().decode("latin-1").translate(self.spelling)
        marks = text[len(letters) :]
        if marks not in self.marks:
            if len(self.marks) > 1000:
                return self._whole(text)
            self.marks[marks] = self._whole(marks)
        return array("I", [t.id for t in self.merges(low)]).tobytes() + self.marks[marks]

    def __missing__(self, word: bytes) -> bytes:
        made = self._learn(word)
        if len(self) < self.remembered and len(word) <= LONG_WORD:
            self[word] = made
        return made


def _byte_characters() -> list[str]:
    """How a byte-level vocabulary spells the 256 bytes: printable Latin-1 as itself, the others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


def text_encoder(path: str, remembered: int = MEMORY) -> Callable[[bytes], np.ndarray]:
    """A function from UTF-8 text to token ids, without special tokens.

    The vocabulary drops white space, and neither its pattern nor its normaliser
    reaches over it, so a text is the concatenation of its words, each of which
    is encoded once per task.
    """
    ids = _WordIds(path, remembered)
    return lambda text: np.frombuffer(b"".join(map(ids.__getitem__, text.split())), "<u4")


def _piece_rows(path: str, capacity: int, text_col: str, remembered: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(path, remembered)
        for batch in batches:
            held, size = [], 0
            for row, text in enumerate(batch.column(text_col)):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                ids = np.append(encode(raw), np.uint32(SEPARATOR)).astype("<u4")
                for piece, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity].tobytes()
                    held.append((row, piece, at, len(part) // 4, part))
                    size += len(part)
                if size > 4 << 20:
                    yield _batch(batch, held)
                    held, size = [], 0
            if held:
                yield _batch(batch, held)

    def _batch(batch: pa.RecordBatch, held: list) -> pa.RecordBatch:
        rows, piece, start, length, ids = zip(*held)
        kept = [n for n in batch.schema.names if n != text_col]
        arrays = [batch.column(n).take(pa.array(rows, pa.int32())) for n in kept]
        made = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())]
        return pa.RecordBatch.from_arrays([*arrays, *made], [*kept, "piece", "start", "length", "ids"])

    return pieces


MADE = ["piece", "start", "length", "ids", "sequence_id", "offset"]


def pieces(
    docs: DataFrame, vocabulary: str, text_col: str = "text", capacity: int = CAPACITY, remembered: int = MEMORY
) -> DataFrame:
    """Tokenised documents, cut only where longer than ``capacity``.

    ``vocabulary`` is the path of a word-level vocabulary file, the same on all
    machines. Columns of ``docs`` other than the text, then ``piece``, ``start``,
    ``length`` and ``ids`` (unsigned 32-bit little-endian). Every document ends in
    the separator, so null and empty texts have one token.
    """
    bounded_batches(docs.sparkSession)
    kept = [c for c in without(docs, MADE) if c != text_col]
    text = fresh(docs, "_text")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text_col).alias(text))
    fields = [f for f in rows.schema.fields if f.name != text]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["piece int", "start long", "length long", "ids binary"])
    return rows.mapInArrow(_piece_rows(vocabulary, capacity, text, remembered), schema)


def assign(rows: DataFrame, order: list[str], capacity: int = CAPACITY, length_col: str = "length") -> DataFrame:
    """``rows`` with ``sequence_id`` and ``offset``; give narrow rows, they are sorted.

    ``order`` tells pieces of one length apart (pieces equal in it are
    interchangeable). Rows without length get no place.
    """
    # written first: dealing by ranges reads its input twice
    usable = materialise(rows.where(F.col(length_col) > 0), "pieces")
    written = placed(usable, [length_col, *order], "pieces-ordered")
    # at most one row per possible length
    histogram = {r[0]: r[1] for r in written.groupBy(length_col).agg(F.count("*")).collect()}
    steps = plan(histogram, capacity)
    ranked = rank_from(written, [length_col], "_rank")
    if not steps:
        return ranked.withColumns({"sequence_id": F.col("_rank"), "offset": F.col("_rank")}).drop("_rank")
    # one row per length with its runs: at most CAPACITY rows, whatever the corpus
    by_length: dict[int, list] = {}
    for length, first, last, sequence, per, offset in steps:
        by_length.setdefault(length, []).append((last, first, sequence, per, offset))
    spark = rows.sparkSession
    table = spark.createDataFrame(
        [(length, *map(list, zip(*runs))) for length, runs in by_length.items()],
        "_len long, _last array<long>, _first array<long>, _seq array<long>, _per array<long>, _off array<long>",
    )
    joined = ranked.join(F.broadcast(table), F.col(length_col) == F.col("_len"))
    run = F.size(F.filter("_last", lambda last: last <= F.col("_rank")))
    found = joined.withColumn("_run", run)
    step = F.col("_rank") - F.get("_first", F.col("_run"))
    per = F.get("_per", F.col("_run"))
    sequence = F.get("_seq", F.col("_run")) + F.call_function("div", step, per)
    offset = F.get("_off", F.col("_run")) + F.pmod(step, per) * F.col(length_col)
    return found.withColumns({"sequence_id": sequence, "offset": offset}).drop(
        "_rank", "_len", "_last", "_first", "_seq", "_per", "_off", "_run"
    )


def pack(
    docs: DataFrame, vocabulary: str, order: list[str], text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """Pieces of ``docs`` with ids and place: written once with their ids, placed without them."""
    cut = pieces(docs, vocabulary, text_col, capacity, PACK_MEMORY)
    row = fresh(cut, "_row")
    made = materialise(cut.withColumn(row, F.monotonically_increasing_id()), "tokens")
    keys = [f"_key{i}" for i in range(len(order))]
    narrow = made.select(F.col(row).alias("_row"), "length", *[F.col(c).alias(k) for c, k in zip(order, keys)], "piece")
    spots = assign(narrow, [*keys, "piece", "_row"], capacity)
    return made.join(spots.select(F.col("_row").alias(row), "sequence_id", "offset"), row).drop(row)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): pieces of a sequence joined in order, at most ``capacity`` tokens each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rows = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return rows.select("sequence_id", "n_tokens", joined.alias("ids"))
