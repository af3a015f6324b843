"""The word table of a tokenizer fit: counting, cutting and merging inside tasks.

A row is a distinct word, or a piece of one, as symbol ids with its count. Spark
partitions the table and sums the pair counts; these helpers treat the words of
one Arrow batch as one flat array, where a negative id closes each word so that
no pair reaches across words.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END = -1

# Symbols that a task works on at once, at some 60 bytes each.
TASK_SYMBOLS = 1 << 20

Merge = tuple[int, int, int]  # left id, right id, id of the result


def code_of(left: int, right: int) -> int:
    """A pair as one number; sorts like (left, right)."""
    return left << 32 | right


def flatten(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(symbols with END after each word, count of the word at every place)."""
    ids, counts = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
    offsets = ids.offsets.to_numpy()
    lengths = np.diff(offsets)
    flat = np.full(int(lengths.sum()) + len(lengths), END, np.int32)
    word = np.repeat(np.arange(len(lengths)), lengths)
    flat[np.arange(len(word)) + word] = ids.values.to_numpy()[offsets[0] : offsets[-1]]
    return flat, np.repeat(counts, lengths + 1)


def unflatten(flat: np.ndarray, weights: np.ndarray) -> pa.RecordBatch:
    """Words that still have a pair, back as rows."""
    ends = np.flatnonzero(flat == END)
    lengths = np.diff(np.concatenate([[-1], ends])) - 1
    live = lengths > 1
    symbols = flat[np.repeat(live, lengths + 1) & (flat != END)]
    offsets = np.concatenate([[0], np.cumsum(lengths[live])]).astype(np.int32)
    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(symbols, pa.int32()))
    return pa.RecordBatch.from_arrays([ids, pa.array(weights[ends[live]], pa.int64())], names=["ids", "n"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``flatten`` over several batches at once, about TASK_SYMBOLS: what is done per merge or per pair is done less often."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        held.append(flatten(batch))
        size += len(held[-1][0])
        if size >= TASK_SYMBOLS:
            yield np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            held, size = [], 0
    if held:
        yield np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])


def _sum_by_code(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, place = np.unique(codes, return_inverse=True)
    sums = np.zeros(len(unique), np.int64)
    np.add.at(sums, place, weights)
    return unique, sums


def _pairs_at(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, codes) of all pairs."""
    inside = np.flatnonzero((flat[:-1] != END) & (flat[1:] != END))
    return inside, flat[inside].astype(np.int64) << 32 | flat[inside + 1]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for flat, weights in _gathered(batches):
        places, pairs = _pairs_at(flat)
        codes, sums = _sum_by_code(np.concatenate([codes, pairs]), np.concatenate([sums, weights[places]]))
    columns = [pa.array((codes >> 32).astype(np.int32)), pa.array((codes & 0x7FFFFFFF).astype(np.int32)), pa.array(sums)]
    yield pa.RecordBatch.from_arrays(columns, names=["l", "r", "n"])


def count_pairs(state: DataFrame) -> DataFrame:
    """(l, r, n) over all words, summed per task first."""
    return state.mapInArrow(_count, "l int, r int, n bigint").groupBy("l", "r").agg(F.sum("n").alias("n"))


def cut(state: DataFrame, kept: np.ndarray) -> DataFrame:
    """Pieces of words between pairs that are not among the sorted codes ``kept``; equal pieces add up."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, weights = flatten(batch)
            places, pairs = _pairs_at(flat)
            at = np.minimum(np.searchsorted(kept, pairs), max(0, len(kept) - 1))
            apart = places[kept[at] != pairs] + 1 if len(kept) else places + 1
            yield unflatten(np.insert(flat, apart, END), np.insert(weights, apart, weights[apart]))

    return state.mapInArrow(pieces, "ids array<int>, n bigint").groupBy("ids").agg(F.sum("n").alias("n"))


class Chain:
    """Words as a chain of symbols with the places of pairs, so that a merge touches only the words that hold it.

    The index has the places of the pairs in ``wanted`` (all pairs by default)
    and grows with the pairs that merges create. Places may be out of date;
    they are checked when used.
    """

    def __init__(self, flat: np.ndarray, wanted: np.ndarray | None = None):
        size = len(flat)
        self.symbols = flat.copy()
        self.after = np.arange(1, size + 1, dtype=np.int64)
        self.before = np.arange(-1, size - 1, dtype=np.int64)
        places, codes = _pairs_at(flat)
        if wanted is not None:
            held = np.isin(codes, wanted)
            places, codes = places[held], codes[held]
        order = np.argsort(codes, kind="stable")
        self._codes, self._places = codes[order], places[order]
        self._new: dict[int, list[np.ndarray]] = {}
        self.wanted = wanted

    def _found(self, left: int, right: int) -> np.ndarray:
        """Places of a pair, ascending."""
        code = code_of(left, right)
        lo, hi = np.searchsorted(self._codes, [code, code + 1])
        later = self._new.pop(code, [])
        if lo == hi and not later:
            return self._places[:0]
        places = np.unique(np.concatenate([self._places[lo:hi], *later]))
        places = places[self.symbols[places] == left]
        places = places[self.symbols[self.after[places]] == right]
        if left == right and len(places):
            # in a run of overlapping matches every second one counts
            order = np.arange(len(places))
            begins = np.concatenate([[True], self.after[places[:-1]] != places[1:]])
            places = places[(order - np.maximum.accumulate(np.where(begins, order, 0))) % 2 == 0]
        return places

    def codes_at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, codes) of those that begin a pair."""
        places = places[places >= 0]
        places = places[self.symbols[places] >= 0]
        right = self.symbols[self.after[places]]
        places, right = places[right >= 0], right[right >= 0]
        return places, self.symbols[places].astype(np.int64) << 32 | right

    def merge(self, merge: Merge) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Apply one merge, left to right without overlap; the pairs around it before and after, as (places, codes)."""
        left, right, merged = merge
        places = self._found(left, right)
        if not len(places):
            return (places, places), (places, places)
        gone = self.after[places]
        old = self.codes_at(np.unique(np.concatenate([self.before[places], places, gone])))
        behind = self.after[gone]
        self.symbols[places] = merged
        self.symbols[gone] = GONE
        self.after[places] = behind
        self.before[behind] = places
        new = self.codes_at(np.unique(np.concatenate([self.before[places], places])))
        held = new if self.wanted is None else tuple(x[np.isin(new[1], self.wanted)] for x in new)
        order = np.argsort(held[1], kind="stable")
        codes, starts = np.unique(held[1][order], return_index=True)
        for code, part in zip(codes.tolist(), np.split(held[0][order], starts[1:])):
            self._new.setdefault(code, []).append(part)
        return old, new


# Marks a symbol that has become part of the one before it.
GONE = -2


def apply_merges(state: DataFrame, merges: list[Merge]) -> DataFrame:
    """The table after ``merges``, without the words that have no pair left; equal words stay apart."""
    wanted = np.unique(np.array([code_of(l, r) for l, r, _ in merges], np.int64))

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for flat, weights in _gathered(batches):
            chain = Chain(flat, wanted)
            for merge in merges:
                chain.merge(merge)
            stay = chain.symbols != GONE
            yield unflatten(chain.symbols[stay], weights[stay])

    return state.mapInArrow(rewrite, "ids array<int>, n bigint")


class KeptCounts:
    """Pair counts of a bounded set of pieces, kept up to date from merge to merge."""

    def __init__(self, flat: np.ndarray, weights: np.ndarray):
        self.chain, self.weights = Chain(flat), weights
        places, codes = _pairs_at(flat)
        unique, sums = _sum_by_code(codes, weights[places])
        self.counts: dict[int, int] = dict(zip(unique.tolist(), sums.tolist()))
        self.queue = [(-n, code) for code, n in self.counts.items()]
        heapq.heapify(self.queue)
        self.touched = 0

    def best(self) -> tuple[int, int, int]:
        """(n, left, right) of the most frequent pair, ties by the left then the right id; n is 0 if there is none."""
        while self.queue:
            n, code = self.queue[0]
            if self.counts.get(code, 0) == -n:
                return -n, code >> 32, code & 0x7FFFFFFF
            heapq.heappop(self.queue)
        return 0, 0, 0

    def merge(self, merge: Merge) -> None:
        old, new = self.chain.merge(merge)
        self.touched += len(new[0])
        codes = np.concatenate([old[1], new[1]])
        change = np.concatenate([-self.weights[old[0]], self.weights[new[0]]])
        for code, n in zip(*(x.tolist() for x in _sum_by_code(codes, change))):
            if n:
                left = self.counts.get(code, 0) + n
                if left:
                    self.counts[code] = left
                    heapq.heappush(self.queue, (-left, code))
                else:
                    del self.counts[code]
