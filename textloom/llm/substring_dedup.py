"""Removal of word sequences that occurred earlier, by suffix automata of reference shards.

The reference of a document is everything before it, so an automaton of the
whole reference cannot be held, let alone sent everywhere. The reference is
sharded by content: stretches around grams that occur in several places
(``windows``) are gathered by gram, each shard is a bounded number of them, and
every stretch that could match a shard is streamed through that shard's
automaton where it lies. Matching statistics of at least WINDOW words that
occurred earlier mark words to remove.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import windows

WINDOW = 20
GRAM = 8
SHARD_BYTES = 1 << 20
# Words remembered by one task, and the longest kept.
MEMORY = 400_000
LONG_WORD = 64


class Automaton:
    """Suffix automaton of several sequences; every state knows where its strings occurred first."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.first = [(-1, -1)]  # (sequence, place of the last symbol)

    def _state(self, following: dict[int, int], link: int, length: int, first: tuple[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.link) - 1

    def _split(self, state: int, symbol: int, target: int) -> int:
        """A copy of ``target`` for its strings that end a longest string of ``state``."""
        copy = self._state(dict(self.next[target]), self.link[target], self.length[state] + 1, self.first[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(symbol) == target:
            self.next[state][symbol] = copy
            state = self.link[state]
        return copy

    def add(self, sequence: list[int], number: int) -> None:
        """Sequences must be added in the order that decides what came first."""
        last = 0
        for place, symbol in enumerate(sequence):
            target = self.next[last].get(symbol)
            if target is not None:
                if self.length[target] != self.length[last] + 1:
                    target = self._split(last, symbol, target)
                last = target
                continue
            state = self._state({}, 0, self.length[last] + 1, (number, place))
            above = last
            while above >= 0 and symbol not in self.next[above]:
                self.next[above][symbol] = state
                above = self.link[above]
            if above >= 0:
                target = self.next[above][symbol]
                if self.length[target] != self.length[above] + 1:
                    target = self._split(above, symbol, target)
                self.link[state] = target
            last = state

    def earlier(self, sequence: list[int], number: int, window: int) -> list[int]:
        """Starts of the windows of ``sequence`` that occurred before, by matching statistics."""
        found, state = [], 0
        for place, symbol in enumerate(sequence):
            state = self.next[state][symbol]  # the sequence itself was added
            while self.length[self.link[state]] >= window:
                state = self.link[state]
            if place + 1 >= window and self.first[state] < (number, place):
                found.append(place + 1 - window)
        return found


def compare(shard: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int]]:
    """Windows of a shard's stretches (doc, first window, windows, words) that occurred earlier."""
    shard = sorted(shard)
    codes: dict[bytes, int] = {}
    sequences = [[codes.setdefault(w, len(codes)) for w in body.split()] for *_, body in shard]
    automaton = Automaton()
    for number, sequence in enumerate(sequences):
        automaton.add(sequence, number)
    marked = []
    for number, ((doc, first, _, _), sequence) in enumerate(zip(shard, sequences)):
        marked += [(doc, int(windows.packed_span(first + s, 1))) for s in automaton.earlier(sequence, number, WINDOW)]
    return marked


class _Hashes(dict):
    """64-bit hashes of words, remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        made = xxhash.xxh64_intdigest(word)
        if len(self) < MEMORY and len(word) <= LONG_WORD:
            self[word] = made
        return made


def _reader() -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
    hashes = _Hashes()

    def read(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [t.split() for t in texts]
        ends = np.cumsum([len(f) for f in found])
        codes = np.fromiter((h for f in found for h in map(hashes.__getitem__, f)), np.uint64, int(ends[-1]))
        return codes, ends

    return read


def _stretch(text: bytes) -> Callable[[int, int], bytes]:
    found = text.split()
    return lambda a, b: b" ".join(found[a:b])


WORDS = windows.Tokens(WINDOW, GRAM, True, _reader, windows.mixed, _stretch, compare, SHARD_BYTES)


def _kept(texts_and_spans: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in texts_and_spans:
        made, rows = [], []
        size = 0
        names = [n for n in batch.schema.names if n not in ("text", "spans")]
        for row, (text, spans) in enumerate(zip(batch.column("text"), batch.column("spans"))):
            found = windows.raw(text).split()
            removed = 0
            if spans.is_valid:
                gone = windows.covered(spans.values.to_numpy(), WINDOW, len(found))
                removed = int(gone.sum())
                kept = b" ".join([w for w, g in zip(found, gone.tolist()) if not g])
            else:
                kept = b" ".join(found)
            made.append((len(found), removed, kept.decode()))
            rows.append(row)
            size += len(kept)
            if size > 4 << 20:
                yield _rows(batch, names, rows, made)
                made, rows, size = [], [], 0
        if rows:
            yield _rows(batch, names, rows, made)


def _rows(batch: pa.RecordBatch, names: list[str], rows: list[int], made: list[tuple]) -> pa.RecordBatch:
    n_words, n_removed, kept = zip(*made)
    arrays = [batch.column(n).take(pa.array(rows, pa.int32())) for n in names]
    made_arrays = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
    return pa.RecordBatch.from_arrays([*arrays, *made_arrays], [*names, "n_words", "n_removed", "kept"])


def remove_earlier(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept): words not in a window of WINDOW words that occurred earlier.

    ``kept`` is joined by single spaces. Earlier means in a row with a smaller id
    or earlier in the same text; among rows with one id the order of their texts
    decides, null ids come first. Null texts are empty. One row per input row.
    """
    rows, ids = windows.numbered(docs, id_col, text_col)
    spans = windows.repeated_windows(rows, WORDS)
    made = rows.join(spans, "doc", "left").mapInArrow(_kept, "doc long, n_words long, n_removed long, kept string")
    if ids is None:
        return made.withColumnRenamed("doc", id_col)
    return made.join(ids.withColumnRenamed("id", id_col), "doc").select(id_col, "n_words", "n_removed", "kept")
