"""Marking of long byte matches with a run-length index.

An index over a bounded shard of text keeps the runs of its Burrows-Wheeler
transform and, for the suffix at each end of a run, how far it matches its
neighbour in suffix order. Those samples determine the matching statistics of
every other place: while the transform stays inside a run, the match with a
neighbour loses one byte per place. Streaming them over the text marks each
window that starts anywhere else.

Which stretches of a corpus have to be indexed together is found by
``windows``; a shard holds whole groups of stretches that could match.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import windows

WINDOW = 200
GRAM = 64
SHARD_BYTES = 1 << 20


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; every sequence ends in a symbol of its own."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        following = np.zeros(n, np.int64)
        following[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + following
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank[order] = new
        if new[-1] == n - 1 or step >= n:
            return order
        step *= 2


def common_prefix(symbols: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b``."""
    n = len(symbols)
    length = np.zeros(len(a), np.int64)
    active = np.arange(len(a))
    while len(active):
        x, y = a[active] + length[active], b[active] + length[active]
        inside = (x < n) & (y < n)
        same = inside.copy()
        same[inside] = symbols[x[inside]] == symbols[y[inside]]
        active = active[same]
        length[active] += 1
    return length


class RunIndex:
    """Runs of the Burrows-Wheeler transform with samples at their ends."""

    def __init__(self, symbols: np.ndarray):
        order = suffix_order(symbols)
        before = np.where(order > 0, symbols[order - 1], -1)  # the transform
        change = before[1:] != before[:-1]
        head = np.concatenate([[True], change])
        tail = np.concatenate([change, [True]])
        self.size = len(symbols)
        self.runs = int(head.sum())
        # first suffix of a run against the one before it, last one against the one after it
        heads, tails = np.flatnonzero(head), np.flatnonzero(tail)
        self.heads = self._samples(symbols, order, heads, heads - 1)
        self.tails = self._samples(symbols, order, tails, tails + 1)

    def _samples(self, symbols: np.ndarray, order: np.ndarray, at: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in text order, match lengths)."""
        real = (other >= 0) & (other < len(order))
        length = np.zeros(len(at), np.int64)
        length[real] = common_prefix(symbols, order[at[real]], order[other[real]])
        by_place = np.argsort(order[at])
        return order[at][by_place], length[by_place]

    def matching(self) -> np.ndarray:
        """For every place the length of its longest match anywhere else."""
        best = np.zeros(self.size, np.int64)
        places = np.arange(self.size)
        for sampled, length in (self.heads, self.tails):
            last = np.searchsorted(sampled, places, side="right") - 1
            best = np.maximum(best, length[last] - (places - sampled[last]))
        return best


def compare(shard: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int]]:
    """Windows of a shard's stretches (doc, first window, windows, bytes) that start elsewhere too."""
    bodies = [np.frombuffer(body, np.uint8) for *_, body in shard]
    parts = []
    for number, body in enumerate(bodies):
        parts += [body.astype(np.int32), np.array([256 + number], np.int32)]
    matching = RunIndex(np.concatenate(parts)).matching()
    marked, at = [], 0
    for (doc, first, n, _), body in zip(shard, bodies):
        repeated = np.flatnonzero(matching[at : at + n] >= WINDOW)
        # neighbouring windows as one span
        cuts = np.flatnonzero(np.diff(repeated) != 1) + 1
        for group in np.split(repeated, cuts) if len(repeated) else ():
            marked.append((doc, int(windows.packed_span(first + group[0], len(group)))))
        at += len(body) + 1
    return marked


_CODES = windows.mixed(np.arange(1, 257, dtype=np.uint64))


def _codes(tokens: np.ndarray) -> np.ndarray:
    return _CODES[tokens]


def _reader():
    def read(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])

    return read


BYTES = windows.Tokens(WINDOW, GRAM, False, _reader, _codes, lambda text: lambda a, b: text[a:b], compare, SHARD_BYTES)


def _whole_characters(body: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """``gone`` without characters that would be removed in part."""
    starts = np.flatnonzero((body & 0xC0) != 0x80)
    if not len(starts):
        return gone
    whole = np.logical_and.reduceat(gone, starts)
    return np.repeat(whole, np.diff(np.append(starts, len(body))))


def _kept(whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text, spans in zip(batch.column("text"), batch.column("spans")):
                body = windows.raw(text)
                if not spans.is_valid:
                    made.append((len(body), 0, 0, body))
                    continue
                flat = np.frombuffer(body, np.uint8)
                gone = windows.covered(spans.values.to_numpy(), WINDOW, len(flat))
                if whole:
                    gone = _whole_characters(flat, gone)
                runs = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[:1].sum())
                made.append((len(body), int(gone.sum()), runs, flat[~gone].tobytes()))
            n_bytes, n_removed, n_spans, kept = zip(*made) if made else ((),) * 4
            names = [n for n in batch.schema.names if n not in ("text", "spans")]
            arrays = [batch.column(n) for n in names] + [pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)]
            arrays.append(pa.array(kept, pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, [*names, *MADE])

    return run


MADE = ["n_bytes", "n_removed", "n_spans", "kept"]
_TYPES = "n_bytes long, n_removed long, n_spans long, kept binary"


def _removed(rows: DataFrame, whole_characters: bool) -> DataFrame:
    """``rows`` (doc, text, …) with MADE in place of the text."""
    spans = windows.repeated_windows(rows, BYTES)
    others = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    return rows.join(spans, "doc", "left").mapInArrow(_kept(whole_characters), f"{others}, {_TYPES}")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole_characters: bool = False
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept binary): texts without bytes of a WINDOW-byte
    string that also starts anywhere else.

    Every occurrence is removed, the first one too. With ``whole_characters`` a
    character that only partly lies in a match stays. Null texts are empty. One
    row per input row; repeated rows are copies of each other.
    """
    rows, ids = windows.numbered(docs, id_col, text_col)
    made = _removed(rows, whole_characters)
    if ids is None:
        return made.withColumnRenamed("doc", id_col)
    return made.join(ids.withColumnRenamed("id", id_col), "doc").select(id_col, *MADE)


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with what ``remove_repeats`` leaves of each text, whole characters kept.

    ``length_col``, where given, is set to the new number of characters. Columns
    and rows stay as they are otherwise; a text that is gone whole is empty, a
    null text stays null.
    """
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    names = [f"_c{i}" for i in range(len(others))]
    known = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), *[F.col(f"`{c}`").alias(n) for c, n in zip(others, names)])
    marked = known.withColumn("_null", F.col("_text").isNull())
    rows, ids = windows.numbered(marked, "_id", "_text", ["_null", *names])
    made = _removed(rows, True)
    made = made.withColumn("_id", F.col("doc")) if ids is None else made.join(ids.withColumnRenamed("id", "_id"), "doc")
    text = F.when(~F.col("_null"), F.col("kept").cast("string"))
    values = {id_col: F.col("_id"), text_col: text} | {c: F.col(n) for c, n in zip(others, names)}
    if length_col:
        values[length_col] = F.length(text).cast("long")
    return made.select(*[values[c].alias(c) for c in docs.columns])
