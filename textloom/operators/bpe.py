"""Byte-pair-encoding style tokenizer: fit on word counts, encode, vocabulary tables.

The fitted model is small (bounded by the vocabulary size) and lives on the
driver; everything that grows with the corpus stays in DataFrames.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import arrays
from textloom.functions.text import coerce_text, pretokens
from textloom.operators.bpe_state import KeptCounts, Merge, apply_merges, code_of, count_pairs, cut, flatten
from textloom.operators.corpus_stats import MIN_FREQUENCY, alphabet, top_pairs, word_counts
from textloom.operators.split import sample_prefix
from textloom.plans.layout import bounded_batches
from textloom.plans.storage import discard, materialise

# The special tokens, first in the vocabulary, in this order.
SPECIAL_TOKENS = ["<unk>", "<pad>", "<bos>", "<eos>"]
UNK, PAD, BOS, EOS = range(4)

VOCAB_SIZE = 8192
MAX_LENGTH = 512

# Most frequent pairs looked at per round of the fit.
CANDIDATES = 4096
# Of them, looked at first for each merge that is asked for.
PAIRS_PER_MERGE = 4
# Symbols of the pieces around them that a round may read at once.
PIECE_SYMBOLS = 1 << 21
# Pairs at the floor that words are cut by before the first round; beyond, they stay whole.
FLOOR_PAIRS = 1 << 22
# Words remembered by one task while encoding, and the longest kept.
WORD_MEMORY = 200_000
LONG_WORD = 64
# Bytes of words whose ids one task makes at once; a row that is larger is taken alone.
SLICE_BYTES = 2 << 20

# Marks a symbol that has become part of the one before it.
GONE = -1


@dataclass
class BpeModel:
    tokens: list[str]
    n_alphabet: int
    merges: list[tuple[str, str, int]] = field(default_factory=list)

    @property
    def vocab_size(self) -> int:
        return len(self.tokens)

    @property
    def ids(self) -> dict[str, int]:
        return {t: i for i, t in enumerate(self.tokens)}

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        first_merged = len(SPECIAL_TOKENS) + self.n_alphabet
        rows = [
            (t, i, "special" if i < len(SPECIAL_TOKENS) else "char" if i < first_merged else "merged")
            for i, t in enumerate(self.tokens)
        ]
        return spark.createDataFrame(rows, "token string, id int, kind string")

    def merges_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, l, r, n) for i, (l, r, n) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, l string, r string, freq long")

    @classmethod
    def from_tables(cls, vocab: DataFrame, merges: DataFrame) -> BpeModel:
        entries = vocab.orderBy("id").collect()
        return cls(
            [r["token"] for r in entries],
            sum(r["kind"] == "char" for r in entries),
            [(r["l"], r["r"], r["freq"]) for r in merges.orderBy("rank").collect()],
        )

    def merge_ranks(self) -> dict[tuple[int, int], tuple[int, int]]:
        """(left id, right id) -> (rank, merged id)."""
        ids = self.ids
        return {(ids[l], ids[r]): (rank, ids[l + r]) for rank, (l, r, _) in enumerate(self.merges)}

    def decode(self, ids: Column) -> Column:
        return arrays.decode(ids, self.tokens, list(range(len(SPECIAL_TOKENS))))


def take_safe_batch(
    candidates: list[tuple[int, int, int]], complete: bool, merged_exists: Callable[[int, int], bool]
) -> list[tuple[int, int, int]]:
    """The leading candidates that one-at-a-time merging would choose in this order.

    ``candidates`` are (n, left, right), best first; ``complete`` says that there
    are no others. With T the pairs taken so far, the next candidate (c, d) is
    still the best one if

    * its count is untouched: c is no right symbol in T and d is no left symbol
      in T (sharing a symbol on the same side is harmless), and
    * no pair created by T comes before it. A merge of (a, b) creates pairs (x, ab)
      and (ab, y) no more frequent than (x, a) and (b, y), which are not in T and
      so no more frequent than (c, d). On equal counts (ab, y) comes later, as
      ab is the newer symbol; (x, ab) comes earlier only if x < c.

    Two kinds of merge void the argument and end the batch: a symbol with
    itself, and one whose result is an existing token.
    """
    batch: list[tuple[int, int, int]] = []
    lefts: set[int] = set()
    rights: set[int] = set()
    by_count: dict[int, list[tuple[int, int]]] = {}
    for n, left, right in candidates:
        by_count.setdefault(n, []).append((left, right))
    for n, left, right in candidates:
        if left in rights or right in lefts:
            break
        if batch:
            ties_visible = complete or candidates[-1][0] < n
            # such a pair cannot be in T: its right symbol would be a left symbol of T
            if not ties_visible or any(r in lefts and l < left for l, r in by_count[n]):
                break
        batch.append((n, left, right))
        lefts.add(left)
        rights.add(right)
        if left == right or merged_exists(left, right):
            break
    return batch


@dataclass
class Round:
    """What one round of a fit did: merges, the count down to which they are exact, symbols read and places touched."""

    merges: int
    floor: int
    symbols: int
    touched: int


def _hot_pairs(ranked: list[tuple[int, int, int]], complete: bool, k: int, floor: int) -> tuple[int, int]:
    """(how many, from which count on): the first ``k`` pairs without the count that is cut off."""
    if k >= len(ranked):
        return (len(ranked), floor) if complete else _hot_pairs(ranked, True, len(ranked) - 1, floor)
    cut_off = ranked[k][0]
    while k and ranked[k - 1][0] == cut_off:
        k -= 1
    return k, cut_off + 1


def fit_words(
    counts: DataFrame,
    vocab_size: int = VOCAB_SIZE,
    min_frequency: int = MIN_FREQUENCY,
    max_merges: int | None = None,
    rounds: list[Round] | None = None,
) -> BpeModel:
    """Fit on a (word, n) table, which must be cheap to read more than once.

    Words are first cut where two characters are neighbours less often than
    ``min_frequency``: no merge can cross such a place, and equal pieces add up.

    A round counts all pairs and takes the most frequent ones. Words cut at all
    other pairs give few distinct pieces, and merging those in order of their
    kept counts is exact while the best pair is more frequent than any pair cut
    at: pairs only become rarer, and a new one is no more frequent than the pair
    it was made from. Only a merge whose string already has an id can
    make a pair more frequent, so it ends the round. The round's merges are
    then applied to all words, in which only their places are touched. Pieces are
    read if they have at most PIECE_SYMBOLS; otherwise the round takes fewer pairs.
    ``rounds`` collects what each round did.
    """
    spark = counts.sparkSession
    chars = sorted(r[0] for r in alphabet(counts).collect())  # bounded by the character set
    model = BpeModel([*SPECIAL_TOKENS, *chars], len(chars))
    ids = model.ids
    char_ids = F.arrow_udf(_char_encoder(chars), "array<int>")
    words = counts.where(F.length("word") > 1).repartition(spark.sparkContext.defaultParallelism)
    state = materialise(words.select(char_ids("word").alias("ids"), "n"), "bpe-state")

    def replace(new: DataFrame) -> None:
        nonlocal state
        state, done = materialise(new, "bpe-state"), state
        discard(done)

    def room() -> bool:
        return model.vocab_size < vocab_size and (max_merges is None or len(model.merges) < max_merges)

    def take(n: int, left: int, right: int, pending: list[Merge]) -> bool:
        """Add a merge; whether its string is new."""
        token = model.tokens[left] + model.tokens[right]
        new = token not in ids
        if new:
            ids[token] = model.vocab_size
            model.tokens.append(token)
        model.merges.append((model.tokens[left], model.tokens[right], n))
        pending.append((left, right, ids[token]))
        return new

    if room():
        frequent = count_pairs(state).where(F.col("n") >= min_frequency).select("l", "r")
        pairs = frequent.limit(FLOOR_PAIRS + 1).toArrow()
        if pairs.num_rows <= FLOOR_PAIRS:
            replace(cut(state, _codes(pairs["l"].to_numpy(), pairs["r"].to_numpy())))
    # few merges need few pairs, and those leave fewer pieces to read
    k = CANDIDATES if max_merges is None else min(CANDIDATES, PAIRS_PER_MERGE * max_merges)
    while room():
        rows = top_pairs(count_pairs(state).where(F.col("n") >= min_frequency), CANDIDATES).collect()
        ranked = [(r["n"], r["l"], r["r"]) for r in rows]
        complete = len(ranked) < CANDIDATES
        if not ranked:
            break
        pending: list[Merge] = []
        kept, floor, symbols = None, ranked[0][0], 0
        while kept is None and k > 1:
            hot, floor = _hot_pairs(ranked, complete, k, min_frequency)
            if not hot:
                break
            kept, symbols = _pieces(state, ranked[:hot])
            k = k if kept else k // 4
        if kept is None:
            # a pair whose own pieces are too many, or ties beyond the pairs looked at
            exists = lambda l, r: model.tokens[l] + model.tokens[r] in ids
            for n, left, right in take_safe_batch(ranked, complete, exists):
                if not room() or not take(n, left, right, pending):
                    break
        else:
            n, left, right = kept.best()
            while room() and n >= floor:
                if not take(n, left, right, pending):
                    break
                kept.merge(pending[-1])
                n, left, right = kept.best()
        if rounds is not None:
            rounds.append(Round(len(pending), floor, symbols, kept.touched if kept else 0))
        if room():
            replace(apply_merges(state, pending))
        k = min(CANDIDATES, 4 * max(k, 1))
    discard(state)
    return model


def _codes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.sort(left.astype(np.int64) << 32 | right)


def _pieces(state: DataFrame, pairs: list[tuple[int, int, int]]) -> tuple[KeptCounts | None, int]:
    """Kept counts of the pieces that hold ``pairs``, if they are small enough, and their symbols."""
    _, left, right = (np.array(x) for x in zip(*pairs))
    pieces = materialise(cut(state, _codes(left, right)), "bpe-pieces")
    symbols = pieces.agg(F.sum(F.size("ids").cast("long") + 1)).first()[0] or 0
    kept = None
    if symbols <= PIECE_SYMBOLS:
        batch = pieces.toArrow().combine_chunks().to_batches()
        kept = KeptCounts(*flatten(batch[0])) if batch else None
    discard(pieces)
    return kept, symbols


def fit_bpe(
    df: DataFrame,
    vocab_size: int = VOCAB_SIZE,
    num_samples: int | None = None,
    order_key: str = "row_id",
    text_col: str = "text",
    min_frequency: int = MIN_FREQUENCY,
    max_merges: int | None = None,
) -> BpeModel:
    """Fit on all usable texts, or on the first ``num_samples`` of them."""
    sample = sample_prefix(df, num_samples, order_key, text_col)
    counts = materialise(word_counts(sample, text_col), "word-counts")
    model = fit_words(counts, vocab_size, min_frequency, max_merges)
    discard(counts)
    return model


def _char_encoder(chars: list[str]) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """Words to character ids; ``chars`` is the whole alphabet by code point."""
    points = np.array([ord(c) for c in chars], np.uint32)

    def encode(chunks: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for chunk in chunks:
            words = chunk.to_pylist()
            found = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
            ids = len(SPECIAL_TOKENS) + np.searchsorted(points, found)
            ends = np.cumsum([0, *map(len, words)])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))

    encode.__annotations__ = {"chunks": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return encode


def _offsets(lists: pa.ListArray) -> pa.Array:
    """Offsets of a list array without nulls, starting at 0."""
    offsets = lists.offsets.to_numpy()
    return pa.array(offsets - offsets[0], pa.int32())


def _slices(chunk: pa.ListArray) -> Iterator[pa.ListArray]:
    """Whole rows of words, some SLICE_BYTES at a time, however large the batch; an empty batch is one slice."""
    words = chunk.flatten()
    if not len(words):
        yield chunk
        return
    width = np.int64 if pa.types.is_large_string(words.type) else np.int32
    starts = np.frombuffer(words.buffers()[1], width)[words.offset + _offsets(chunk).to_numpy()]
    first = 0
    while first < len(chunk):
        last = max(first + 1, int(np.searchsorted(starts, int(starts[first]) + SLICE_BYTES, side="right")) - 1)
        yield chunk.slice(first, last - first)
        first = last


def merge_word(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply the lowest-ranked merge present, at its leftmost place, until none is left.

    Pairs wait in a heap and symbols form a chain, so that a very long word (a
    clause without spaces, a run of punctuation) takes n log n steps.
    """
    out = list(symbols)
    size = len(out)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    waiting: list[tuple[int, int, int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < size:
            left, right = out[i], out[after[i]]
            found = ranks.get((left, right))
            if found:
                heapq.heappush(waiting, (found[0], i, left, right, found[1]))

    for i in range(size - 1):
        offer(i)
    while waiting:
        _, i, left, right, merged = heapq.heappop(waiting)
        j = after[i]
        if out[i] != left or j >= size or out[j] != right:
            continue  # one of the two symbols has been merged meanwhile
        out[i], out[j], after[i] = merged, GONE, after[j]
        if after[i] < size:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [s for s in out if s != GONE]


def _word_encoder(model: BpeModel) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    ids, ranks = model.ids, model.merge_ranks()
    single = {t: i for t, i in ids.items() if len(t) == 1}

    def encode(chunks: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, list[int]] = {}

        def word_ids(word: str) -> list[int]:
            found = known.get(word)
            if found is None:
                found = merge_word([single.get(c, UNK) for c in word], ranks)
                if len(known) < WORD_MEMORY and len(word) <= LONG_WORD:
                    known[word] = found
            return found

        for rows in (part for chunk in chunks for part in _slices(chunk)):
            words = rows.flatten().dictionary_encode()
            spelled = [word_ids(w) for w in words.dictionary.to_pylist()]
            starts = np.cumsum([0, *map(len, spelled)])
            pool = np.fromiter((i for s in spelled for i in s), np.int32, int(starts[-1]))
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(pool))
            # every word occurrence copies its word's stretch of the pool
            occurrences = lists.take(words.indices)
            bounds = _offsets(occurrences).take(_offsets(rows))
            yield pa.ListArray.from_arrays(bounds, occurrences.flatten())

    encode.__annotations__ = {"chunks": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return encode


def encode(model: BpeModel, text: Column, spark: SparkSession | None = None) -> Column:
    """Text to ids. Null and non-string input is coerced; no start or end id is added.

    A narrow expression: texts are cut into words in the JVM, and Arrow batches
    of words go through the merges once per distinct word of a slice. A slice holds a few
    megabytes of words, since its ids take several times as much; so does a batch in the session
    ``spark``, by default the active one. A session that plans the query without being
    active, as one of several of an application, has to be named.
    """
    bounded_batches(spark)
    encoder = F.arrow_udf(_word_encoder(model), "array<int>")
    return encoder(pretokens(coerce_text(text)))


def tokenize(
    df: DataFrame, model: BpeModel, max_length: int = MAX_LENGTH, text_col: str = "text"
) -> DataFrame:
    """``input_ids`` and ``labels`` of exactly ``max_length``; ``text`` is dropped, other columns stay."""
    encoded = df.withColumn("_ids", arrays.truncate(encode(model, F.col(text_col), df.sparkSession), max_length))
    padded = encoded.withColumn("input_ids", arrays.pad_right(F.col("_ids"), max_length, PAD))
    return padded.withColumn("labels", arrays.shift_labels(F.col("input_ids"), PAD)).drop("_ids", text_col)


def length_profile(ids: DataFrame, max_length: int = MAX_LENGTH, ids_col: str = "ids") -> DataFrame:
    """Real, cut and pad counts that truncation and padding to ``max_length`` produce."""
    n = F.size(ids_col)
    kept = F.least(n, F.lit(max_length))
    return ids.agg(
        F.count("*").alias("n_rows"),
        F.sum(n.cast("bigint")).alias("n_ids"),
        F.sum(kept.cast("bigint")).alias("n_kept"),
        F.sum((n - kept).cast("bigint")).alias("n_cut"),
        F.sum((F.lit(max_length) - kept).cast("bigint")).alias("n_pad"),
        F.max(n).alias("max_ids"),
        F.avg(n).alias("avg_ids"),
        F.count_if(n > max_length).alias("n_truncated_rows"),
    )
