"""Tokenizer fit and encoding against a sequential re-count of the same rules."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions.text import characters
from textloom.operators import bpe as B
from textloom.operators import corpus_stats as C
from textloom.operators.bpe_state import END, Chain, KeptCounts, _gathered, code_of, cut
from textloom.operators.bpe_state import count_pairs as count_pairs_of
from textloom.operators.bpe import SPECIAL_TOKENS, BpeModel, _word_encoder, encode, fit_bpe, fit_words, merge_word, take_safe_batch, tokenize

TINY = {"low": 5, "lower": 2, "newest": 6, "widest": 3}


def count_pairs(words):
    pairs = Counter()
    for symbols, n in words:
        for p in zip(symbols, symbols[1:]):
            pairs[p] += n
    return pairs


def merge(symbols, pair, new):
    out, i = [], 0
    while i < len(symbols):
        if tuple(symbols[i : i + 2]) == pair:
            out.append(new)
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    return out


def one_at_a_time(counts, max_merges, min_frequency=2):
    """(tokens, merges) by taking the single best pair of a full re-count every time."""
    tokens = [*B.SPECIAL_TOKENS, *sorted({c for w in counts for c in w})]
    ids = {t: i for i, t in enumerate(tokens)}
    words = [([ids[c] for c in w], n) for w, n in counts.items()]
    merges = []
    while len(merges) < max_merges:
        pairs = count_pairs(words)
        if not pairs:
            break
        (l, r), n = min(pairs.items(), key=lambda x: (-x[1], x[0]))
        if n < min_frequency:
            break
        token = tokens[l] + tokens[r]
        if token not in ids:
            ids[token] = len(tokens)
            tokens.append(token)
        merges.append((tokens[l], tokens[r], n))
        words = [(merge(s, (l, r), ids[token]), m) for s, m in words]
    return tokens, merges


def in_batches(counts, max_merges, min_frequency=2, window=256):
    """The fit's driver loop over plain lists, to try many corpora quickly."""
    tokens = [*B.SPECIAL_TOKENS, *sorted({c for w in counts for c in w})]
    ids = {t: i for i, t in enumerate(tokens)}
    words = [([ids[c] for c in w], n) for w, n in counts.items()]
    merges = []
    while len(merges) < max_merges:
        ranked = sorted((-n, l, r) for (l, r), n in count_pairs(words).items() if n >= min_frequency)
        candidates = [(-n, l, r) for n, l, r in ranked[:window]]
        batch = take_safe_batch(candidates, len(candidates) < window, lambda l, r: tokens[l] + tokens[r] in ids)
        if not batch:
            break
        made = set()
        for n, l, r in batch[: max_merges - len(merges)]:
            token = tokens[l] + tokens[r]
            repeated = token in made
            if token not in ids:
                ids[token] = len(tokens)
                tokens.append(token)
                made.add(token)
            merges.append((tokens[l], tokens[r], n))
            words = [(merge(s, (l, r), ids[token]), m) for s, m in words]
            if repeated:
                break
    return tokens, merges


corpora = st.dictionaries(st.text("abcd", min_size=1, max_size=9), st.integers(1, 6), min_size=1, max_size=12)


@settings(max_examples=600, deadline=None)
@given(corpora, st.sampled_from([1, 2, 3, 5, 256]))
def test_batches_equal_one_at_a_time(counts, window):
    assert in_batches(counts, 40, window=window) == one_at_a_time(counts, 40)


def frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long").cache()


@pytest.mark.parametrize(
    "counts",
    [
        TINY,
        {"aaaaa": 3, "aaa": 4, "baab": 2},
        {"abc": 5, "abx": 4, "bcy": 4, "zbc": 3, "abcabc": 2},
        {"x\U0001f600y": 3, "\U0001f600y": 2, "é": 9},
        {"你好世界": 4, "你好": 3, "世界": 5},
    ],
)
def test_fit_equals_one_at_a_time(spark, counts):
    model = fit_words(frame(spark, counts), max_merges=30)
    assert (model.tokens, model.merges) == one_at_a_time(counts, 30)


@pytest.mark.parametrize("candidates, symbols", [(4096, 1 << 21), (24, 1 << 21), (24, 300), (8, 40), (64, 0)])
def test_rounds_of_any_size_equal_one_at_a_time(spark, monkeypatch, candidates, symbols):
    monkeypatch.setattr(B, "CANDIDATES", candidates)
    monkeypatch.setattr(B, "PIECE_SYMBOLS", symbols)
    rng = random.Random(12)
    counts = {"".join(rng.choice("abcdef") for _ in range(rng.randint(2, 12))): rng.randint(1, 9) for _ in range(120)}
    rounds = []
    model = fit_words(frame(spark, counts), max_merges=60, rounds=rounds)
    assert len(model.merges) == 60 and (model.tokens, model.merges) == one_at_a_time(counts, 60)
    assert sum(r.merges for r in rounds) == 60 and all(r.symbols <= symbols or r.touched == 0 for r in rounds)


def kept_fit(counts, max_merges, window):
    """Rounds over plain lists: pairs from the ``window`` most frequent ones down, words cut elsewhere."""
    tokens = [*B.SPECIAL_TOKENS, *sorted({c for w in counts for c in w})]
    ids = {t: i for i, t in enumerate(tokens)}
    words = [([ids[c] for c in w], n) for w, n in counts.items()]
    merges = []
    while len(merges) < max_merges:
        ranked = sorted(((n, *p) for p, n in count_pairs(words).items() if n >= 2), key=lambda x: (-x[0], *x[1:]))
        if not ranked:
            break
        hot, floor = B._hot_pairs(ranked, True, window, 2)
        if not hot:
            hot, floor = len(ranked), 2
        held = {p[1:] for p in ranked[:hot]}
        flat, weights = [], []
        for symbols, n in words:
            for i, x in enumerate(symbols):
                flat.append(x)
                if i + 1 == len(symbols) or (x, symbols[i + 1]) not in held:
                    flat.append(-1)
            weights += [n] * (len(flat) - len(weights))
        kept = KeptCounts(np.array(flat, np.int32), np.array(weights, np.int64))
        n, l, r = kept.best()
        while n >= floor and len(merges) < max_merges:
            token = tokens[l] + tokens[r]
            new = token not in ids
            if new:
                ids[token] = len(tokens)
                tokens.append(token)
            merges.append((tokens[l], tokens[r], n))
            words = [(merge(s, (l, r), ids[token]), m) for s, m in words]
            kept.merge((l, r, ids[token]))
            n, l, r = kept.best()
            if not new:
                break
            live = {c: v for c, v in kept.counts.items() if v >= floor}
            assert live == {code_of(*p): v for p, v in count_pairs(words).items() if v >= floor}
    return tokens, merges


@settings(max_examples=400, deadline=None)
@given(corpora, st.sampled_from([1, 2, 3, 7, 1000]))
def test_kept_counts_equal_a_recount_after_every_merge(counts, window):
    assert kept_fit(counts, 40, window) == one_at_a_time(counts, 40)


def test_chain_merges_every_second_of_a_run():
    chain = Chain(np.array([1, 1, 1, 1, 1, -1, 1, 1, 2, -1], np.int32))
    chain.merge((1, 1, 5))
    assert chain.symbols[chain.symbols != -2].tolist() == [5, 5, 1, -1, 5, 2, -1]
    chain.merge((5, 5, 6))
    chain.merge((5, 2, 7))
    assert chain.symbols[chain.symbols != -2].tolist() == [6, 1, -1, 7, -1]


def clauses():
    """A script without spaces: words are whole clauses, nearly all of them distinct."""
    rng = random.Random(8)
    characters = [chr(0x4E00 + i) for i in range(400)]
    common = ["".join(rng.choices(characters, k=rng.randint(2, 4))) for _ in range(60)]
    return {
        "".join(rng.choice(common) if rng.random() < 0.5 else rng.choice(characters) for _ in range(rng.randint(6, 25))): 1
        for _ in range(600)
    }


def test_300_merges_of_clauses_cut_at_the_floor(spark, monkeypatch, capsys):
    counts = clauses()
    cut_rounds, whole_rounds = [], []
    got = fit_words(frame(spark, counts), max_merges=300, rounds=cut_rounds)
    assert len(got.merges) == 300 and (got.tokens, got.merges) == one_at_a_time(counts, 300)
    monkeypatch.setattr(B, "FLOOR_PAIRS", 0)
    whole = fit_words(frame(spark, counts), max_merges=300, rounds=whole_rounds)
    assert whole == got


def test_state_shrinks_where_clauses_are_cut(spark):
    counts = clauses()
    ids = {c: i for i, c in enumerate(sorted({c for w in counts for c in w}))}
    state = spark.createDataFrame([([ids[c] for c in w], n) for w, n in counts.items()], "ids array<int>, n long")
    pairs = count_pairs_of(state).where("n >= 2").collect()
    pieces = cut(state, np.sort(np.array([code_of(r["l"], r["r"]) for r in pairs])))
    before, after = (df.agg(F.sum(F.size("ids"))).first()[0] for df in (state, pieces))
    assert after < before / 2
    assert {(r["l"], r["r"]): r["n"] for r in count_pairs_of(pieces).collect()} == {(r["l"], r["r"]): r["n"] for r in pairs}


def test_later_rounds_touch_less(spark, monkeypatch):
    monkeypatch.setattr(B, "CANDIDATES", 64)
    rng = random.Random(5)
    letters = "etaoinshrdlu"
    counts = {}
    for _ in range(1500):
        word = "".join(letters[min(int(rng.expovariate(0.35)), 11)] for _ in range(rng.randint(3, 9)))
        counts[word] = counts.get(word, 0) + rng.randint(1, 30)
    rounds = []
    model = fit_words(frame(spark, counts), max_merges=300, rounds=rounds)
    assert (model.tokens, model.merges) == one_at_a_time(counts, 300)
    per_merge = [r.touched / r.merges for r in rounds if r.touched]
    assert len(per_merge) > 2 and per_merge[-1] < per_merge[0] / 2


def test_all_texts_are_fitted_and_counted(spark):
    """Beyond any prefix: a character that only late texts have is in the vocabulary."""
    rows = spark.range(60_000).select("id", F.when(F.col("id") < 50_000, "ab ab").otherwise("ab zq").alias("text"))
    model = fit_bpe(rows, order_key="id", max_merges=1)
    assert "z" in model.tokens and model.merges[0][2] == 110_000
    few = fit_bpe(rows, num_samples=50_000, order_key="id", max_merges=1)
    assert "z" not in few.tokens


def test_vocab_size_counts_everything(spark):
    counts = frame(spark, TINY)
    n_chars = len({c for w in TINY for c in w})
    assert fit_words(counts, vocab_size=4 + n_chars + 3).vocab_size == 4 + n_chars + 3
    crowded = fit_words(counts, vocab_size=5)
    assert crowded.vocab_size == 4 + n_chars and crowded.merges == []


def test_pair_floor(spark):
    assert fit_words(frame(spark, {"ab": 1, "cd": 1})).merges == []


def test_reused_string_keeps_its_id():
    # "abc" comes from ab+c and from a+bc: one id, two merges
    counts = {"ab": 50, "abc": 30, "zbc": 60, "bc": 70, "xab": 5, "abcx": 4, "qabc": 9}
    tokens, merges = one_at_a_time(counts, 20)
    assert in_batches(counts, 20) == (tokens, merges)
    assert len(tokens) == len(set(tokens))


def test_tables_roundtrip(spark):
    model = fit_words(frame(spark, TINY), max_merges=6)
    again = BpeModel.from_tables(model.vocab_table(spark), model.merges_table(spark))
    assert again == model


def test_statistics(spark):
    df = spark.createDataFrame([(1, "aaa aaaa aaa"), (2, "b!")], "k int, text string")
    words = C.word_counts(df)
    assert {r["word"]: r["n"] for r in words.collect()} == {"aaa": 2, "aaaa": 1, "b": 1, "!": 1}
    symbols = characters(F.col("word"))
    assert {(r["l"], r["r"]): r["n"] for r in C.pair_counts(words, symbols).collect()} == {("a", "a"): 7}
    assert C.pair_counts(words, symbols, 8).count() == 0
    merged = C.unspaced(C.apply_merge(C.spaced(symbols), "a", "a", "aa"))
    got = {r[0]: r[1] for r in words.select("word", merged).collect()}
    assert got == {"aaa": ["aa", "a"], "aaaa": ["aa", "aa"], "b": ["b"], "!": ["!"]}


def test_merge_word_takes_lowest_rank_first():
    ranks = {(1, 2): (1, 9), (2, 3): (0, 8)}
    assert merge_word([1, 2, 3, 1, 2], ranks) == [1, 8, 9]
    assert merge_word([], ranks) == []


@settings(max_examples=300, deadline=None)
@given(corpora, st.text("abcde", max_size=30))
def test_merge_word_equals_repeated_search(counts, word):
    tokens, merges = one_at_a_time(counts, 12)
    ids = {t: i for i, t in enumerate(tokens)}
    ranks = {(ids[l], ids[r]): (rank, ids[l + r]) for rank, (l, r, _) in enumerate(merges)}
    want = [ids.get(c, B.UNK) for c in word]
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(want, want[1:])) if p in ranks]
        if not found:
            break
        (_, merged), i = min(found)
        want[i : i + 2] = [merged]
    assert merge_word([ids.get(c, B.UNK) for c in word], ranks) == want


def test_very_long_word(spark):
    model = fit_words(frame(spark, {"aaaa": 5, "ab": 3}), max_merges=3)
    df = spark.createDataFrame([("a" * 300_001,)], "text string")
    ids = df.select(encode(model, F.col("text")).alias("ids")).first()["ids"]
    assert "".join(model.tokens[i] for i in ids) == "a" * 300_001


def test_encode_rows(spark):
    model = fit_words(frame(spark, TINY), max_merges=8)
    ranks, ids = model.merge_ranks(), model.ids
    texts = [None, "", "   ", "lowest newer", "low?low", "wide"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, text string")
    got = [r["ids"] for r in df.select("k", encode(model, F.col("text")).alias("ids")).orderBy("k").collect()]

    def word(w):
        return merge_word([ids.get(c, B.UNK) for c in w], ranks)

    assert got == [[], [], [], word("lowest") + word("newer"), word("low") + [B.UNK] + word("low"), word("wide")]
    known = df.where("k in (3, 5)").select("k", model.decode(encode(model, F.col("text"))).alias("t"))
    assert [r["t"] for r in known.orderBy("k").collect()] == ["lowestnewer", "wide"]


def test_encode_does_not_depend_on_layout(spark):
    model = fit_words(frame(spark, TINY), max_merges=8)
    df = spark.createDataFrame([(i, f"low lower newest w{i} widest" * (i % 4)) for i in range(50)], "k int, text string")
    encoded = [
        sorted((r["k"], r["ids"]) for r in df.repartition(p).select("k", encode(model, F.col("text")).alias("ids")).collect())
        for p in (1, 3, 8)
    ]
    assert encoded[0] == encoded[1] == encoded[2]


def test_tokenize_shapes_and_kept_columns(spark):
    model = fit_words(frame(spark, TINY), max_merges=2)
    df = spark.createDataFrame([(1, None, "en"), (2, "lowlowlowlow", "fr")], "k int, text string, lang string")
    rows = tokenize(df, model, max_length=5).orderBy("k").collect()
    assert rows[0].asDict().keys() == {"k", "lang", "input_ids", "labels"}
    assert rows[0]["input_ids"] == [B.PAD] * 5 and rows[0]["labels"] == [B.PAD] * 5
    assert len(rows[1]["input_ids"]) == 5 and rows[1]["labels"] == rows[1]["input_ids"][1:] + [B.PAD]


def test_encoding_goes_to_python_in_batches_of_few_bytes(spark):
    """2,000 texts of 10 KB were one batch of 20 MB in one task, and its ids several times that."""
    model = fit_bpe(spark.createDataFrame([(0, "ab ab cd")], "row_id long, text string"), max_merges=1)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        rows = spark.range(0, 2_000, 1, 1).select("id", F.repeat(F.lit("ab cd x "), 1_250).alias("text"))
        ids = rows.select("id", encode(model, F.col("text")).alias("ids"))
        assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 4 << 20
        sizes = ids.select(F.size("ids").alias("n"), F.hash("ids").alias("h")).distinct().collect()
        assert [r["n"] for r in sizes] == [4 * 1_250]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)


def test_encoder_holds_ids_once():
    """Ids of a batch are copied once, without 8-byte places of every id beside them."""
    model = BpeModel([*SPECIAL_TOKENS, "a", "b", "ab"], 2, [("a", "b", 1)])
    words = [["ab", "a" * 60], [], ["x"]] * 20_000
    chunk = pa.array([["skipped"], *words], pa.list_(pa.string())).slice(1)
    tracemalloc.start()
    (made,) = _word_encoder(model)(iter([chunk]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert made.slice(0, 4).to_pylist() == [[6, *[4] * 60], [], [0], [6, *[4] * 60]] and len(made) == len(words)
    assert list(_word_encoder(model)(iter([chunk.slice(0, 0)])))[0].to_pylist() == []
    assert peak < 8 * len(made.flatten())  # NumPy reports what it holds; the ids themselves are Arrow's


def test_ids_of_a_large_batch_are_made_in_slices(monkeypatch):
    """A session may send batches of any size; their ids, several times as large, are made a few megabytes at a time."""
    monkeypatch.setattr(B, "SLICE_BYTES", 6_000)
    model = BpeModel([*SPECIAL_TOKENS, "a", "b", "ab"], 2, [("a", "b", 1)])
    words = [[], ["ab", "é", "a" * 60], [], ["a" * 9_000], ["x", "ab"], []] * 300
    want = [[i for w in row for i in merge_word([model.ids.get(c, B.UNK) for c in w], model.merge_ranks())] for row in words]
    for kind in (pa.string(), pa.large_string()):
        chunk = pa.array([["skipped"], *words, ["skipped"]], pa.list_(kind)).slice(1, len(words))
        made = list(_word_encoder(model)(iter([chunk, chunk.slice(0, 1)])))
        assert [row for m in made for row in m.to_pylist()] == [*want, []]
        assert max(len(m.flatten()) for m in made) <= 9_000
        assert len(made) <= 2 * 300 + 2


def test_batches_are_bounded_in_the_session_that_plans(spark):
    """Only the active session was set, so a second session of the application kept batches of 64 MB."""
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    model = fit_words(frame(spark, TINY), max_merges=2)
    spark.createDataFrame([(1,)], "k int").count()  # makes this the active session
    other, third = spark.newSession(), spark.newSession()
    rows = other.range(3).select("id", F.lit("low lower").alias("text"))
    assert int(other.conf.get(size).rstrip("b")) > 4 << 20
    assert tokenize(rows, model, max_length=4).count() == 3
    assert int(other.conf.get(size).rstrip("b")) <= 4 << 20
    assert third.range(3).select(encode(model, F.lit("low"), third)).count() == 3
    assert int(third.conf.get(size).rstrip("b")) <= 4 << 20


def test_few_merges_look_at_few_pairs(spark, monkeypatch):
    """Looking at all pairs first means pieces that are written only to be found too many."""
    looked = []
    pieces = B._pieces
    monkeypatch.setattr(B, "_pieces", lambda state, pairs: looked.append(len(pairs)) or pieces(state, pairs))
    counts = clauses()
    model = fit_words(frame(spark, counts), max_merges=3)
    assert (model.tokens, model.merges) == one_at_a_time(counts, 3)
    assert looked and max(looked) <= 4 * 3


def test_merges_are_applied_to_many_batches_at_once():
    """2,000 merges cost their time once for all small batches of a task, and absent pairs next to nothing."""
    batch = pa.RecordBatch.from_arrays([pa.array([[5, 6, 7]], pa.list_(pa.int32())), pa.array([3], pa.int64())], names=["ids", "n"])
    parts = list(_gathered(iter([batch] * 1_000)))
    assert len(parts) == 1 and parts[0][0].tolist() == [5, 6, 7, END] * 1_000 and parts[0][1].tolist() == [3] * 4_000
    chain = Chain(parts[0][0])
    whole = chain.codes_at
    chain.codes_at = lambda places: pytest.fail("an absent pair touches nothing")
    old, new = chain.merge((8, 9, 10))
    assert len(old[0]) == len(new[0]) == 0
    chain.codes_at = whole
    assert len(chain.merge((5, 6, 10))[1][0]) == 1_000
