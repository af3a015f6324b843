"""Packing, sharding, neighbours and the removal of repeats against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import neighbours, packing, sharding, substring_dedup, suffix_dedup, windows
from textloom.llm.queries import vocabulary_path

TEXT = "doc_id long, text string"


def best_fit(lengths, capacity):
    """Best-fit decreasing, a piece at a time: how many sequences end with what room left."""
    bins = []
    for length in sorted(lengths, reverse=True):
        fits = [b for b in bins if capacity - sum(b) >= length]
        if fits:
            min(fits, key=lambda b: capacity - sum(b)).append(length)
        else:
            bins.append([length])
    return Counter(capacity - sum(b) for b in bins)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 37, 64])
    lengths = [rng.randint(1, capacity if seed % 2 else capacity // 3) for _ in range(rng.randint(1, 400))]
    histogram = Counter(lengths)
    bins = {}
    seen = Counter()
    for length, first, last, sequence, per, offset in packing.plan(histogram, capacity):
        assert first == seen[length]
        seen[length] = last
        for rank in range(first, last):
            bins.setdefault(sequence + (rank - first) // per, []).append((offset + (rank - first) % per * length, length))
    assert seen == histogram
    for content in bins.values():
        content.sort()
        assert [o for o, _ in content] == [sum(x for _, x in content[:i]) for i in range(len(content))]
    assert Counter(capacity - sum(x for _, x in c) for c in bins.values()) == best_fit(lengths, capacity)


def test_packed_documents_round_trip(spark):
    from tokenizers import Tokenizer

    rng = random.Random(4)
    odd = ["É", "é,", "don't", "ΑΣ", "İ", "ŉ", "x²", "<|endoftext|>", "日本語。", "wait…", "👍🏽.", "ſ", "á", "̈", "Ÿ.", "a b", "WORD", "w!?"]
    texts = [None, "", " ", "<|endoftext|> a", "long word " * 3000]
    texts += [" ".join(rng.choice(odd) for _ in range(rng.randint(0, 50))) for _ in range(60)]
    texts += [texts[7]] * 5
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], TEXT + ", offset string")
    packed = packing.pack(docs, vocabulary_path(), ["doc_id"]).drop("text").collect()
    tokenizer = Tokenizer.from_file(vocabulary_path())
    by_doc, by_sequence = {}, {}
    for r in packed:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, text in enumerate(texts):
        rows = sorted(by_doc[i], key=lambda r: r["piece"])
        ids = [x for r in rows for x in np.frombuffer(r["ids"], "<u4").tolist()]
        assert ids == tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        assert [r["length"] for r in rows[:-1]] == [2048] * (len(rows) - 1)
        assert [r["start"] for r in rows] == [2048 * k for k in range(len(rows))]
    for rows in by_sequence.values():
        rows.sort(key=lambda r: r["offset"])
        ends = np.cumsum([r["length"] for r in rows])
        assert [r["offset"] for r in rows] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(by_sequence) == sum(best_fit([r["length"] for r in packed], 2048).values())
    whole = {r["sequence_id"]: r for r in packing.sequences(packing.pack(docs, vocabulary_path(), ["doc_id"])).collect()}
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in whole.values())
    assert packing.pack(docs.where("doc_id < 0"), vocabulary_path(), ["doc_id"]).count() == 0


@pytest.mark.parametrize("shards", [4, 7])
def test_shards_are_even_and_keep_links(spark, shards):
    texts = ["hot"] * 60 + ["pair %d" % (i // 2) for i in range(20)] + ["one %d" % i for i in range(60)] + [None, ""]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "hot"), (3, "hot")]
    docs = spark.createDataFrame(rows, TEXT)
    got = sharding.shard(docs, shards=shards).collect()
    counts = Counter(r["shard"] for r in got)
    assert len(got) == len(rows) and set(counts) <= set(range(shards)) and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))
    for r in got:
        if r["doc_id"] is not None:
            text = (texts[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(text) + 16, zlib.crc32(text))
    where = {r["doc_id"]: r["shard"] for r in got}
    split = sum(where[i] != where[i + 1] for i in range(60, 80, 2))
    dealt = 9  # of ten pairs dealt out in turn nearly all lie in two shards
    assert split < dealt / 2
    hot = Counter(r["shard"] for r in got if r["text_crc32"] == zlib.crc32(b"hot"))
    assert sum(n * (n - 1) for n in hot.values()) > sum(n * (n - 1) for n in Counter(i % shards for i in range(62)).values())
    assert sharding.shard(docs.where("doc_id < 0")).count() == 0
    assert sharding.shard(docs.limit(1)).count() == 1


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 16))
    vectors = centres[rng.integers(0, 20, 3000)] + 0.3 * rng.normal(size=(3000, 16))
    vectors[100:110] = vectors[100]
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(vectors)]
    odd = [(4000, None), (4001, [0.0] * 16), (4002, [float("nan")] * 16), (4003, [1.0, None] * 8), (4004, [1.0]), (None, rows[5][1])]
    schema = "vec_id long, embedding array<float>, score string"
    df = spark.createDataFrame([(*r, "x") for r in rows + odd], schema)
    got = neighbours.nearest(df, df.where("vec_id % 50 = 0"), visit=0.5).collect()
    data = np.array([r[1] for r in rows])
    hits = total = 0
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    for q in range(0, 3000, 50):
        distance = np.sqrt(((data - data[q]) ** 2).sum(axis=1))
        distance[q] = np.inf
        best = np.lexsort((np.arange(3000), distance))[:10]
        rows_of = sorted(found[q])
        assert [r for r, *_ in rows_of] == list(range(1, 11))
        assert [(s, v) for _, s, v in rows_of] == sorted((s, v) for _, s, v in rows_of)
        assert all(s == pytest.approx(distance[v], abs=1e-12) for _, s, v in rows_of)
        hits += len({v for *_, v in rows_of} & set(best.tolist()))
        total += 10
    assert hits / total >= 0.9
    # of the odd rows only the one of another length takes part, and no query has its length
    assert {r["vec_id"] for r in neighbours.nearest(df.where("vec_id >= 4000"), df).collect()} <= {4004}
    assert neighbours.nearest(df.where("vec_id < 0"), df).count() == 0
    few = neighbours.nearest(df.where("vec_id < 4"), df.where("vec_id = 0")).collect()
    assert [r["rank"] for r in few] == [1, 2, 3]


@pytest.mark.parametrize("bound", [7, 10_000])
def test_neighbours_with_repeated_rows_and_small_blocks(spark, monkeypatch, bound):
    """All leaves visited: exact, whatever blocks of rows and queries they are cut into."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", bound)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", bound)
    rng = np.random.default_rng(1)
    rows = [(i % 60, [float(x) for x in rng.integers(-3, 4, 4) + 0.5]) for i in range(150)]
    rows += [rows[0]] * 15 + [(0, rows[7][1]), (100, rows[0][1]), (100, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = neighbours.nearest(df, df.where("vec_id % 20 = 0"), visit=100.0).collect()
    want = []
    for i, (query, vector) in enumerate(rows):
        if query % 20 == 0:
            others = [(math.dist(vector, v), r) for j, (r, v) in enumerate(rows) if j != i]
            want += [(query, n + 1, r, d) for n, (d, r) in enumerate(sorted(others)[:10])]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in got) == sorted(
        (*w[:3], round(w[3], 9)) for w in want
    )
    # queries that are no rows of the table have no row of their own
    far = spark.createDataFrame([(0, [9.0] * 4), (7, [0.0] * 4)], df.schema)
    assert [r["rank"] for r in neighbours.nearest(df, far).collect()] == list(range(1, 11))


def earlier_by_hand(rows):
    seen, out = set(), []
    for key, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - 19):
            window = tuple(words[s : s + 20])
            if window in seen:
                gone[s : s + 20] = [True] * 20
            seen.add(window)
        out.append((key, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return out


def repeats_by_hand(rows):
    bodies = [(key, (text or "").encode()) for key, text in rows]
    count = Counter(b[s : s + 200] for _, b in bodies for s in range(len(b) - 199))
    out = []
    for key, b in bodies:
        gone = bytearray(len(b))
        for s in range(len(b) - 199):
            if count[b[s : s + 200]] > 1:
                gone[s : s + 200] = b"\1" * 200
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((key, len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def repetitive(seed):
    rng = random.Random(seed)
    passages = [" ".join(f"{rng.choice('abcé')}{rng.randint(0, 99)}" for _ in range(rng.randint(15, 90))) for _ in range(6)]
    texts = [None, "", "x", "aaaa " * 200, "ab " * 30 + "cd " * 30, "é" * 300]
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts.append(rng.choice(passages) if rng.random() < 0.5 else " ".join(str(rng.randint(0, 10**6)) for _ in range(rng.randint(1, 60))))
        texts.append(rng.choice([" ", "\n", "  "]).join(parts))
    return texts + [texts[-1], texts[-2], texts[4]]


@pytest.mark.parametrize("compared", [4096, 1])
def test_earlier_windows_go(spark, monkeypatch, compared):
    monkeypatch.setattr(windows, "COMPARED", compared)
    rows = list(enumerate(repetitive(compared)))
    docs = spark.createDataFrame(rows, TEXT).repartition(5)
    assert sorted(tuple(r) for r in substring_dedup.remove_earlier(docs).collect()) == earlier_by_hand(rows)


@pytest.mark.parametrize("compared", [4096, 1])
def test_repeated_bytes_go(spark, monkeypatch, compared):
    monkeypatch.setattr(windows, "COMPARED", compared)
    rows = list(enumerate(repetitive(compared + 1)))
    docs = spark.createDataFrame(rows, TEXT).repartition(5)
    got = sorted((r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffix_dedup.remove_repeats(docs).collect())
    assert got == repeats_by_hand(rows)


def test_repeated_and_null_ids(spark):
    text = " ".join(map(str, range(100, 160)))
    rows = [(1, text), (1, text), (None, text), (2, None), (2, "b " + text)]
    docs = spark.createDataFrame(rows, TEXT)
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in substring_dedup.remove_earlier(docs).collect()))
    assert got == [(False, 0, 60, 0), (True, 1, 60, 60), (True, 1, 60, 60), (True, 2, 0, 0), (True, 2, 61, 60)]
    assert sorted(r["n_removed"] for r in suffix_dedup.remove_repeats(docs).collect()) == [0, 239, 239, 239, 239]
    for operator in (substring_dedup.remove_earlier, suffix_dedup.remove_repeats):
        assert operator(docs.where("doc_id < 0")).count() == 0


def test_stripping_keeps_rows_columns_and_whole_characters(spark):
    shared = "é" * 150
    rows = [(1, "a" + shared + "x", "k", "v"), (2, "b" + shared + "y", "k", "w"), (3, None, None, None), (4, "alone", "k", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, spans string")
    got = {r["doc_id"]: r for r in suffix_dedup.strip_repeats(docs).collect()}
    assert suffix_dedup.strip_repeats(docs).columns == docs.columns
    assert [got[i]["text"] for i in (1, 2, 3, 4)] == ["ax", "by", None, "alone"]
    assert [(got[i]["kept"], got[i]["spans"]) for i in (1, 2, 3, 4)] == [("k", "v"), ("k", "w"), (None, None), ("k", "z")]


@pytest.mark.parametrize("first_stays", [True, False])
def test_hot_grams_are_cut_without_losing_a_block(first_stays, monkeypatch):
    """Sorted rows in small batches: a gram with many blocks, some of them repeated, is held in parts."""
    import pyarrow as pa

    monkeypatch.setattr(windows, "COMPARED", 50)
    rng = random.Random(8)
    rows = sorted((7, rng.randint(0, 60_000), d, 1 << 12 | 3) for d in range(150_000)) + [(9, 1, 5, 4097), (9, 1, 6, 4097)]
    batches = []
    for at in range(0, len(rows), 10_000):
        columns = list(zip(*rows[at : at + 10_000]))
        batches.append(windows.as_batch(windows.WAITS, [np.array(c, np.int64) for c in columns]))
    out = Counter()
    for batch in windows._settler(first_stays)(iter(batches)):
        out.update(zip(*[c.to_pylist() for c in batch.columns]))
    assert isinstance(batches[0], pa.RecordBatch) and max(out.values()) == 1
    by_content = {}
    for g, c, d, s in rows:
        by_content.setdefault((g, c), []).append((d, s))
    want = Counter()
    for (g, c), at in by_content.items():
        if g == 7:
            want[(windows.CUT, g, c, *at[0])] += 1
        for place in at[1:] if first_stays else at if len(at) > 1 else []:
            want[(windows.SETTLED, g, c, *place)] += 1
    assert out == want


def test_kept_text_digest(spark):
    docs = spark.createDataFrame([(1, " a  b\n")], TEXT)
    row = substring_dedup.remove_earlier(docs).withColumn("h", F.sha2(F.col("kept").cast("binary"), 256)).first()
    assert row["h"] == hashlib.sha256(b"a b").hexdigest()
