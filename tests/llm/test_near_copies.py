"""Near copies at a similarity of 0.8 on five words, against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_text_operators import documents
from textloom.llm import near_copies, simhash
from textloom.plans import lookup


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def edited():
    """Chains and families of texts with some words replaced, short texts, copies, null and empty texts."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    texts = [None, "", " \n", "one two", "One  two", "one two three four five", "ONE two three four five", "one two three four six"]
    for n, changes, copies in ((60, 1, 12), (150, 3, 12), (150, 4, 6), (400, 6, 12)):
        base = [word() for _ in range(n)]
        at = base
        for k in range(copies):
            at = list(at if k % 2 else base)
            for i in rng.sample(range(n), changes):
                at[i] = word()
            texts += [" ".join(at), " ".join(at)] if k == 3 else [" ".join(at)]
    return texts


def by_hand(texts):
    """The smallest number reachable over pairs that are at least 0.8 alike."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


@pytest.mark.parametrize("block", [near_copies.BLOCK_SHINGLES, 300])
def test_components_equal_all_pairs(spark, block):
    texts = edited()
    got = near_copies.near_copies(documents(spark, texts), block_shingles=block).collect()
    want = by_hand(texts)
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(want)) and len(got) == len(texts)


def test_the_stage_keeps_one_of_each_component(spark):
    texts = edited()
    kept = corpus_pipeline.drop_near_copies(spark, documents(spark, texts), "").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(by_hand(texts)))


def test_many_copies_of_one_text(spark, monkeypatch):
    """A text that most rows share is dealt to parts; no row is lost or repeated."""
    monkeypatch.setattr(lookup, "HOT_FACTS", 5)
    texts = edited() + ["one text that most of the rows have"] * 90
    want = dict(enumerate(by_hand(texts)))
    got = near_copies.near_copies(documents(spark, texts)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want and len(got) == len(texts)
    found = simhash.near_duplicates(documents(spark, texts)).collect()
    copies = {r["component_id"] for r in found if texts[r["doc_id"]] == texts[-1]}
    assert copies == {texts.index(texts[-1])} and len(found) == len(texts)


def test_fingerprints_link_what_the_bands_are_kept_from(spark, monkeypatch):
    """SimHash gives links of its own: with bands that never meet, close copies are still one component."""
    monkeypatch.setattr(near_copies, "_signatures", without_bands(near_copies._signatures))
    rng = random.Random(12)
    base = [f"w{rng.randrange(10**6)}" for _ in range(600)]
    close = [*base[:599], "other"]
    far = [f"v{rng.randrange(10**6)}" for _ in range(600)]
    texts = [" ".join(base), " ".join(far), " ".join(close)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(docs).collect()}
    assert got == {0: 0, 1: 1, 2: 0}


def without_bands(signatures):
    def made(shingle):
        whole = signatures(shingle)
        return lambda text: whole(text).withField("buckets", F.array().cast("array<long>"))

    return made


def test_a_fingerprint_is_the_majority_of_a_set():
    texts = [b"a b c d e f g", b"", b"one two"]
    for t in texts:
        hashes = [int(h) for h in near_copies.shingle_set(t, 5)]
        bits = sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))
        assert near_copies.majority(near_copies.shingle_set(t, 5)) == bits
