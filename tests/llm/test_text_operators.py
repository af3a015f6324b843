"""Quality rules, SimHash, mixing, quotation linking and page text against small brute-force versions."""

import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from textloom.llm import html_text, mixing, quality_rules, quotation, simhash
from textloom.llm.components import components

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, sources=None):
    rows = [(i, t, "en", (sources or ["s"] * len(texts))[i], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


def measured(text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\x0b\x0c\r")]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_run_words": sum(a == b for a, b in zip(words, words[1:])),
    }


def test_quality_measurements(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t ", "a", "你好 😀 x", "a b c d e f g h " * 3, "line\nline\n\nline ", "x " * 5000, "# $ % & |"]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    docs = documents(spark, texts).withColumn("failures", F.lit("clash")).withColumn("n_words", F.lit(-1))
    got = {r["doc_id"]: r.asDict() for r in quality_rules.ledger(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = measured(text)
        assert {k: got[i][k] for k in want} == want
        for bit, test in enumerate(quality_rules.RULES.values()):
            assert bool(got[i]["failures"] >> bit & 1) == eval(test, {}, want)
    kept = quality_rules.select_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == [i for i in got if got[i]["failures"] == 0]


def test_policies_and_ablations(spark):
    rows = spark.createDataFrame([(0,), (1,), (3,), (4,), (4,), (6,)], "failures long")
    assert {tuple(r) for r in quality_rules.policy_counts(rows).collect()} == {("base-1", 6, 3), ("clean-1", 6, 1)}
    got = {r["rule"]: tuple(r)[1:] for r in quality_rules.ablations(rows).collect()}
    assert got["few_words"] == (2, 1, 4) and got["symbols"] == (3, 2, 3) and got["word_runs"] == (0, 0, 5)
    empty = quality_rules.ledger(documents(spark, []))
    assert empty.count() == 0 and quality_rules.policy_counts(empty).count() == 2


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in root:
        for b in root:
            if (a ^ b).bit_count() <= 3:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in root}


def near_texts(seed=1):
    rng = random.Random(seed)
    base = [" ".join(f"w{rng.randint(0, 999)}" for _ in range(300)) for _ in range(6)]
    texts = [None, "", "A", "a", "a B", "one two three"]
    for text in base:
        for _ in range(5):
            words = text.split()
            words[rng.randrange(300)] = "changed"
            texts.append(" ".join(words))
        texts += [text, text.upper()]
    return texts


def test_near_duplicates(spark):
    texts = near_texts()
    docs = documents(spark, texts)
    prints = [fingerprint(t) for t in texts]
    root = linked(set(prints))
    first = {}
    for i, p in enumerate(prints):
        first.setdefault(root[p], i)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).withColumn("hex", simhash.as_hex(F.col("fp"))).collect()}
    assert [got[i]["hex"] for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [got[i]["component_id"] for i in range(len(texts))] == [first[root[p]] for p in prints]
    repeated = docs.unionByName(docs.where("doc_id in (0, 8)")).unionByName(docs.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")))
    kept = sorted((r["doc_id"] for r in simhash.keep_first(repeated).collect()), key=str)
    assert kept == sorted([*set(first.values()), None], key=str)
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_large_buckets_lose_no_link(monkeypatch):
    import numpy as np

    monkeypatch.setattr(simhash, "COMPARE_AT_ONCE", 8)
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(20)}
    for p in list(prints):
        for _ in range(6):
            p ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            prints.add(p)
    found = {p: p for p in prints}

    def find(p):
        while found[p] != p:
            p = found[p]
        return p

    for a, b in simhash._roots(np.array(sorted(prints), np.uint64)):
        for x, y in zip(a.tolist(), b.tolist()):
            found[max(find(x), find(y))] = min(find(x), find(y))
    assert {p: find(p) for p in prints} == linked(prints)


def test_bucket_edges_across_batches():
    import numpy as np
    import pyarrow as pa

    prints = np.arange(5, dtype=np.int64) << 40  # bits outside the first choice of blocks
    rows = pa.RecordBatch.from_arrays([pa.array([0] * 5, pa.int32()), pa.array(prints)], ["choice", "fp"])
    joined = {tuple(e) for b in simhash._bucket_edges(iter([rows.slice(i, 1) for i in range(5)])) for e in zip(*[c.to_pylist() for c in b.columns])}
    assert {a for a, _ in joined} | {b for _, b in joined} == {i << 40 for i in range(5)}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    assert components(edges.where("a > 1000")).count() == 0


def test_exponent_meets_its_target(spark):
    sources = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10), ("d", 0)], "source string, tokens long")
    power = mixing.exponent(sources, mixing.Target(repeats=4.0))
    assert (1000 / 10) ** (1 - power) == pytest.approx(4.0, rel=1e-4)
    import math

    power = mixing.exponent(sources, mixing.Target(entropy=0.9))
    weights = [n**power for n in (1000, 100, 10)]
    entropy = -sum(w / sum(weights) * math.log(w / sum(weights)) for w in weights) / math.log(3)
    assert entropy == pytest.approx(0.9, abs=1e-4)
    assert mixing.exponent(sources.where("source = 'a'")) == 1.0
    assert mixing.exponent(sources.where("tokens >= 100"), mixing.Target(repeats=50.0)) == 0.0


def test_mixture_keeps_everything_and_meets_budgets(spark):
    rng = random.Random(2)
    texts = ["w " * rng.randint(1, 9) for _ in range(300)] + [None, ""]
    sources = [rng.choice(["big"] * 8 + ["small", None]) for _ in range(300)] + ["small", "none"]
    docs = documents(spark, texts, sources).withColumn("_cuts", F.lit(1))
    rows = docs.select("doc_id", "source", mixing.token_count(F.col("text")).alias("tokens"))
    copies, plan = mixing.schedule(rows, block_tokens=200)
    taken = copies.collect()
    assert {r["doc_id"] for r in taken} == set(range(302))
    assert len({(r["doc_id"], r["pass"]) for r in taken}) == len(taken)
    budget = {r["source"]: r["budget"] for r in plan.collect()}
    for source in ("big", "small", None):
        dealt = sorted((r["start"], r["tokens"], r["block"]) for r in taken if r["source"] == source and r["tokens"])
        ends = [s + t for s, t, _ in dealt]
        assert [s for s, _, _ in dealt] == [0, *ends[:-1]]  # gapless
        assert dealt[-1][0] < budget[source] <= ends[-1]
        assert [b for *_, b in dealt] == sorted(b for *_, b in dealt)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter(r["doc_id"] for r in taken)
    assert mixing.mix(documents(spark, [])).count() == 0


def test_quotations(spark):
    rows = [
        (1, 0, "user", "Hello there\nHow are you?"),
        (1, 1, "assistant", "> hello  THERE\nFine."),
        (1, 2, "user", "Good."),
        (1, 3, "assistant", ">> hello there\n> How are you?\nStill fine\n\n"),
        (1, 4, "user", "> Fine.\n> not said\nWhy?"),
        (2, 0, "user", None),
        (2, 1, None, ""),
        (None, 5, "user", "> x"),
        (3, 0, "user", "same"),
        (3, 0, "user", "same"),
    ]
    talk = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): r for r in quotation.link(talk).collect()}
    first = got[(1, 1)]
    assert first["text"] == "Fine." and (first["n_quoted"], first["n_linked"], first["parent_turn"]) == (1, 1, 0)
    assert (got[(1, 3)]["parent_turn"], got[(1, 3)]["text"], got[(1, 3)]["n_linked"]) == (0, "Still fine", 2)
    assert (got[(1, 4)]["parent_turn"], got[(1, 4)]["n_quoted"], got[(1, 4)]["n_linked"]) == (1, 2, 1)
    places = {t: (got[(1, t)]["branch"], got[(1, t)]["place"]) for t in range(5)}
    assert places == {0: (0, 0), 1: (0, 1), 2: (0, 2), 3: (3, 0), 4: (4, 0)}
    assert got[(2, 0)]["text"] == "" and got[(None, 5)]["n_linked"] == 0
    assert quotation.link(talk).count() == len(rows) and quotation.link(talk.where("turn > 99")).count() == 0


PAGES = {
    "<nav><a>Home</a></nav><article><h1>T &amp; x</h1><p>One\n  two<br>three<p>Last</article><footer>F</footer>": "T & x\nOne two three\nLast",
    "<article><p>A<script>var t='<p>no</p>';</script>b</p><aside>no</aside><div class='reader-comments'><p>no</p></div></article>": "Ab",
    "<main><p>x</p><form><p>Join</p></form></main><div id=cookie>no</div>": "x",
    "": "",
    None: "",
    "<p": "",
}


def test_page_text(spark):
    rows = [(i, "u", html, "clash") for i, html in enumerate(PAGES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert [(r["text"], r["n_chars"]) for r in got.orderBy("page_id").collect()] == [(t, len(t)) for t in PAGES.values()]


def test_the_tree_knows_its_table():
    rows, labels = html_text.labelled_table()
    tree = html_text.grow(rows, labels)
    right = [html_text.decide(tree, row) == label for row, label in zip(rows.tolist(), labels)]
    assert sum(right) / len(right) > 0.97
