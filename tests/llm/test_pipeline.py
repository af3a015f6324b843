"""Registered queries against their SQL, and the pipeline against brute force, stage by stage."""

import os
import random
from collections import Counter

import pytest

import corpus_pipeline
from oracle import compare, connect
from test_scale_operators import best_fit, repeats_by_hand
from test_near_copies import by_hand
from test_text_operators import DOC, measured
from textloom.llm import mixing, quality_rules, queries
from textloom.plans.storage import materialise

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, queries.QUERIES[name], queries.SQL[name]) is None


def test_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {q[: q.index("_") + 1] for q in names if q.startswith("op")}
    assert "pipeline" in names and [s[0] for s in corpus_pipeline.STAGES][1] == "near duplicates"


def corpus():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 8)))
    shared = " ".join(word() for _ in range(80))
    rows = []
    for i in range(80):
        text = " ".join(word() for _ in range(rng.randint(25, 300)))
        if i % 5 == 0:
            text += "\n" + shared
        rows.append([i, text, "en", "big" if i % 8 else "small", len(text)])
    rows += [[100 + i, rows[i][1], "en", "big", 0] for i in range(10)]
    rows += [[200, "too few words", "en", "big", 0], [201, None, None, None, None], [202, "$# " * 50, "en", "small", 0]]
    # near copies of the longest texts: a word changed here and there
    longest = sorted((r for r in rows[:80]), key=lambda r: -len(r[1]))[:3]
    for k, r in enumerate(longest):
        words = r[1].split(" ")
        for at in (20, 60, 100)[: k + 1]:
            words[at] = "changed"
        rows.append([300 + k, " ".join(words), "en", "small", 0])
    rows += [[303, "same words again and again here now yes " * 6, "en", "small", 0]]
    return rows


def test_pipeline_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, DOC)
    made = []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, ""), "test-stage")
        made.append(docs)
        assert name == "packing" or docs.columns == [c.split()[0] for c in DOC.split(", ")]
    kept = [r for r in rows if not any(eval(test, {}, measured(r[1])) for test in quality_rules.RULES.values())]
    assert sorted(r["doc_id"] for r in made[0].collect()) == sorted(r[0] for r in kept)
    first = by_hand([r[1] for r in kept])
    unique = [r for i, r in enumerate(kept) if first[i] == i]
    assert {r[0] for r in kept} - {r[0] for r in unique} >= {100, 109, 301, 302}
    assert sorted(r["doc_id"] for r in made[1].collect()) == sorted(r[0] for r in unique)
    text = {k: (t.decode("utf-8", "ignore"), gone) for k, _, gone, _, t in repeats_by_hand([(r[0], r[1]) for r in unique])}
    got = {r["doc_id"]: r for r in made[2].collect()}
    assert set(got) == set(text)
    for key, (left, gone) in text.items():
        # characters that are only partly covered stay whole
        assert len(left) <= len(got[key]["text"]) <= len(left) + 4 and got[key]["n_chars"] == len(got[key]["text"])
        assert gone or got[key]["text"] == left
    tokens = Counter()
    for r in got.values():
        tokens[r["source"]] += len(r["text"].split())
    power = mixing.exponent(spark.createDataFrame(list(tokens.items()), "source string, tokens long"))
    copies = Counter(r["doc_id"] for r in made[3].collect())
    assert set(copies) == set(got)
    for source, n in tokens.items():
        budget = n * (max(tokens.values()) / n) ** (1 - power)
        dealt = sum(copies[k] * len(r["text"].split()) for k, r in got.items() if r["source"] == source)
        assert budget - 1 <= dealt <= budget + 400  # the last document reaches over the budget
    packed = made[4].collect()
    assert Counter((r["doc_id"]) for r in packed if r["piece"] == 0) == copies
    assert len({r["sequence_id"] for r in packed}) == sum(best_fit([r["length"] for r in packed], 2048).values())


def test_pipeline_on_an_empty_table(spark):
    docs = spark.createDataFrame([], DOC)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, ""), "test-stage")
    assert docs.count() == 0
