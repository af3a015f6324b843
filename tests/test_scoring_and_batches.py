"""Count model, generation, batches."""

import math

import pytest

from textloom.operators import batches as B
from textloom.operators import scoring as S
from textloom.plans import lookup
from textloom.plans.storage import materialise

IDS = {1: [5, 6, 5, 6], 2: [], 3: [6, 6, 6, 6, 6, 6], 4: [5]}
LENGTH = 5


def pairs_by_hand(ids):
    x = (ids[:LENGTH] + [1] * LENGTH)[:LENGTH]
    return list(zip(x, x[1:] + [1]))


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(IDS.items()), "k long, ids array<int>")


def test_pairs_include_padding(rows):
    got = S.fit_counts(rows, max_length=LENGTH).collect()
    want = {}
    for ids in IDS.values():
        for p in pairs_by_hand(ids):
            want[p] = want.get(p, 0) + 1
    assert {(r["input_id"], r["label"]): r["n"] for r in got} == want


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_heldout_losses(spark, rows, monkeypatch, limit):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", limit)
    counts = materialise(S.fit_counts(rows.where("k in (1, 4)"), max_length=LENGTH), "counts")
    fit = {(r["input_id"], r["label"]): r["n"] for r in counts.collect()}
    vocab = 9

    def loss(a, b):
        return -math.log((fit.get((a, b), 0) + 1) / (sum(n for (x, _), n in fit.items() if x == a) + vocab))

    per_doc = {k: [loss(a, b) for a, b in pairs_by_hand(ids)] for k, ids in IDS.items()}
    got = {r["k"]: r for r in S.heldout_by_document(rows, counts, vocab, "k", max_length=LENGTH).collect()}
    for k, losses in per_doc.items():
        assert got[k]["n_pairs"] == LENGTH
        assert got[k]["loss"] == pytest.approx(sum(losses) / LENGTH)
        assert got[k]["perplexity"] == pytest.approx(math.exp(sum(losses) / LENGTH))
    every = [x for losses in per_doc.values() for x in losses]
    overall = S.heldout_overall(rows, counts, vocab, max_length=LENGTH).first()
    assert overall["n_pairs"] == len(every) and overall["loss"] == pytest.approx(sum(every) / len(every))


@pytest.fixture(scope="module")
def counts(spark):
    return spark.createDataFrame([(5, 6, 4), (5, 7, 4), (5, 8, 1), (6, 5, 2), (7, 5, 1)], "input_id int, label int, n long")


def test_successors(counts):
    got = {r["input_id"]: (r["next_ids"], r["probs"]) for r in S.successors(counts, 2, 0.5).collect()}
    assert got[5] == ([6, 7], pytest.approx([0.5, 0.5]))
    got = {r["input_id"]: r["next_ids"] for r in S.successors(counts, 1).collect()}
    assert got == {5: [6], 6: [5], 7: [5]}
    got = {r["input_id"]: r["probs"] for r in S.successors(counts, 0, 0.5).collect()}
    assert got[5] == pytest.approx([16 / 33, 16 / 33, 1 / 33])


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_greedy_generation(spark, counts, monkeypatch, limit):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", limit)
    prompts = spark.createDataFrame([(1, [9, 5]), (2, [6]), (3, []), (4, [99])], "k long, ids array<int>")
    following = materialise(S.successors(counts), "successors")
    made = {r["k"]: r["new_ids"] for r in S.generate(prompts, following, ["k"], 3, 2).collect()}
    assert made == {1: [6, 5, 6], 2: [5, 6, 5], 3: [0, 0, 0], 4: [0, 0, 0]}


def test_long_generation_is_repeatable(spark, counts):
    prompts = spark.createDataFrame([(i, [5]) for i in range(40)], "k long, ids array<int>")
    following = materialise(S.successors(counts, 3), "successors")
    runs = [
        {r["k"]: r["new_ids"] for r in S.generate(prompts.repartition(p), following, ["k"], 20, 4).collect()}
        for p in (1, 7)
    ]
    assert runs[0] == runs[1]
    assert all(len(ids) == 20 for ids in runs[0].values())
    assert {ids[0] for ids in runs[0].values()} >= {6, 7}


def test_batches(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    first, again, other = (B.epoch_positions(df.repartition(p), ["k"], e).collect() for p, e in ((1, 0), (5, 0), (1, 1)))
    assert sorted(first) == sorted(again) and sorted(first) != sorted(other)
    assert sorted(r["pos"] for r in first) == list(range(10))
    assembled = B.assemble(B.sequential_positions(df, ["k"]), ["k"], 4).orderBy("batch_id").collect()
    assert [(r["n_rows"], r["k"]) for r in assembled] == [(4, [0, 1, 2, 3]), (4, [4, 5, 6, 7]), (2, [8, 9])]


def test_step_plan(spark):
    plan = [tuple(r) for r in B.step_plan(spark, B.n_batches(65, 32), 7).orderBy("step").collect()]
    assert plan == [(1, 0, 0), (2, 0, 1), (3, 0, 2), (4, 1, 0), (5, 1, 1), (6, 1, 2), (7, 2, 0)]
    with pytest.raises(ValueError):
        B.step_plan(spark, 0)


def test_padding(spark):
    df = spark.createDataFrame([("a", [5]), ("b", [5, 6, 7]), ("c", [])], "k string, ids array<int>")
    places = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "k string, pos long")
    got = {r["pos"]: r for r in B.pad_to_longest(df, places, ["k"], batch_size=2).collect()}
    assert got[0]["input_ids"] == [5, 1, 1] and got[0]["attention_mask"] == [1, 0, 0]
    assert got[1]["attention_mask"] == [1, 1, 1] and got[2]["input_ids"] == []
    waste = {r["batch_id"]: (r["waste_fixed"], r["waste_dynamic"]) for r in B.padding_waste(df, places, ["k"], 4, batch_size=2).collect()}
    assert waste == {0: (pytest.approx(0.5), pytest.approx(1 / 3)), 1: (1.0, 0.0)}


def test_no_ids_are_shuffled_for_padding_waste(spark):
    df = spark.createDataFrame([("a", [5])], "k string, ids array<int>")
    places = spark.createDataFrame([("a", 0)], "k string, pos long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = B.padding_waste(df, places, ["k"], 4)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for line in plan.split("\n"):
        assert "Exchange" not in line or "ids#" not in line
    below = plan.split("Exchange")[-1]
    assert "size(ids" in plan and below
