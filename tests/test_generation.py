"""Jump and alias tables against steps one at a time."""

import hashlib
import math
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.operators import generation as G
from textloom.operators import scoring as S
from textloom.plans import lookup
from textloom.plans.storage import materialise

COUNTS = "input_id int, label int, n long"


def sample(seed, vocabulary=30):
    rng = random.Random(seed)
    rows = {(rng.randrange(vocabulary), rng.randrange(vocabulary)): rng.randint(1, 9) for _ in range(4 * vocabulary)}
    return [(a, b, n) for (a, b), n in rows.items() if a % 7]


def prompts(spark):
    rng = random.Random(1)
    rows = [(i, [rng.randrange(40) for _ in range(rng.randint(0, 4))]) for i in range(60)] + [(99, [10**6])]
    return spark.createDataFrame(rows, "k long, ids array<int>"), rows


@pytest.mark.parametrize("steps, limit", [(1, 1 << 20), (2, 1 << 20), (7, 0), (100, 1 << 20)])
def test_walks_equal_single_steps(spark, monkeypatch, steps, limit):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", limit)
    counts = sample(steps)
    best = {}
    for a, b, n in sorted(counts, key=lambda r: (-r[2], r[1])):
        best.setdefault(a, b)
    table = materialise(S.successors(spark.createDataFrame(counts, COUNTS)), "successors")
    df, rows = prompts(spark)
    following = table.selectExpr("input_id", "next_ids[0] AS next_id")
    got = {r["k"]: r["new_ids"] for r in G.generate_greedy(df, following, ["k"], steps).collect()}
    for k, ids in rows:
        want, at = [], ids[-1] if ids else None
        for _ in range(steps):
            at = best.get(at, 0)
            want.append(at)
        assert got[k] == want
    if steps <= 7:
        again = S.generate(df, table, ["k"], steps, 3).collect()
        assert {r["k"]: r["new_ids"] for r in again} == got


def test_walks_of_an_empty_model(spark):
    df, rows = prompts(spark)
    following = spark.createDataFrame([], "input_id int, next_id int")
    assert {tuple(r["new_ids"]) for r in G.generate_greedy(df, following, ["k"], 3).collect()} == {(0, 0, 0)}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=1, max_size=40))
def test_alias_columns_give_exact_shares(weights):
    cut, alias = G.alias_columns(weights)
    total, units = sum(weights), Counter()
    for i, c in enumerate(cut):
        assert 0 <= c <= total
        units[i] += c
        units[alias[i]] += total - c
    assert [units[i] for i in range(len(weights))] == [w * len(weights) for w in weights]


def unit(digest, first):
    return int(digest[first : first + 13], 16) / 16**13


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_sampled_generation_equals_single_draws(spark, monkeypatch, limit):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", limit)
    counts = sample(5)
    table = materialise(G.alias_table(spark.createDataFrame(counts, "input_id int, label int, weight long")), "alias")
    by_id = {}
    for a, b, n in sorted(counts):
        by_id.setdefault(a, []).append((b, n))
    df, rows = prompts(spark)
    got = {r["k"]: r["new_ids"] for r in G.generate_sampled(df.repartition(5), table, ["k"], 20, seed=7).collect()}
    for k, ids in rows:
        at, want = ids[-1] if ids else None, []
        for step in range(20):
            digest = hashlib.md5(f"7:{step}:{k}".encode()).hexdigest()
            if at in by_id:
                labels, weights = zip(*by_id[at])
                cut, alias = G.alias_columns(list(weights))
                i = math.floor(unit(digest, 0) * len(labels))
                at = labels[i] if math.floor(unit(digest, 13) * sum(weights)) < cut[i] else labels[alias[i]]
            else:
                at = 0
            want.append(at)
        assert got[k] == want


def test_draws_follow_the_probabilities(spark):
    counts = spark.createDataFrame([(5, 6, 1), (5, 7, 3), (5, 8, 6)], COUNTS)
    table = materialise(G.alias_table(G.weights_of(S.successors(counts, 2, 1.0))), "alias")
    df = spark.range(6000).selectExpr("id AS k", "array(5) AS ids")
    drawn = Counter(r["new_ids"][0] for r in G.generate_sampled(df, table, ["k"], 1).collect())
    assert set(drawn) == {7, 8} and drawn[8] / 6000 == pytest.approx(2 / 3, abs=0.03)
