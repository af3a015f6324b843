"""Long score tables against the array form and plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from textloom.functions import scores as A
from textloom.operators import score_tables as T
from textloom.plans import lookup


def table(spark, seed=0):
    rng = random.Random(seed)
    rows = []
    for seq in range(6):
        for pos in range(3):
            for token in range(rng.randint(1, 60)):
                rows.append((seq, pos, token, rng.choice([rng.uniform(-5, 5), 1.25, 1.25, 700.0 if seq == 3 else -700.0])))
    return rows, spark.createDataFrame(rows, "seq int, pos int, token_id int, logit double").repartition(4)


def by_position(rows):
    out = {}
    for s, p, t, z in rows:
        out.setdefault((s, p), {})[t] = z
    return out


@pytest.mark.parametrize("chunks", [1, 4, 100])
def test_cross_entropy_equals_the_array_form(spark, chunks):
    rows, df = table(spark)
    targets = spark.createDataFrame([(s, p, 0) for s, p in by_position(rows)] + [(0, 9, 1), (0, 0, 999)], "seq int, pos int, target int")
    got = {}
    for r in T.cross_entropy(df, targets.where("target = 0"), ["seq", "pos"], chunks).collect():
        got[r["seq"], r["pos"]] = r["loss"]
    arrays = df.groupBy("seq", "pos").agg(F.array_sort(F.collect_list(F.struct("token_id", "logit"))).alias("e"))
    want = arrays.select("seq", "pos", A.cross_entropy(F.col("e.logit"), F.lit(0)).alias("loss")).collect()
    assert got == {(r["seq"], r["pos"]): pytest.approx(r["loss"]) for r in want}
    missing = T.cross_entropy(df, targets.where("target != 0"), ["seq", "pos"], chunks).collect()
    assert [r["loss"] for r in missing] == [None, None]


@pytest.mark.parametrize("k, limit", [(1, 1 << 20), (5, 0), (1000, 1 << 20), (0, 0)])
def test_top_k_keeps_ties(spark, monkeypatch, k, limit):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", limit)
    rows, df = table(spark, k)
    want = set()
    for (s, p), found in by_position(rows).items():
        cut = sorted(found.values(), reverse=True)[min(k, len(found)) - 1] if k > 0 else -math.inf
        want |= {(s, p, t) for t, z in found.items() if z >= cut}
    got = [(r["seq"], r["pos"], r["token_id"]) for r in T.top_k(df, ["seq", "pos"], k, 3).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_softmax_and_greedy(spark):
    rows, df = table(spark, 7)
    empty = df.where("seq < 0")
    got = {(r["seq"], r["pos"], r["token_id"]): r["p"] for r in T.softmax(df, ["seq", "pos"], 0.5, 4).collect()}
    best = {(r["seq"], r["pos"]): r["token_id"] for r in T.greedy(df, ["seq", "pos"]).collect()}
    for (s, p), found in by_position(rows).items():
        top = max(found.values())
        total = sum(math.exp((z - top) / 0.5) for z in found.values())
        assert all(got[s, p, t] == pytest.approx(math.exp((z - top) / 0.5) / total) for t, z in found.items())
        assert best[s, p] == min(t for t, z in found.items() if z == top)
    assert T.softmax(empty, ["seq", "pos"]).count() == T.top_k(empty, ["seq", "pos"], 3).count() == 0


def test_sums_are_partial_in_the_plan(spark, capsys):
    T.log_sum_exp(spark.range(10).selectExpr("id % 3 AS seq", "id AS token_id", "id * 1.0D AS logit"), ["seq"]).explain()
    plan = capsys.readouterr().out
    assert "partial_max" in plan and "partial_sum" in plan and "SinglePartition" not in plan
