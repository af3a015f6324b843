"""The keyed permutation of an epoch: one place per row, both ways, from any step on."""

import hashlib

import pytest
from pyspark.sql import functions as F

from textloom.operators import permutation as P


def by_hand(x, n, key):
    a, b = P.sides(n)
    while True:
        left, right = divmod(x, b)
        for k in range(P.ROUNDS):
            digest = hashlib.md5(f"{key}:{k}:{left if k % 2 else right}".encode()).hexdigest()
            by = int(digest[: P.DIGITS], 16)
            left, right = (left, (right + by) % b) if k % 2 else ((left + by) % a, right)
        x = left * b + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 13, 64, 257, 1000, 4099])
def test_one_place_per_row(spark, n):
    rows = spark.range(n).select("id", P.permuted(F.col("id"), n, 42, 3).alias("p"))
    both = rows.select("id", "p", P.permuted(F.col("p"), n, 42, 3, inverse=True).alias("back")).collect()
    assert sorted(r["p"] for r in both) == list(range(n)) and all(r["back"] == r["id"] for r in both)
    assert {r["id"]: r["p"] for r in both} == {i: by_hand(i, n, "42:3") for i in range(n)}


@pytest.mark.parametrize("n", range(1, 200, 7))
def test_sides_hold_all_rows(n):
    a, b = P.sides(n)
    assert n <= a * b < n + a


def test_epochs_and_seeds_differ(spark):
    n = 500
    orders = [
        tuple(r[0] for r in spark.range(n).select(P.permuted(F.col("id"), n, s, e)).collect()) for s, e in ((1, 0), (1, 1), (2, 0))
    ]
    assert len(set(orders)) == 3
    still = sum(i == p for o in orders for i, p in enumerate(o))
    assert still < 20


def test_an_epoch_needs_no_shuffle(spark, capsys):
    P.epoch_places(spark.range(1000).withColumnRenamed("id", "row_id"), 1000, 2).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_resuming_gives_the_same_rows(spark):
    whole = {tuple(r) for r in P.step_rows(spark, 103, 1, 25, 10).collect()}
    later = {tuple(r) for r in P.step_rows(spark, 103, 14, 25, 10).collect()}
    assert later == {r for r in whole if r[0] >= 14}
    for epoch in (0, 1):
        mine = [r for r in whole if r[1] == epoch]
        assert sorted(r[4] for r in mine) == list(range(103)) and sorted(r[3] for r in mine) == list(range(103))
        assert {r[4]: r[3] for r in mine} == {i: by_hand(i, 103, f"42:{epoch}") for i in range(103)}
    # 11 steps an epoch, the last one of three rows
    assert sum(r[0] == 11 for r in whole) == 3 and max(r[0] for r in whole) == 25
