"""Exact cuts, dense ids and ranks, compared with a plain sort."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import split as S
from textloom.plans import lookup as L
from textloom.plans import ordering as O
from textloom.plans.lookup import lookup_join, spread_join
from textloom.plans.storage import materialise


def digest(key, seed=42):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


@pytest.mark.parametrize("n,ratio", [(1000, 0.9), (7, 0.5), (1, 0.9), (10, 1.0), (10, 0.0)])
def test_split_is_exact_and_disjoint(spark, n, ratio):
    df = spark.range(n).withColumnRenamed("id", "k")
    marked = {r["k"]: r["split"] for r in S.split_by_hash(df, ["k"], ratio).collect()}
    want = set(sorted(range(n), key=lambda k: (digest(k), k))[: int(n * ratio)])
    assert {k for k, s in marked.items() if s == "train"} == want
    assert len(marked) == n


def test_split_does_not_depend_on_layout(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    sets = [
        {r["k"] for r in S.split_by_hash(df.repartition(p), ["k"]).where("split = 'train'").collect()} for p in (1, 3, 8)
    ]
    assert sets[0] == sets[1] == sets[2]


def test_cut_search_descends_levels(spark, monkeypatch):
    monkeypatch.setattr(O, "FANOUT", 4)
    monkeypatch.setattr(O, "LEAF_ROWS", 2)
    rng = random.Random(1)
    keys = rng.sample(range(-(10**12), 10**12), 300)
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for size in (1, 2, 150, 299, 300, 400):
        kept = df.where(O.first_k(df, [F.col("k")], lambda n: size))
        assert sorted(r["k"] for r in kept.collect()) == sorted(keys)[:size]


def test_cut_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(i // 10, i) for i in range(100)], "v long, k long")
    kept = df.where(O.first_k(df, [F.col("v"), F.col("k")], lambda n: 37, prefix=F.col("v")))
    assert sorted(r["k"] for r in kept.collect()) == list(range(37))


def test_prefix_counts_usable_rows_only(spark):
    rows = [(i, None if i % 3 == 0 else "" if i % 3 == 1 else f"t{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "row_id long, text string")
    assert sorted(r["row_id"] for r in S.sample_prefix(df, 4).collect()) == [2, 5, 8, 11]
    assert S.sample_prefix(df, 1000).count() == 20
    with pytest.raises(ValueError):
        S.sample_prefix(df, 0)
    stats = S.sample_stats(S.sample_prefix(df, 4)).first()
    assert (stats["n_texts"], stats["n_chars"]) == (4, 9)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_row_ids_are_dense(spark, parts):
    keys = [f"k{i:03d}" for i in random.Random(2).sample(range(1000), 200)]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(parts)
    got = {r["k"]: r["row_id"] for r in O.row_ids(df, "k").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_row_ids_of_an_empty_table(spark):
    assert O.row_ids(spark.range(0).withColumnRenamed("id", "k"), "k").count() == 0


def test_rank_within_a_hot_group(spark):
    rows = [("hot", i) for i in range(400)] + [(f"g{i % 5}", 1000 - i) for i in range(100)]
    df = spark.createDataFrame(rows, "g string, t long").repartition(6)
    got = {(r["g"], r["t"]): r["step"] for r in O.rank_within(df, ["g"], ["t"]).collect()}
    want = {}
    for g in {g for g, _ in rows}:
        for i, t in enumerate(sorted(t for h, t in rows if h == g), 1):
            want[(g, t)] = i
    assert got == want


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_lookup_join_both_ways(spark, monkeypatch, capsys, limit):
    monkeypatch.setattr(L, "BROADCAST_BYTES", limit)
    facts = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(60)], "i int, k string")
    lookup = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3)], "k string, v int")
    got = lookup_join(facts, lookup, ["k"], salt_by=["i"], how="left")
    got.explain("extended")
    assert ("_salt" in capsys.readouterr().out) == (limit == 0)
    want = {i: {"hot": 1, "k0": 2, "k3": 3}.get("hot" if i % 3 else f"k{i}") for i in range(60)}
    assert {r["i"]: r["v"] for r in got.collect()} == want
    assert sorted(got.columns) == ["i", "k", "v"]


def test_select_by_index_keeps_order_and_repeats(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(10)], "row_id long, text string")
    index = spark.createDataFrame([(7, 0), (2, 1), (7, 2)], "row_id long, place long")
    rows = S.select_by_index(df, index).orderBy("place").collect()
    assert [r["text"] for r in rows] == ["t7", "t2", "t7"]


def test_no_window_without_partition_keys(spark, capsys):
    df = spark.range(100).withColumnRenamed("id", "k")
    for frame in (O.row_ids(df, "k"), S.split_by_hash(df, ["k"]), O.rank_within(df.withColumn("g", F.col("k") % 2), ["g"], ["k"])):
        frame.explain()
        plan = capsys.readouterr().out
        assert "Window" not in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("hot", [4_096, 50])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join(spark, monkeypatch, hot, how):
    monkeypatch.setattr(L, "HOT_FACTS", hot)
    rows = [(i, None if i % 50 == 0 else 7 if i % 3 else i % 40) for i in range(3000)]
    facts = materialise(spark.createDataFrame(rows, "i long, k int"), "facts")
    names = spark.createDataFrame([(k, f"name {k}") for k in range(30)], "k int, name string")
    joined = spread_join(facts, names, "k", ["i"], how)
    want = [(i, k, f"name {k}" if k is not None and k < 30 else None) for i, k in rows]
    want = [w for w in want if how == "left" or w[2]]
    assert sorted(map(tuple, joined.select("i", "k", "name").collect())) == sorted(want)
    assert sorted(joined.columns) == ["i", "k", "name"]
    none = spread_join(materialise(facts.limit(0), "facts"), names, "k", ["i"], how)
    assert none.count() == 0


def test_spread_join_deals_a_hot_key_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(L, "HOT_FACTS", 100)
    facts = materialise(spark.range(10_000).select("id", F.lit(1).alias("k")), "facts")
    names = spark.createDataFrame([(1, "one"), (2, "two")], "k int, name string").hint("merge")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = spread_join(facts, names, "k", ["id"]).groupBy(F.spark_partition_id()).count().collect()
        assert sum(t["count"] for t in tasks) == 10_000 and max(t["count"] for t in tasks) < 5_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
