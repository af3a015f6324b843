"""Queries that use the whole vocabulary, against a sequential fit to it on a small table."""

import math
import random
from collections import Counter

import pytest

from oracle import compare, connect
from test_bpe import one_at_a_time
from textloom.operators.bpe import BpeModel, merge_word
from textloom.operators.scoring import score_pairs
from textloom.operators.split import split_by_hash
from textloom.plans import lookup
from textloom.plans.storage import materialise
from textloom.queries import QUERIES, SQL, common

# "abc" comes from ab+c and from a+bc: one id, two merges
REUSED = {"ab": 50, "abc": 30, "zbc": 60, "bc": 70, "xab": 5, "abcx": 4, "qabc": 9}


def corpus():
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdé", k=rng.randint(1, 9))) for _ in range(150)] + ["a" * 7, "b" * 4, "..!", "!!!!!"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(60)]
    return rows + [(60, None), (61, ""), (62, " ".join(w for w, n in REUSED.items() for _ in range(n)))]


ROWS = corpus()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("whole"))
    spark.createDataFrame(ROWS, "doc_id long, text string").coalesce(1).write.parquet(f"{path}/parts")
    spark.read.parquet(f"{path}/parts").toPandas().to_parquet(f"{path}/documents.parquet", index=False)
    return path


def words_of(text):
    """Runs of letters and runs of other signs."""
    out = []
    for part in (text or "").split():
        for i, c in enumerate(part):
            if i and part[i - 1].isalpha() == c.isalpha():
                out[-1] += c
            else:
                out.append(c)
    return out


@pytest.fixture(scope="module")
def fitted():
    """(tokens, ids by document) of a fit that goes on while a pair is seen often enough."""
    tokens, merges = one_at_a_time(Counter(w for _, t in ROWS for w in words_of(t)), 8192)
    assert len(merges) > 10 * common.N_MERGES
    model = BpeModel(tokens, sum(len(t) == 1 for t in tokens), merges)
    ids, ranks = model.ids, model.merge_ranks()
    return tokens, {k: [i for w in words_of(t) for i in merge_word([ids[c] for c in w], ranks)] for k, t in ROWS}


@pytest.fixture(scope="module")
def pairs(spark, folder, fitted):
    """Pairs of the train and of the validation split."""
    out = {"train": Counter(), "validation": Counter()}
    for r in split_by_hash(spark.read.parquet(f"{folder}/documents.parquet"), ["doc_id"]).collect():
        ids = fitted[1][r["doc_id"]]
        out[r["split"]].update(zip(ids, [*ids[1:], 1]))
    return out


def test_bigrams_are_of_the_whole_vocabulary(spark, folder, pairs):
    got = QUERIES["bigram_counts"](spark, folder).collect()
    assert {(r["input_id"], r["label"]): r["n"] for r in got} == pairs["train"]


def test_sql_of_the_whole_fit_in_small_steps(folder, fitted, monkeypatch):
    monkeypatch.setattr(common, "WINDOW", 3)
    sql = common.with_recursive_sql(common.full_fit_sql()) + "SELECT token FROM vocab ORDER BY id"
    assert [t for (t,) in connect(folder).execute(sql).fetchall()] == fitted[0]


def test_sql_of_the_whole_fit_stops_at_the_size(folder, fitted, monkeypatch):
    monkeypatch.setattr(common, "VOCAB_SIZE", 100)
    sql = common.with_recursive_sql(common.full_fit_sql()) + "SELECT token FROM vocab ORDER BY id"
    assert [t for (t,) in connect(folder).execute(sql).fetchall()] == fitted[0][:100]


WHOLE = ["bigram_counts", "heldout_overall", "padding_waste", "vocab_size"]


@pytest.mark.parametrize("name", WHOLE)
def test_whole_query_equals_its_sql(spark, folder, name):
    assert compare(spark, connect(folder), folder, QUERIES[name], SQL[name]) is None


def test_heldout_loss_is_of_the_whole_vocabulary(spark, folder, fitted, pairs):
    totals = Counter()
    for (x, _), n in pairs["train"].items():
        totals[x] += n
    n_pairs = sum(pairs["validation"].values())
    losses = [n * -math.log((pairs["train"][p] + 1) / (totals[p[0]] + len(fitted[0]))) for p, n in pairs["validation"].items()]
    got = QUERIES["heldout_overall"](spark, folder).first()
    assert got["n_pairs"] == n_pairs and got["loss"] == pytest.approx(sum(losses) / n_pairs, abs=1e-6)


def test_summed_pairs_meet_counts_beyond_a_broadcast_without_repeating_them(spark, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    counts = materialise(spark.createDataFrame([(5, 6, 4), (6, 5, 2)], "input_id int, label int, n long"), "counts")
    pairs = spark.createDataFrame([(5, 6, 3), (6, 7, 1)], "input_id int, label int, w long")
    scored = score_pairs(pairs, counts, 9, [])
    assert "Generate" not in scored._jdf.queryExecution().optimizedPlan().toString()
    assert {r["label"]: r["loss"] for r in scored.collect()} == pytest.approx({6: -math.log(5 / 13), 7: -math.log(1 / 11)})


def test_padding_counts_ids_of_the_whole_vocabulary(spark, folder, fitted):
    got = QUERIES["padding_waste"](spark, folder).collect()
    assert sum(r["n_rows"] for r in got) == len(ROWS)
    assert sum(r["n_real"] for r in got) == sum(min(len(ids), common.MAX_LENGTH) for ids in fitted[1].values())


def test_vocabulary_is_that_of_a_whole_fit(spark, folder, fitted):
    assert QUERIES["vocab_size"](spark, folder).first()["vocab_size"] == len(fitted[0])
