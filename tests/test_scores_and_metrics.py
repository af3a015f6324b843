"""Score arrays, losses, metric logs, checkpoints, artifacts; batch and stream."""

import math
import os

import pytest
from pyspark.sql import functions as F

from textloom.functions import scores as Z
from textloom.operators import metrics as M
from textloom.plans.storage import scratch_path
from textloom.streaming.metric_stream import keep_latest_checkpoint, latest_table, run_to_table, stream_metric_windows

TIES = [[3.0, 1.0, 3.0, 2.0], [1.0, 1.0, 1.0, 1.0], [4.0, 3.0, 2.0, 1.0]]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(i, z) for i, z in enumerate(TIES)], "k int, z array<double>")


def values(df, c):
    return [r[0] for r in df.orderBy("k").select(c).collect()]


def test_top_k_keeps_ties(rows):
    def kept(k):
        return [[i for i, z in enumerate(r) if z is not None] for r in values(rows, Z.top_k_mask(F.col("z"), k))]

    assert kept(1) == [[0, 2], [0, 1, 2, 3], [0]]
    assert kept(3) == [[0, 2, 3], [0, 1, 2, 3], [0, 1, 2]]
    assert kept(9) == kept(0) == [[0, 1, 2, 3]] * 3


def test_softmax_sums_to_one(rows):
    for k in (0, 1, 2):
        for p in values(rows, Z.softmax(Z.top_k_mask(Z.scale(F.col("z"), 0.5), k))):
            assert math.isclose(sum(p), 1.0)
    p = values(rows, Z.softmax(Z.top_k_mask(F.col("z"), 2)))[2]
    assert p == pytest.approx([math.e / (math.e + 1), 1 / (math.e + 1), 0, 0])


def test_pick_follows_cumulative_probability(spark):
    df = spark.createDataFrame([(0, [0.0, 0.5, 0.0, 0.5, 0.0])], "k int, p array<double>")
    for u, want in ((0.0, 1), (0.49, 1), (0.5, 3), (0.999, 3), (1.0, 3)):
        assert df.select(Z.pick(F.col("p"), F.lit(u))).first()[0] == want


def test_greedy_takes_lowest_id(rows):
    assert values(rows, Z.greedy(F.col("z"))) == [0, 0, 0]


def test_cross_entropy_and_perplexity(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0], 0), (1, [1000.0, 0.0], 1), (2, [0.0, 5.0], 1)], "k int, z array<double>, t int")
    losses = M.position_losses(df, "z", "t")
    want = [math.log(2), 1000.0, math.log(1 + math.exp(-5))]
    assert values(losses, "loss") == pytest.approx(want)
    mean = M.mean_loss(losses.where("k <> 1")).first()
    assert mean["loss"] == pytest.approx((want[0] + want[2]) / 2)
    assert mean["perplexity"] == pytest.approx(math.exp((want[0] + want[2]) / 2))
    assert M.position_losses(df, "z", "t", pad_id=1).count() == 1


@pytest.fixture(scope="module")
def log(spark):
    rows = [(run, step, float((step * 7 + run) % 11)) for run in (1, 2) for step in range(1, 26)]
    return spark.createDataFrame(rows, "run long, step long, value double").repartition(5)


def windows_by_hand():
    out = {}
    for run in (1, 2):
        for end in (10, 20):
            loss = sum(float((s * 7 + run) % 11) for s in range(end - 9, end + 1)) / 10
            out[(run, end)] = (pytest.approx(loss), pytest.approx(math.exp(loss)))
    return out


def as_windows(df):
    return {(r["run"], r["step"]): (r["train_loss"], r["train_perplexity"]) for r in df.collect()}


def test_unfinished_window_is_not_emitted(log):
    assert as_windows(M.metric_windows(log)) == windows_by_hand()


@pytest.mark.parametrize("files,per_key", [(1, 64), (4, 64), (4, 1)])
def test_stream_equals_batch(spark, log, files, per_key):
    source, sink = scratch_path(spark, "log"), scratch_path(spark, "out")
    log.orderBy(F.rand(3)).repartition(files).write.parquet(source)  # arrival order does not matter
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(source)
    run_to_table(stream_metric_windows(stream, windows_per_key=per_key), sink, scratch_path(spark, "state"))
    assert as_windows(spark.read.parquet(sink)) == windows_by_hand()


def test_validation_steps(log):
    assert sorted((r["run"], r["step"]) for r in M.every(log, 12).collect()) == [(1, 12), (1, 24), (2, 12), (2, 24)]


def test_stream_equals_batch_with_repeats_and_named_runs(spark):
    rows = [(run, step, float(step), step) for run in ("run-a", "run-b") for step in range(1, 21)]
    rows += [("run-a", 5, 99.0, 100), ("run-b", 20, 99.0, 101)]
    log = spark.createDataFrame(rows, "run string, step long, value double, seq long")
    source, sink = scratch_path(spark, "log"), scratch_path(spark, "out")
    log.repartitionByRange(4, "seq").write.parquet(source)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(source)
    run_to_table(stream_metric_windows(stream), sink, scratch_path(spark, "state"))
    got, want = (sorted((r["run"], r["step"], r["train_loss"]) for r in df.collect()) for df in (spark.read.parquet(sink), M.metric_windows(log)))
    assert got == want == [(r, s, s - 4.5) for r in ("run-a", "run-b") for s in (10, 20)]


@pytest.mark.parametrize("partitions", [1, 5])
def test_running_best(spark, log, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    got = {(r["run"], r["step"]): r["best"] for r in M.running_best(log).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", before)
    for run in (1, 2):
        best = math.inf
        for step in range(1, 26):
            best = min(best, float((step * 7 + run) % 11))
            assert got[(run, step)] == best
    assert len(got) == 50


def test_capped_eval_divides_by_batches_seen(spark):
    batches = spark.createDataFrame([(i, float(i)) for i in range(5)], "batch_id long, loss double")
    assert tuple(M.capped_eval(batches, 3).first())[:2] == (3, 1.0)
    assert tuple(M.capped_eval(batches, 100).first())[:2] == (5, 2.0)


def test_metric_history_merges_a_step(spark):
    rows = [(1, 10, "train_loss", 2.0, 0), (1, 10, "val_loss", 3.0, 1), (1, 10, "train_loss", 1.5, 2), (1, 20, "train_loss", 1.0, 3)]
    log = spark.createDataFrame(rows, "run long, step long, metric string, value double, seq long")
    got = M.metric_history(log, ["train_loss", "val_loss"]).orderBy("step").collect()
    assert [tuple(r) for r in got] == [(1, 10, 1.5, 3.0), (1, 20, 1.0, None)]


@pytest.fixture(scope="module")
def checkpoints(spark):
    rows = [(1, 1000, 2.0, "a"), (1, 3000, 2.5, "c"), (1, 2000, 1.0, "b"), (2, 1000, 4.0, "d")]
    return spark.createDataFrame(rows, "run long, step long, val_loss double, payload_ref string")


LATEST = [(1, 3000, 2.5, "c"), (2, 1000, 4.0, "d")]


def test_latest_checkpoint(checkpoints):
    assert sorted(tuple(r) for r in M.latest_checkpoint(checkpoints).collect()) == LATEST


def test_latest_checkpoint_stream(spark, checkpoints):
    source, sink = scratch_path(spark, "ckpt"), scratch_path(spark, "latest")
    checkpoints.repartition(4, "step").write.parquet(source)
    stream = spark.readStream.schema(checkpoints.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = keep_latest_checkpoint(stream, sink, scratch_path(spark, "state"))
    assert sorted(tuple(r) for r in latest_table(spark, sink, query.lastProgress["batchId"]).collect()) == LATEST


def test_latest_checkpoint_stream_keeps_two_tables(spark):
    source, sink = scratch_path(spark, "ckpt"), scratch_path(spark, "latest")
    rows = spark.range(20).select(F.lit(1).alias("run"), F.col("id").alias("step"), F.lit(0.5).alias("val_loss"), F.lit("p").alias("payload_ref"))
    rows.repartitionByRange(20, "step").write.parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = keep_latest_checkpoint(stream, sink, scratch_path(spark, "state"))
    assert query.lastProgress["batchId"] >= 15
    assert sorted(os.listdir(sink.removeprefix("file://"))) == ["turn=0", "turn=1"]
    assert [r["step"] for r in latest_table(spark, sink, query.lastProgress["batchId"]).collect()] == [19]


def test_append_metrics(spark):
    path = scratch_path(spark, "metrics")
    for step in (1, 2):
        M.append_metrics(spark.createDataFrame([("r", step, "loss", 1.0 / step, step)], "run string, step long, metric string, value double, seq long"), path)
    assert [tuple(r) for r in M.metric_history(spark.read.parquet(path), ["loss"]).orderBy("step").collect()] == [("r", 1, 1.0), ("r", 2, 0.5)]


def test_artifacts(spark):
    uploads = spark.createDataFrame([("t/p/m", 100, "x"), ("t/p/m", 300, "y"), ("t/p/n", 200, "z")], "name string, created_step long, path string")
    registry = M.artifact_versions(uploads)
    assert sorted(tuple(r)[:3] for r in registry.collect()) == [("t/p/m", 0, "x"), ("t/p/m", 1, "y"), ("t/p/n", 0, "z")]
    for ref, path in (("t/p/m:latest", "y"), ("t/p/m:v0", "x"), ("t/p/m:1", "y")):
        assert [r["path"] for r in M.resolve_artifact(registry, ref).collect()] == [path]
        assert M.resolve_upload(uploads, ref).collect() == M.resolve_artifact(registry, ref).collect()
    assert M.resolve_artifact(registry, "t/p/none:latest").count() == 0
    with pytest.raises(ValueError):
        M.resolve_artifact(registry, "t/p/m")


def test_elapsed(spark):
    log = spark.sql("SELECT 1L run, TIMESTAMP'2024-01-01 00:00:00' ts UNION ALL SELECT 1L, TIMESTAMP'2024-01-01 00:00:01.5'")
    assert M.run_elapsed(log).first()["elapsed_us"] == 1_500_000


def test_metric_windows_take_one_exchange(spark, capsys):
    log = spark.range(100).selectExpr("id % 3 AS run", "id div 3 + 1 AS step", "id * 0.5D AS value")
    M.metric_windows(log).explain()
    assert capsys.readouterr().out.count("Exchange") == 1
