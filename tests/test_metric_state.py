"""Running best and metric history as streams, against the batch forms."""

import random
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from textloom.operators import metrics as M
from textloom.plans.storage import scratch_path
from textloom.streaming import metric_state
from textloom.streaming.metric_state import history_table, keep_history, stream_metric_history, stream_running_best, typed_state
from textloom.streaming.metric_stream import run_to_table


def batches(spark, rows, schema, files):
    """``rows`` as a stream of one file per micro-batch, in their order."""
    source = scratch_path(spark, "log")
    for i in range(files):
        part = rows[len(rows) * i // files : len(rows) * (i + 1) // files]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        time.sleep(0.02)  # files are taken by their time
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)


LOG = "run string, step long, value double"


def by_hand(rows):
    best, out = {}, []
    for run, step, value in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        known = [v for v in (best.get(run), value) if v is not None]
        best[run] = min(known, default=None)
        out.append((run, step, value, best[run]))
    return out


@pytest.mark.parametrize("block", [4, 4096])
def test_running_best_in_any_order(spark, monkeypatch, block):
    monkeypatch.setattr(metric_state, "BLOCK", block)
    rng = random.Random(4)
    rows = [("hot", s, float(rng.randrange(1000))) for s in range(1, 301)]
    rows += [("b", s, float(rng.randrange(9))) for s in range(1, 6)] + [(None, 1, 2.0), ("null", 1, None), ("null", 2, 1.0)]
    want = by_hand(rows)
    rng.shuffle(rows)
    sink = scratch_path(spark, "best")
    with typed_state(spark):
        run_to_table(stream_running_best(batches(spark, rows, LOG, 3)), sink, scratch_path(spark, "state"))
    got = [tuple(r) for r in spark.read.parquet(sink).select("run", "step", "value", "best").collect()]
    assert sorted(got, key=lambda r: (r[0] or "", r[1])) == want


def test_running_best_waits_for_gaps_and_takes_a_step_once(spark):
    rows = [("a", 10, 5.0), ("a", 30, 1.0), ("a", 10, 0.0), ("a", 50, 0.5), ("a", 20, 7.0), ("a", 10, -1.0)]
    sink = scratch_path(spark, "best")
    with typed_state(spark):
        run_to_table(stream_running_best(batches(spark, rows, LOG, 6), first=10, every=10), sink, scratch_path(spark, "state"))
    got = sorted(tuple(r) for r in spark.read.parquet(sink).select("run", "step", "value", "best").collect())
    assert got == [("a", 10, 5.0, 5.0), ("a", 20, 7.0, 5.0), ("a", 30, 1.0, 1.0)]
    with typed_state(spark), pytest.raises(StreamingQueryException, match="off the grid"):
        run_to_table(stream_running_best(batches(spark, [("a", 5, 1.0)], LOG, 1), first=10, every=10), scratch_path(spark, "best"), scratch_path(spark, "state"))


def test_running_best_gives_up_a_gap(spark):
    rows = [("a", 1, 3.0), ("a", 3, 2.0), ("a", 5, 4.0)]
    with typed_state(spark):
        best = stream_running_best(batches(spark, rows, LOG, 1), idle_ms=500)
        query = best.writeStream.format("memory").queryName("given_up").outputMode("append").trigger(processingTime="1 second").start()
    try:
        end = time.time() + 60
        while time.time() < end and spark.table("given_up").count() < 3:
            time.sleep(0.5)
        assert sorted(tuple(r) for r in spark.table("given_up").collect()) == [("a", 1, 3.0, 3.0), ("a", 3, 2.0, 2.0), ("a", 5, 4.0, 2.0)]
    finally:
        query.stop()


def test_metric_history_over_batches(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(3), rng.randrange(4), rng.choice("xyz"), float(i), i) for i in range(60)] + [(7, 1, "other", 1.0, 99)]
    rng.shuffle(rows)
    schema = "run long, step long, metric string, value double, seq long"
    path = scratch_path(spark, "history")
    keep_history(stream_metric_history(batches(spark, rows, schema, 2), ["x", "y"]), path, scratch_path(spark, "state"))
    got = history_table(spark, path).select("run", "step", "x", "y")
    want = M.metric_history(spark.createDataFrame(rows, schema), ["x", "y"])
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
