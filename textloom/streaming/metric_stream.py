"""Metric windows and latest checkpoints over unbounded logs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from textloom.functions.numbers import int_div
from textloom.operators.metrics import LOG_INTERVAL, latest_checkpoint

_OUTPUT = "step bigint, train_loss double, train_perplexity double"
_STATE = "steps array<bigint>, losses array<double>, seqs array<bigint>"

# Windows of one run that share a state entry: bounds both the state and the
# rows handed to one call.
WINDOWS_PER_KEY = 64


def stream_metric_windows(
    log: DataFrame,
    interval: int = LOG_INTERVAL,
    windows_per_key: int = WINDOWS_PER_KEY,
    idle_ms: int | None = None,
) -> DataFrame:
    """Full windows of a streaming (run, step, value[, seq]) log, emitted once complete.

    A run may be of any type. Of entries for one step the first counts: the
    smallest ``seq``, or the smallest value where there is no such column.
    A window whose steps are all logged once more is emitted once more.
    With ``idle_ms`` the unfinished windows of a block are given up after that
    time without entries; without it they are kept for as long as the stream runs.
    Such a timeout needs a trigger that goes on: one that stops when the source
    is empty (available now) would wait for it for ever.

    State is kept per (run, block of windows): the values of the block's
    unfinished windows, nothing once they are all emitted. Entries may arrive in
    any order, and a long run spreads over as many tasks as it has blocks.
    """

    def collect_windows(
        key: tuple[int, int], chunks: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = state.get if state.exists else ([], [], [])
        parts = [(c["step"].to_numpy(), c["value"].to_numpy(), c["seq"].to_numpy()) for c in chunks]
        kinds = (np.int64, float, np.int64)
        steps, losses, seqs = (np.concatenate([np.array(h, k), *(p[i] for p in parts)]) for i, (h, k) in enumerate(zip(held, kinds)))
        order = np.lexsort((losses, seqs, steps))
        steps, losses, seqs = steps[order], losses[order], seqs[order]
        steps, kept = np.unique(steps, return_index=True)
        losses, seqs = losses[kept], seqs[kept]
        windows, place, sizes = np.unique((steps - 1) // interval, return_inverse=True, return_counts=True)
        full = sizes == interval
        rest = ~full[place]
        if rest.any():
            state.update((steps[rest].tolist(), losses[rest].tolist(), seqs[rest].tolist()))
            if idle_ms is not None:
                state.setTimeoutDuration(idle_ms)
        elif state.exists:
            state.remove()
        if full.any():
            loss = np.bincount(place, losses)[full] / interval
            yield pd.DataFrame(
                {
                    "run": key[0],
                    "step": (windows[full] + 1) * interval,
                    "train_loss": loss,
                    "train_perplexity": np.exp(loss),
                }
            )

    block = int_div(F.col("step") - 1, interval * windows_per_key)
    seq = F.col("seq") if "seq" in log.columns else F.lit(0)
    run_type = log.schema["run"].dataType.simpleString()
    timeout = GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return (
        log.select("run", "step", "value", seq.cast("bigint").alias("seq"), block.alias("block"))
        .groupBy("run", "block")
        .applyInPandasWithState(collect_windows, f"run {run_type}, {_OUTPUT}", _STATE, "append", timeout)
    )


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a Parquet table until the source has nothing more."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return query


def _turn(path: str, batch_id: int) -> str:
    return f"{path}/turn={batch_id % 2}"


def latest_table(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """The checkpoints that ``keep_latest_checkpoint`` left after a batch."""
    return spark.read.parquet(_turn(path, batch_id))


def keep_latest_checkpoint(checkpoints: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The latest checkpoint per run, rewritten after every micro-batch.

    Two folders take turns: a batch is merged with the table of the batch before
    it into the other folder, so a repeated batch rewrites its own folder and
    never the one it reads from, and storage stays at two tables.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        merged = batch
        if batch_id > 0:
            merged = batch.unionByName(latest_table(batch.sparkSession, path, batch_id - 1))
        latest_checkpoint(merged).write.mode("overwrite").parquet(_turn(path, batch_id))

    query = (
        checkpoints.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
