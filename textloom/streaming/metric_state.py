"""Running best and metric history over unbounded logs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Steps of one run that share an entry of the state.
BLOCK = 4096


@contextmanager
def typed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, as typed state requires."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


class _RunningBest(StatefulProcessor):
    """Per run: the next place to be emitted, the best before it, and what arrived beyond it by block of places."""

    def __init__(self, first: int, every: int, idle_ms: int | None):
        self.first, self.every, self.idle_ms = first, every, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.reached = handle.getValueState("reached", "next bigint, best double")
        self.held = handle.getMapState("held", "block bigint", "places array<bigint>, values array<double>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for chunk in rows:
            places = np.concatenate([np.asarray(p, np.int64) for p in chunk["places"]])
            values = np.concatenate([np.asarray(v, float) for v in chunk["values"]])
            self._hold(places, values)
            yield from self._drain(key)
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if any(True for _ in self.held.keys()):
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for (block,) in sorted(self.held.keys()):
            places, values = (np.array(x) for x in self.held.getValue((block,)))
            self.held.removeKey((block,))
            yield self._emit(key, places, values.astype(float))

    def close(self) -> None:
        pass

    def _next(self) -> tuple[int, float]:
        if not self.reached.exists():
            return 0, np.nan
        place, best = self.reached.get()
        return place, np.nan if best is None else best

    def _hold(self, places: np.ndarray, values: np.ndarray) -> None:
        late = places < self._next()[0]
        places, values = places[~late], values[~late]
        for block in np.unique(places // BLOCK).tolist():
            here = places // BLOCK == block
            was = self.held.getValue((block,)) if self.held.containsKey((block,)) else ([], [])
            # earlier arrivals stand before later ones, equal arrivals by value
            order = np.lexsort((values[here], places[here]))
            all_places = np.concatenate([np.array(was[0], np.int64), places[here][order]])
            all_values = np.concatenate([np.array(was[1], float), values[here][order]])
            kept, at = np.unique(all_places, return_index=True)
            self.held.updateValue((block,), (kept.tolist(), _nullable(all_values[at])))

    def _drain(self, key) -> Iterator[pd.DataFrame]:
        """What follows the last emitted place without a gap."""
        while True:
            block = self._next()[0] // BLOCK
            if not self.held.containsKey((block,)):
                return
            places, values = self.held.getValue((block,))
            places, values = np.array(places), np.array(values, float)
            ready = int((places == self._next()[0] + np.arange(len(places))).sum())
            if ready < len(places):
                self.held.updateValue((block,), (places[ready:].tolist(), _nullable(values[ready:])))
            else:
                self.held.removeKey((block,))
            if ready:
                yield self._emit(key, places[:ready], values[:ready])
            if ready < len(places) or self._next()[0] // BLOCK == block:
                return

    def _emit(self, key, places: np.ndarray, values: np.ndarray) -> pd.DataFrame:
        best = np.fmin(np.fmin.accumulate(values), self._next()[1])
        last = None if np.isnan(best[-1]) else float(best[-1])
        self.reached.update((int(places[-1]) + 1, last))
        steps = self.first + places * self.every
        return pd.DataFrame({"run": [key[0]] * len(places), "step": steps, "value": values, "best": best})


def _nullable(values: np.ndarray) -> list[float | None]:
    return [None if np.isnan(v) else v for v in values.tolist()]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per run of a batch."""
    for batch in batches:
        lists = pa.Table.from_batches([batch]).group_by("run").aggregate([("place", "list"), ("value", "list")])
        columns = {"run": "run", "place_list": "places", "value_list": "values"}
        packed = lists.select(list(columns)).rename_columns(list(columns.values()))
        yield from packed.to_batches()


def stream_running_best(log: DataFrame, first: int = 1, every: int = 1, idle_ms: int | None = None) -> DataFrame:
    """(run, step, value, best) of a streaming (run, step, value) log; start it inside ``typed_state``.

    Steps are ``first``, ``first + every`` and so on; a step off this grid, or
    null, fails the stream. Entries may arrive in any order: a step is emitted
    when all steps of its run before it have been. Of entries for one step the
    first to arrive counts, of those in one chunk the smallest. A null
    or NaN value is given as null and leaves the best as it was; a null run is a run.

    Each task packs its entries by run before the exchange, so a run with most of
    the log costs its task a row per packed batch. State is two numbers a run and
    the steps ahead of a gap. With ``idle_ms`` a gap is given up after that time
    without entries of the run: what is held is emitted, steps of the gap are
    dropped if they come later. That needs a trigger that goes on.
    """
    offset = F.col("step") - first
    on_grid = (offset >= 0) & (offset % every == 0)
    place = F.when(on_grid, F.expr(f"(step - {first}) div {every}")).otherwise(
        F.raise_error(F.concat(F.lit("step off the grid: "), F.coalesce(F.col("step").cast("string"), F.lit("null")))).cast("bigint")
    )
    run_type = log.schema["run"].dataType.simpleString()
    placed = log.select("run", place.alias("place"), F.col("value").cast("double").alias("value"))
    packed = placed.mapInArrow(_pack, f"run {run_type}, places array<bigint>, values array<double>")
    return packed.groupBy("run").transformWithStateInPandas(
        _RunningBest(first, every, idle_ms),
        f"run {run_type}, step bigint, value double, best double",
        "append",
        "None" if idle_ms is None else "ProcessingTime",
    )


def stream_metric_history(log: DataFrame, metrics: list[str]) -> DataFrame:
    """The rows of ``metric_history`` that change, for a streaming log; an update-mode aggregation of the JVM.

    State is one row per (run, step), as any later entry may still change it.
    """

    def of(metric: str, column: str):
        return F.when(F.col("metric") == metric, F.col(column))

    return log.groupBy("run", "step").agg(*[F.max_by(of(m, "value"), of(m, "seq")).alias(m) for m in metrics])


def keep_history(history: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each batch of changed rows to a folder of its own, until the source has nothing more.

    A repeated batch rewrites its folder, so every change is there once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = (
        history.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def history_table(spark: SparkSession, path: str) -> DataFrame:
    """One row per (run, step) of what ``keep_history`` wrote: that of the last batch."""
    changes = spark.read.parquet(path)
    newest = Window.partitionBy("run", "step").orderBy(F.desc("batch"))
    return changes.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n", "batch")
