"""Losses, metric logs, checkpoints, artifacts.

``events`` stands in for a log: a user is a run, the rank of an event in time
its step, a hundredth of its value the loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import metrics as M
from textloom.plans.ordering import rank_within
from textloom.plans.storage import scratch_path
from textloom.queries.common import rounded, table
from textloom.streaming.metric_state import history_table, keep_history, stream_metric_history, stream_running_best, typed_state
from textloom.streaming.metric_stream import keep_latest_checkpoint, latest_table, run_to_table, stream_metric_windows

EVERY = 10
EVENT_METRICS = ["click", "error", "purchase", "signup", "view"]


def _events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("run"), *columns)


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir, "ts", (F.col("value") / 100).alias("value"))
    return rank_within(events, ["run"], ["ts"], carry=["value"]).select("run", "step", "value")


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.position_losses(table(spark, sf_dir, "embeddings"), "embedding", "label")


def cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _positions(spark, sf_dir).select("vec_id", rounded("loss"))


def perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.mean_loss(_positions(spark, sf_dir)).select("n", rounded("loss"), rounded("perplexity"))


def _windows(df: DataFrame) -> DataFrame:
    return df.select("run", "step", rounded("train_loss"), rounded("train_perplexity"))


def metric_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(M.metric_windows(_log(spark, sf_dir)))


def metric_window_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log as files, read as a stream of several micro-batches."""
    source, sink = scratch_path(spark, "log"), scratch_path(spark, "windows")
    log = _log(spark, sf_dir)
    log.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(source)
    run_to_table(stream_metric_windows(stream), sink, scratch_path(spark, "stream"))
    return _windows(spark.read.parquet(sink))


def validation_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.every(_log(spark, sf_dir), EVERY).select("run", "step", rounded("value"))


def capped_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 32 scored rows by id; the mean is over the first ten of them."""
    rows = table(spark, sf_dir, "embeddings").withColumn("batch_id", F.floor(F.col("vec_id") / 32))
    first = rows.where(M.in_first_batches(rows, 10))
    losses = M.position_losses(first, "embedding", "label")
    per_batch = losses.groupBy("batch_id").agg(F.avg("loss").alias("loss"))
    return M.capped_eval(per_batch, 10).select("n", rounded("loss"), rounded("perplexity"))


def running_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.running_best(_log(spark, sf_dir)).select("run", "step", rounded("value"), rounded("best"))


def running_best_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log as files in no order, read as a stream of two micro-batches."""
    source, sink = scratch_path(spark, "log"), scratch_path(spark, "best")
    log = _log(spark, sf_dir)
    log.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(source)
    with typed_state(spark):
        run_to_table(stream_running_best(stream), sink, scratch_path(spark, "stream"))
    return spark.read.parquet(sink).select("run", "step", rounded("value"), rounded("best"))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The step is the day; the last value of a kind on a day stays."""
    day = F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return _events(spark, sf_dir, day.alias("step"), F.col("event_type").alias("metric"), "value", F.col("event_id").alias("seq"))


def metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.metric_history(_daily(spark, sf_dir), EVENT_METRICS)


def metric_history_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, sink = scratch_path(spark, "log"), scratch_path(spark, "history")
    log = _daily(spark, sf_dir)
    log.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(source)
    keep_history(stream_metric_history(stream, EVENT_METRICS), sink, scratch_path(spark, "stream"))
    return history_table(spark, sink)


def _checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(
        spark,
        sf_dir,
        F.col("event_id").alias("step"),
        (F.col("value") / 100).alias("val_loss"),
        F.col("props").alias("payload_ref"),
    )


def latest_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.latest_checkpoint(_checkpoints(spark, sf_dir)).select("run", "step", rounded("val_loss"), "payload_ref")


def latest_checkpoint_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, sink = scratch_path(spark, "checkpoints"), scratch_path(spark, "latest")
    rows = _checkpoints(spark, sf_dir)
    rows.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = keep_latest_checkpoint(stream, sink, scratch_path(spark, "stream"))
    return latest_table(spark, sink, query.lastProgress["batchId"]).select("run", "step", rounded("val_loss"), "payload_ref")


def _uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("team/corpus/"), F.col("event_type")).alias("name"),
        F.col("event_id").alias("created_step"),
        F.col("props").alias("path"),
    )


def artifact_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.artifact_versions(_uploads(spark, sf_dir))


def artifact_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = M.resolve_upload(_uploads(spark, sf_dir), "team/corpus/click:latest")
    named = M.resolve_upload(_uploads(spark, sf_dir), "team/corpus/error:v7")
    return latest.unionByName(named)


def run_elapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.run_elapsed(_events(spark, sf_dir, "ts"))


QUERIES = {
    "cross_entropy": cross_entropy,
    "perplexity": perplexity,
    "metric_window": metric_window,
    "metric_window_stream": metric_window_stream,
    "validation_steps": validation_steps,
    "capped_eval": capped_eval,
    "running_best": running_best,
    "running_best_stream": running_best_stream,
    "metric_history": metric_history,
    "metric_history_stream": metric_history_stream,
    "latest_checkpoint": latest_checkpoint,
    "latest_checkpoint_stream": latest_checkpoint_stream,
    "artifact_versions": artifact_versions,
    "artifact_resolve": artifact_resolve,
    "run_elapsed": run_elapsed,
}

_LOG = """log AS (
  SELECT user_id AS run, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS step, value / 100 AS value FROM events)"""
_LOSSES = """z AS (SELECT vec_id, label, embedding::DOUBLE[] AS z FROM embeddings),
losses AS (
  SELECT vec_id, list_max(z) + ln(list_sum(list_transform(z, lambda x: exp(x - list_max(z))))) - z[label + 1] AS loss
  FROM z)"""
_WINDOW = f"""WITH {_LOG}
SELECT run, (w + 1) * 10 AS step, round(avg(value), 6) AS train_loss, round(exp(avg(value)), 6) AS train_perplexity
FROM (SELECT *, (step - 1) // 10 AS w FROM log) GROUP BY run, w HAVING count(*) = 10"""
_BEST = f"""WITH {_LOG}
SELECT run, step, round(value, 6) AS value, round(min(value) OVER (PARTITION BY run ORDER BY step), 6) AS best FROM log"""
_HISTORY = (
    "SELECT user_id AS run, date_diff('day', DATE '1970-01-01', ts::DATE) AS step, "
    + ", ".join(f"max_by(value, event_id) FILTER (event_type = '{m}') AS \"{m}\"" for m in EVENT_METRICS)
    + " FROM events GROUP BY 1, 2"
)
_LATEST = """SELECT user_id AS run, max(event_id) AS step, round(max_by(value / 100, event_id), 6) AS val_loss,
  max_by(props, event_id) AS payload_ref FROM events GROUP BY user_id"""
_VERSIONS = """versions AS (
  SELECT 'team/corpus/' || event_type AS name, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS version,
         props AS path, event_id AS created_step FROM events)"""

SQL = {
    "cross_entropy": f"WITH {_LOSSES} SELECT vec_id, round(loss, 6) AS loss FROM losses",
    "perplexity": f"""WITH {_LOSSES}
SELECT count(*) AS n, round(avg(loss), 6) AS loss, round(exp(avg(loss)), 6) AS perplexity FROM losses""",
    "metric_window": _WINDOW,
    "metric_window_stream": _WINDOW,
    "validation_steps": f"WITH {_LOG} SELECT run, step, round(value, 6) AS value FROM log WHERE step % {EVERY} = 0",
    "capped_eval": f"""WITH {_LOSSES}
SELECT count(*) AS n, round(avg(loss), 6) AS loss, round(exp(avg(loss)), 6) AS perplexity
FROM (SELECT vec_id // 32 AS batch_id, avg(loss) AS loss FROM losses GROUP BY 1 ORDER BY 1 LIMIT 10)""",
    "running_best": _BEST,
    "running_best_stream": _BEST,
    "metric_history": _HISTORY,
    "metric_history_stream": _HISTORY,
    "latest_checkpoint": _LATEST,
    "latest_checkpoint_stream": _LATEST,
    "artifact_versions": f"WITH {_VERSIONS} SELECT name, version, path, created_step FROM versions",
    "artifact_resolve": f"""WITH {_VERSIONS}
SELECT name, version, path, created_step FROM versions
WHERE (name = 'team/corpus/click' AND version = (SELECT max(version) FROM versions WHERE name = 'team/corpus/click'))
   OR (name = 'team/corpus/error' AND version = 7)""",
    "run_elapsed": """SELECT user_id AS run, date_diff('microsecond', min(ts), max(ts)) AS elapsed_us
FROM events GROUP BY user_id""",
}
