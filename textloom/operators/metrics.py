"""Losses, metric logs, checkpoints and the artifact registry as tables.

A log is (run, step, value) or, with several metrics, (run, step, metric,
value, seq). One run may hold a large share of all rows, so nothing here
windows over a whole run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.numbers import int_div
from textloom.functions.scores import as_scores, cross_entropy
from textloom.plans.ordering import first_k, rank_within
from textloom.plans.storage import materialise

# Steps per log entry, steps between validations, batches per validation.
LOG_INTERVAL = 10
VALIDATION_INTERVAL = 1000
EVAL_STEPS = 100


def position_losses(df: DataFrame, scores_col: str, target_col: str, pad_id: int | None = None) -> DataFrame:
    """``df`` with ``loss`` per position; rows whose target is ``pad_id`` are left out if given."""
    if pad_id is not None:
        df = df.where(F.col(target_col) != pad_id)
    return df.withColumn("loss", cross_entropy(as_scores(F.col(scores_col)), F.col(target_col)))


def mean_loss(losses: DataFrame, loss_col: str = "loss") -> DataFrame:
    """Mean over all rows, and the exponential of that mean."""
    return losses.agg(F.count("*").alias("n"), F.avg(loss_col).alias("loss")).withColumn(
        "perplexity", F.exp("loss")
    )


def first_logged(log: DataFrame, *by: str) -> DataFrame:
    """One entry per (run, step): of repeated ones the first by ``seq``, or the smallest value without it.

    ``by`` are columns to keep, the same for all entries of a step.
    """
    value = F.min_by("value", "seq") if "seq" in log.columns else F.min("value")
    return log.groupBy(*(by or ["run"]), "step").agg(value.alias("value"))


def metric_windows(log: DataFrame, interval: int = LOG_INTERVAL) -> DataFrame:
    """Mean loss and perplexity of every full window of ``interval`` steps, keyed
    at the closing step. An unfinished window gives no row; a step that was
    logged again counts once, see ``first_logged``."""
    # dealt by window once: repeated entries of a step and the steps of a window meet in the same task
    dealt = log.withColumn("_w", int_div(F.col("step") - 1, interval)).repartition("run", "_w")
    return (
        first_logged(dealt, "run", "_w")
        .groupBy("run", "_w")
        .agg(F.count("*").alias("_n"), F.avg("value").alias("train_loss"))
        .where(F.col("_n") == interval)
        .select(
            "run",
            ((F.col("_w") + 1) * interval).alias("step"),
            "train_loss",
            F.exp("train_loss").alias("train_perplexity"),
        )
    )


def every(log: DataFrame, interval: int = VALIDATION_INTERVAL) -> DataFrame:
    return log.where(F.col("step") % interval == 0)


def capped_eval(batch_losses: DataFrame, num_steps: int = EVAL_STEPS) -> DataFrame:
    """Mean loss of the first ``num_steps`` batches over the number there are."""
    return mean_loss(batch_losses.where(in_first_batches(batch_losses, num_steps)))


def in_first_batches(rows: DataFrame, num_steps: int = EVAL_STEPS) -> Column:
    """A predicate for the rows of the first ``num_steps`` batches; use it before scoring them."""
    return first_k(rows.select("batch_id").distinct(), [F.col("batch_id")], lambda n: num_steps)


def running_best(log: DataFrame) -> DataFrame:
    """``best``: the smallest value of the run up to and including the step.

    The log is range-partitioned by run and step and written sorted. The minimum
    inside a partition comes from a window over the run's part of it, that of
    earlier partitions from one row per run and partition, so the largest run
    spreads over as many tasks as its rows need.
    """
    sorted_log = log.repartitionByRange("run", "step").sortWithinPartitions("run", "step")
    placed = materialise(sorted_log.withColumn("_part", F.spark_partition_id()), "running-best")
    inside = Window.partitionBy("_part", "run").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("run").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        placed.groupBy("run", "_part")
        .agg(F.min("value").alias("_min"))
        .select("run", "_part", F.min("_min").over(before).alias("_earlier"))
    )
    return (
        placed.withColumn("_inside", F.min("value").over(inside))
        .join(earlier, ["run", "_part"])
        .withColumn("best", F.least("_inside", "_earlier"))
        .drop("_part", "_inside", "_earlier")
    )


def metric_history(log: DataFrame, metrics: list[str]) -> DataFrame:
    """One row per (run, step), one column per metric; of repeated values the last ``seq`` stays."""
    return log.groupBy("run", "step").pivot("metric", metrics).agg(F.max_by("value", "seq"))


def latest_checkpoint(checkpoints: DataFrame) -> DataFrame:
    """The checkpoint with the highest step of every run."""
    last = F.max_by(F.struct("step", "val_loss", "payload_ref"), F.col("step"))
    return checkpoints.groupBy("run").agg(last.alias("_last")).select("run", "_last.*")


def artifact_versions(uploads: DataFrame) -> DataFrame:
    """Uploads (name, created_step, path) with ``version`` 0, 1, ... per name."""
    ranked = rank_within(uploads, ["name"], ["created_step"], rank_col="_rank", carry=["path"])
    return ranked.select("name", (F.col("_rank") - 1).alias("version"), "path", "created_step")


def resolve_artifact(registry: DataFrame, reference: str) -> DataFrame:
    """The entry for ``entity/project/name:version``; the version is ``latest``, ``v3`` or ``3``."""
    name, _, version = reference.rpartition(":")
    if not name:
        raise ValueError(f"expected name:version, got '{reference}'")
    named = registry.where(F.col("name") == name)
    if version == "latest":
        newest = F.max_by(F.struct("version", "path", "created_step"), F.col("version"))
        return named.groupBy("name").agg(newest.alias("_v")).select("name", "_v.*")
    return named.where(F.col("version") == int(version.removeprefix("v")))


def resolve_upload(uploads: DataFrame, reference: str) -> DataFrame:
    """As ``resolve_artifact``, straight from the uploads: only those of the name are looked at.

    The latest version is found by counting; only an explicit number needs ranks.
    """
    name, _, version = reference.rpartition(":")
    if not name:
        raise ValueError(f"expected name:version, got '{reference}'")
    named = uploads.where(F.col("name") == name)
    if version != "latest":
        return resolve_artifact(artifact_versions(named), reference)
    last = F.max_by(F.struct("path", "created_step"), F.col("created_step"))
    found = named.groupBy("name").agg((F.count("*") - 1).alias("version"), last.alias("_v"))
    return found.select("name", "version", "_v.*")


def append_metrics(log: DataFrame, path: str) -> None:
    """Append entries (run, step, metric, value, seq) to the log table at ``path``."""
    log.select("run", "step", "metric", "value", "seq").write.mode("append").parquet(path)


def run_elapsed(log: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Microseconds between the first and the last entry of every run."""
    span = F.expr(f"timestampdiff(MICROSECOND, min({ts_col}), max({ts_col}))")
    return log.groupBy("run").agg(span.alias("elapsed_us"))
