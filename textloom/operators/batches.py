"""Order of an epoch, batches of consecutive rows, step plan, padding cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.functions import arrays
from textloom.functions.numbers import int_div
from textloom.operators.bpe import PAD
from textloom.operators.split import DEFAULT_SEED
from textloom.plans.ordering import order_hash, row_ids

# Rows per batch, steps of a run.
BATCH_SIZE = 32
MAX_STEPS = 10_000


def epoch_positions(df: DataFrame, keys: list[str], epoch: int, seed: int = DEFAULT_SEED) -> DataFrame:
    """(keys, pos): the place of every row in the shuffled order of an epoch."""
    hashed = df.select(order_hash(f"{seed}:{epoch}", *keys).alias("_order"), *keys)
    return row_ids(hashed, "_order", *keys, id_col="pos").drop("_order")


def sequential_positions(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pos): the place of every row in key order."""
    return row_ids(df, *keys, id_col="pos")


def batch_of(pos: Column, batch_size: int = BATCH_SIZE) -> Column:
    return int_div(pos, batch_size)


def assemble(positioned: DataFrame, columns: list[str], batch_size: int = BATCH_SIZE) -> DataFrame:
    """One row per batch: its size, and an array per column in position order.

    A group never exceeds ``batch_size`` rows; the last batch may be short.
    """
    rows = F.array_sort(F.collect_list(F.struct("pos", *columns)))
    grouped = positioned.groupBy(batch_of(F.col("pos"), batch_size).alias("batch_id")).agg(rows.alias("_rows"))
    return grouped.select(
        "batch_id", F.size("_rows").alias("n_rows"), *[F.col(f"_rows.{c}").alias(c) for c in columns]
    )


def pad_to_longest(
    rows: DataFrame, positions: DataFrame, keys: list[str], ids_col: str = "ids", batch_size: int = BATCH_SIZE
) -> DataFrame:
    """``rows`` (keys, ids) with ``input_ids`` and ``attention_mask`` as long as the longest row of the batch.

    Only sizes meet ``positions`` (keys, pos) and their batch; the ids are
    joined once, to one number each. ``rows`` is read twice: give a table.
    """
    batch = Window.partitionBy("batch_id")  # at most batch_size rows
    sizes = rows.select(*keys, F.size(ids_col).alias("_size")).join(positions, keys)
    longest = sizes.withColumn("batch_id", batch_of(F.col("pos"), batch_size)).select(
        *keys, "pos", "batch_id", F.max("_size").over(batch).alias("_longest")
    )
    ids = F.col(ids_col)
    return (
        rows.join(longest, keys)
        .withColumn("input_ids", arrays.pad_right(ids, F.col("_longest"), PAD))
        .withColumn("attention_mask", arrays.attention_mask(ids, F.col("_longest")))
        .drop("_longest")
    )


def n_batches(n_rows: int, batch_size: int = BATCH_SIZE) -> int:
    return -(-n_rows // batch_size)


def step_plan(spark: SparkSession, batches_per_epoch: int, max_steps: int = MAX_STEPS) -> DataFrame:
    """(step, epoch, batch_id): epochs repeat until ``max_steps``."""
    if batches_per_epoch <= 0:
        raise ValueError("no batches to plan")
    done = F.col("id")
    return spark.range(max_steps).select(
        (done + 1).alias("step"),
        int_div(done, batches_per_epoch).alias("epoch"),
        (done % batches_per_epoch).alias("batch_id"),
    )


def padding_waste(
    rows: DataFrame,
    positions: DataFrame,
    keys: list[str],
    max_length: int,
    ids_col: str = "ids",
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """Share of padding per batch, padded to ``max_length`` and to the longest row.

    The sizes of ``rows`` (keys, ids) are taken before they meet ``positions``
    (keys, pos), so no ids are shuffled.
    """
    kept = F.least(F.size(ids_col), F.lit(max_length)).cast("bigint")
    sized = rows.select(*keys, kept.alias("n")).join(positions, keys).select(
        batch_of(F.col("pos"), batch_size).alias("batch_id"), "n"
    )
    return (
        sized.groupBy("batch_id")
        .agg(F.count("*").alias("n_rows"), F.sum("n").alias("n_real"), F.max("n").alias("longest"))
        .select(
            "batch_id",
            "n_rows",
            "n_real",
            (1 - F.col("n_real") / (F.col("n_rows") * max_length)).alias("waste_fixed"),
            F.when(F.col("longest") > 0, 1 - F.col("n_real") / (F.col("n_rows") * F.col("longest")))
            .otherwise(F.lit(0.0))
            .alias("waste_dynamic"),
        )
    )
