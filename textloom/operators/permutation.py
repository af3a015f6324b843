"""The order of an epoch as an expression: a keyed permutation of dense ids, both ways.

An id is split into two numbers, and rounds of hashing shift one by the other.
That permutes a few more numbers than there are rows; numbers beyond the last
row are sent through again until they fall on a row. No epoch needs a sort
or a shuffle, and the rows of any range of steps are computed from the step
numbers alone.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.numbers import int_div
from textloom.operators.batches import BATCH_SIZE, n_batches
from textloom.operators.split import DEFAULT_SEED

# Rounds, each of which shifts one of the two halves.
ROUNDS = 6
# Times that a number beyond the last row is sent through again. Three are practically never needed,
# and the expression fails rather than giving a wrong number.
AGAIN = 16
# Hexadecimal digits of an md5 used by a round.
DIGITS = 8


def sides(n: int) -> tuple[int, int]:
    """Two numbers whose product is the least multiple of the first that is at least ``n``."""
    first = max(1, isqrt(max(0, n - 1)) + 1)
    return first, max(1, -(-n // first))


def _once(value: Column, n: int, key: Column, inverse: bool) -> Column:
    """One pass of all rounds over numbers below the product of ``sides(n)``."""
    a, b = sides(n)
    state = F.struct(int_div(value, b).alias("l"), F.pmod(value, F.lit(b)).alias("r"))

    def round_(s: Column, k: Column) -> Column:
        left = k % 2 == 0
        other = F.when(left, s["r"]).otherwise(s["l"])
        digest = F.md5(F.concat_ws(":", key, k.cast("string"), other.cast("string")))
        by = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long") * (-1 if inverse else 1)
        return F.struct(
            F.when(left, F.pmod(s["l"] + by, F.lit(a))).otherwise(s["l"]).alias("l"),
            F.when(left, s["r"]).otherwise(F.pmod(s["r"] + by, F.lit(b))).alias("r"),
        )

    order = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
    return F.aggregate(F.array(*[F.lit(k) for k in order]), state, round_, lambda s: s["l"] * b + s["r"])


def permuted(value: Column, n: int, seed: int = DEFAULT_SEED, epoch: int | Column = 0, inverse: bool = False) -> Column:
    """The place of row ``value`` (0 to n - 1) in the order of an epoch, or with ``inverse`` the row at a place."""
    key = F.concat_ws(":", F.lit(str(seed)), (epoch if isinstance(epoch, Column) else F.lit(epoch)).cast("string"))
    a, b = sides(n)
    first = _once(value.cast("long"), n, key, inverse)
    again = min(AGAIN, a * b - n)
    if again == 0:
        return first
    walked = F.aggregate(
        F.array(*[F.lit(k) for k in range(again)]),
        first,
        lambda x, _: F.when(x >= n, _once(x, n, key, inverse)).otherwise(x),
    )
    return F.transform(
        F.array(walked), lambda x: F.when(x < n, x).otherwise(F.raise_error(F.lit("a number fell beyond the last row too often")))
    )[0]


def epoch_places(rows: DataFrame, n: int, epoch: int, seed: int = DEFAULT_SEED, id_col: str = "row_id") -> DataFrame:
    """``rows`` with ``pos``: their place in the order of an epoch. Narrow; ``row_id`` runs from 0 to n - 1."""
    return rows.withColumn("pos", permuted(F.col(id_col), n, seed, epoch))


def step_rows(
    spark: SparkSession, n: int, first_step: int, last_step: int, batch_size: int = BATCH_SIZE, seed: int = DEFAULT_SEED
) -> DataFrame:
    """(step, epoch, batch_id, pos, row_id) of the steps from ``first_step`` to ``last_step``, counted from 1.

    Every epoch has an order of its own and the last batch of an epoch may be
    short. Earlier steps are not planned: a run is resumed where it stopped.
    """
    if n <= 0:
        raise ValueError("no rows to plan")
    per_epoch = n_batches(n, batch_size)
    slot = F.col("id") - int_div(F.col("id"), batch_size) * batch_size
    slots = spark.range((first_step - 1) * batch_size, last_step * batch_size).select(
        (int_div(F.col("id"), batch_size) + 1).alias("step"), slot.alias("slot")
    )
    placed = slots.select(
        "step",
        int_div(F.col("step") - 1, per_epoch).alias("epoch"),
        ((F.col("step") - 1) % per_epoch).alias("batch_id"),
        (((F.col("step") - 1) % per_epoch) * batch_size + F.col("slot")).alias("pos"),
    ).where(F.col("pos") < n)
    return placed.withColumn("row_id", permuted(F.col("pos"), n, seed, F.col("epoch"), inverse=True))
