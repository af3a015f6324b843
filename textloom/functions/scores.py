"""Decoding of score arrays (one score per candidate id) inside a row.

A row already holds all scores of one position, so scaling, filtering,
normalising and picking need neither a window nor a shuffle.

A lambda body is evaluated for every element, so a value of the whole row (a
cut, a peak, a total) is never written into one: it goes in as a second array,
built once per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_scores(values: Column) -> Column:
    return values.cast("array<double>")


def _with_row_value(values: Column, row_value: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """``combine(element, row_value)`` for every element."""
    return F.zip_with(values, F.array_repeat(row_value, F.size(values)), combine)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def scale(scores: Column, temperature: float) -> Column:
    return F.transform(scores, lambda z: z / F.lit(float(temperature)))


def kth_largest(scores: Column, k: int) -> Column:
    descending = F.sort_array(scores, asc=False)
    return F.element_at(descending, F.least(F.lit(k), F.size(scores)))


def top_k_mask(scores: Column, k: int) -> Column:
    """Scores below the k-th largest become null; ties with it stay. ``k <= 0`` keeps all."""
    if k <= 0:
        return scores
    return _with_row_value(scores, kth_largest(scores, k), lambda z, cut: F.when(z >= cut, z))


def softmax(masked: Column) -> Column:
    """Probabilities over the non-null scores; null scores get 0."""
    weights = _with_row_value(
        masked, F.array_max(masked), lambda z, peak: F.coalesce(F.exp(z - peak), F.lit(0.0))
    )
    return _with_row_value(weights, _total(weights), lambda w, total: w / total)


def pick(probabilities: Column, uniform: Column) -> Column:
    """The first 0-based position whose cumulative probability exceeds ``uniform``.

    Cumulative sums are rounded to 12 places; if rounding leaves the total at or
    below ``uniform``, the last position with a positive probability is taken.
    """
    start = F.struct(
        uniform.alias("u"),
        F.lit(0.0).alias("total"),
        F.lit(0).alias("place"),
        F.lit(-1).alias("hit"),
        F.lit(-1).alias("last"),
    )

    def step(acc: Column, p: Column) -> Column:
        total = acc["total"] + p
        found = (acc["hit"] < 0) & (p > 0) & (F.round(total, 12) > acc["u"])
        return F.struct(
            acc["u"].alias("u"),
            total.alias("total"),
            (acc["place"] + 1).alias("place"),
            F.when(found, acc["place"]).otherwise(acc["hit"]).alias("hit"),
            F.when(p > 0, acc["place"]).otherwise(acc["last"]).alias("last"),
        )

    return F.aggregate(
        probabilities, start, step, lambda acc: F.when(acc["hit"] >= 0, acc["hit"]).otherwise(acc["last"])
    )


def greedy(scores: Column) -> Column:
    """0-based position of the largest score, the lowest position on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def cross_entropy(scores: Column, target: Column) -> Column:
    """log-sum-exp of the scores minus the score of the 0-based target."""
    peak = F.array_max(scores)
    total = _total(_with_row_value(scores, peak, lambda z, m: F.exp(z - m)))
    return peak + F.log(total) - F.get(scores, target)
