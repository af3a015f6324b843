"""Exact ordering without pulling a table through one task.

* ``first_k``      - exactly the k smallest rows, as a narrow filter
* ``row_ids``      - dense 0-based positions over a unique key
* ``rank_within``  - 1-based positions inside groups of any size
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.plans.lookup import lookup_join
from textloom.plans.storage import materialise

# A level of the search groups values into at most this many counters ...
FANOUT = 65_536
# ... and a range holding no more rows than this is read directly.
LEAF_ROWS = 4_096

HASH_BITS = 60


def order_hash(seed: int | str, *keys: str) -> Column:
    """md5 of ``seed:key[:key]``: a repeatable shuffle order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def hash_prefix(md5: Column) -> Column:
    """The leading 60 bits of an md5 string; sorts the same way as the string."""
    return F.conv(F.substring(md5, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def unit_hash(seed: int | str, *keys: Column | str) -> Column:
    """A repeatable number in [0, 1) from the first 8 hex digits of an md5."""
    parts = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))


def _slots(values: DataFrame, lo: int, hi: int) -> tuple[int, list[tuple[int, int]]]:
    """Width and (slot, rows) counts of at most FANOUT equal sub-ranges of [lo, hi]."""
    width = max(1, -(-(hi - lo + 1) // FANOUT))
    slot = F.call_function("div", F.col("v") - F.lit(lo), F.lit(width))
    counts = values.where(F.col("v").between(lo, hi)).groupBy(slot.alias("slot")).count().collect()
    return width, sorted((r["slot"], r["count"]) for r in counts)


def first_k(
    df: DataFrame,
    order: list[Column],
    size: Callable[[int], int],
    prefix: Column | None = None,
    bounds: tuple[int, int] | None = None,
) -> Column:
    """A predicate that holds for exactly the first ``size(n)`` of the n rows of ``df``.

    ``order`` identifies and sorts the rows. ``prefix`` is a bigint within
    ``bounds`` that sorts them the same way, with few rows per value; by default
    the only order column. The executors count prefixes per sub-range, and the
    search descends into the sub-range that holds the last row wanted, until so
    few rows are left that they can be read. The predicate compares with
    literals, so using it needs no shuffle.
    """
    if prefix is None:
        (prefix,) = order
    prefix = prefix.cast("bigint")
    values = df.select(prefix.alias("v"))
    lo, hi = bounds or values.agg(F.min("v"), F.max("v")).first()
    if lo is None:
        return F.lit(False)
    k = below = n = None
    while k is None or (n > LEAF_ROWS and lo < hi):
        width, slots = _slots(values, lo, hi)
        if k is None:
            total, below = sum(n for _, n in slots), 0
            k = size(total)
            if k <= 0 or k >= total:
                return F.lit(k > 0)
        for slot, n in slots:
            if below + n >= k:
                lo, hi = lo + slot * width, min(hi, lo + (slot + 1) * width - 1)
                break
            below += n
    near = df.where(prefix.between(lo, hi)).select(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    rows = near.limit(LEAF_ROWS + 1).collect()
    if len(rows) > LEAF_ROWS:
        raise ValueError("order values repeat too often; give an order that identifies rows")
    last = sorted(tuple(r) for r in rows)[k - below - 1]
    limits = [F.lit(x).cast(near.schema[i].dataType) for i, x in enumerate(last)]
    if len(order) == 1:
        return order[0] <= limits[0]
    left, right = (F.struct(*[c.alias(f"o{i}") for i, c in enumerate(side)]) for side in (order, limits))
    return left <= right


def row_ids(df: DataFrame, *keys: str, id_col: str = "row_id", carry: Sequence[str] = ()) -> DataFrame:
    """``keys`` and ``carry`` columns plus a dense 0-based ``row_id`` in key order.

    Only these columns are shuffled. They are range-partitioned, sorted and
    written with their place inside the partition, so the counts and the final
    ids come from the same frozen layout even if a task has to be repeated.
    Wide columns are usually cheaper to join by key than to carry.
    """
    placed = materialise(
        df.select(*keys, *carry)
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id()),
        "row-ids",
    )
    part = F.shiftright("_place", 33)
    sizes = sorted((r["part"], r["count"]) for r in placed.groupBy(part.alias("part")).count().collect())
    starts, total = [], 0
    for p, n in sizes:
        starts.append((p, total))
        total += n
    # one row per range partition
    offsets = df.sparkSession.createDataFrame(starts or [(0, 0)], "_part bigint, _start bigint")
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*keys, *carry, (F.col("_start") + F.expr("_place & 8589934591L")).alias(id_col))
    )


def running_total(df: DataFrame, order: list[str], value: str, carry: Sequence[str] = ()) -> DataFrame:
    """``order`` and ``carry`` columns plus ``_before``: the sum of ``value`` over all earlier rows.

    Rows are range-partitioned and written sorted; sums inside a partition come
    from a window over it, those of earlier partitions from one row each.
    """
    columns = dict.fromkeys([*order, value, *carry])
    sorted_rows = df.select(*columns).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialise(sorted_rows.withColumn("_place", F.monotonically_increasing_id()), "running-total")
    part = F.shiftright("_place", 33)
    sums = sorted((r[0], r[1]) for r in placed.groupBy(part).agg(F.sum(value)).collect())
    starts, total = [], 0
    for p, n in sums:
        starts.append((p, total))
        total += n
    offsets = df.sparkSession.createDataFrame(starts or [(0, 0)], "_part bigint, _start bigint")
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("_part", part).withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return local.join(F.broadcast(offsets), "_part").select(
        *order, *carry, (F.col("_start") + F.col("_local")).alias("_before")
    )


def with_row_id(df: DataFrame, *keys: str, id_col: str = "row_id") -> DataFrame:
    """``df`` with a dense id; ``keys`` must be unique and not null."""
    return df.join(row_ids(df, *keys, id_col=id_col), list(keys))


def rank_within(
    df: DataFrame, group: list[str], order: list[str], rank_col: str = "step", carry: Sequence[str] = ()
) -> DataFrame:
    """``group``, ``order`` and ``carry`` columns plus a 1-based rank inside each group.

    A window partitioned by group would sort a hot group in one task. Here the
    global position is taken first, and the first position of the row's group
    is subtracted from it.
    """
    ids = row_ids(df, *group, *order, id_col="_pos", carry=carry)
    starts = materialise(ids.groupBy(*group).agg(F.min("_pos").alias("_first")), "group-starts")
    return lookup_join(ids, starts, group, salt_by=["_pos"]).select(
        *group, *order, *carry, (F.col("_pos") - F.col("_first") + 1).alias(rank_col)
    )


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
