"""Small pieces shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.plans.layout import bounded_batches  # noqa: F401  (used from here by the operators)
from textloom.plans.storage import materialise

# ASCII white space, as in the word pattern [^\x20\x09-\x0D]+
SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer form of it that no column of ``df`` has (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(df: DataFrame, made: Sequence[str]) -> list[str]:
    """Columns of ``df`` that clash with none of the result columns ``made``."""
    clash = {c.lower() for c in made}
    return [c for c in df.columns if c.lower() not in clash]


def placed(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, written once, with its place.

    ``_part`` is the range partition, ``_place`` ascends with the order inside
    it. ``order`` must tell rows apart, or equal rows must be interchangeable; a
    hot leading key is then spread over as many ranges as its rows need.
    """
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    written = materialise(sorted_rows.withColumn("_id", F.monotonically_increasing_id()), label)
    return written.withColumns(
        {"_part": F.shiftright("_id", 33), "_place": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}
    ).drop("_id")


def rank_from(rows: DataFrame, within: Sequence[str], rank_col: str) -> DataFrame:
    """Dense 0-based rank of ``placed`` rows inside ``within``, the leading order columns.

    Only one row per (partition, group) is shuffled: its row count and first
    place, summed up over the partitions before it.
    """
    parts = rows.groupBy("_part", *within).agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    if within:
        before = F.sum("_n").over(_earlier(within))
        keys = ["_part", *within]
    else:
        # one row per partition: a list inside one row, no window over all rows
        lists = parts.agg(F.array_sort(F.collect_list(F.struct("_part", "_n", "_first"))).alias("_l"))
        sums = lists.select(
            F.posexplode("_l").alias("_i", "_e"), F.col("_l")
        ).select(
            F.col("_e._part").alias("_part"),
            F.col("_e._first").alias("_first"),
            F.aggregate(F.slice("_l", 1, F.col("_i")), F.lit(0).cast("long"), lambda a, x: a + x["_n"]).alias("_before"),
        )
        joined = rows.join(sums, "_part")
        return joined.withColumn(rank_col, F.col("_before") + F.col("_place") - F.col("_first")).drop(
            "_part", "_place", "_before", "_first"
        )
    offsets = parts.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_n")
    # null groups must meet their own offset, so the join compares null-safely
    renamed = offsets.select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)], "_before", "_first")
    on = [F.col(k).eqNullSafe(F.col(f"_o{i}")) for i, k in enumerate(keys)]
    joined = rows.join(renamed, on)
    return joined.withColumn(rank_col, F.col("_before") + F.col("_place") - F.col("_first")).drop(
        "_part", "_place", "_before", "_first", *[f"_o{i}" for i in range(len(keys))]
    )


def running_sum(rows: DataFrame, within: Sequence[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the rows of ``placed`` before this one inside ``within``.

    Sums are taken per range partition, whose totals are then added up; no task
    sees more of a group than one partition holds.
    """
    keys = ["_part", *within]
    parts = rows.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    offsets = parts.withColumn("_before", F.coalesce(F.sum("_sum").over(_earlier(within)), F.lit(0)))
    renamed = offsets.select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)], "_before")
    inside = Window.partitionBy(*keys).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = local.join(renamed, [F.col(k).eqNullSafe(F.col(f"_o{i}")) for i, k in enumerate(keys)])
    return joined.withColumn(out, F.col("_before") + F.col("_local")).drop(
        "_part", "_place", "_local", "_before", *[f"_o{i}" for i in range(len(keys))]
    )


def _earlier(within: Sequence[str]):
    return Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
