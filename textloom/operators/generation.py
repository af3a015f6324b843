"""Generation by tables of the vocabulary: jumps for greedy decoding, alias tables for sampling.

What follows an id depends on that id alone, so greedy decoding walks a
function on the vocabulary. Its powers of two are joined up on the vocabulary,
and prompts meet the finished walk of their last id once, however many steps it
has. Sampling looks into an alias table, whose columns all hold equally much: a
draw reads one column instead of adding up probabilities.
"""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.bpe import UNK
from textloom.operators.split import DEFAULT_SEED
from textloom.plans.lookup import fits_broadcast, lookup_join
from textloom.plans.storage import discard, materialise

# Steps of a sampled generation between two writes of the prompt table.
STEPS_PER_WRITE = 16
# Hexadecimal digits of an md5 that make a number below one: exact in a double.
UNIT_DIGITS = 13


def walks(following: DataFrame, steps: int) -> DataFrame:
    """(input_id, path): the ``steps`` ids that follow each id, one after another.

    ``following`` has (input_id, next_id), unique on ``input_id``. An id that
    nothing is known to follow is followed by the unknown id. Every id of the table,
    the unknown id and -1, which stands for any other id, have a row. Each
    join doubles the walks, so there are as many as ``steps`` has binary digits.
    """
    if steps < 1:
        raise ValueError("a walk has at least one step")
    spark = following.sparkSession
    ids = following.select("input_id").union(following.select(F.col("next_id"))).union(
        spark.createDataFrame([(UNK,), (-1,)], "input_id int")
    )
    first = ids.distinct().join(following, "input_id", "left")
    now = materialise(first.select("input_id", F.array(F.coalesce("next_id", F.lit(UNK))).alias("path")), "walks")
    length = 1
    while length < steps:
        # both sides have a row per vocabulary entry
        ahead = now.select(F.col("input_id").alias("_at"), F.col("path").alias("_more"))
        longer = now.withColumn("_at", F.element_at("path", -1)).join(ahead, "_at")
        grown = materialise(longer.select("input_id", F.concat("path", "_more").alias("path")), "walks")
        discard(now)
        now, length = grown, 2 * length
    return now.withColumn("path", F.slice("path", 1, steps)) if length > steps else now


def generate_greedy(
    prompts: DataFrame, following: DataFrame, keys: list[str], steps: int, ids_col: str = "ids"
) -> DataFrame:
    """Prompts with ``new_ids``: the ``steps`` ids that follow their last id.

    The same as ``scoring.generate`` with one best successor and any context;
    prompts are joined once, to the walk of their last id.
    """
    paths = materialise(walks(following, steps), "walk-table")
    other = paths.where("input_id = -1").first()["path"]  # one walk
    table = paths.select(F.col("input_id").alias("_last"), F.col("path").alias("new_ids"))
    ready = prompts.withColumn("_last", F.try_element_at(ids_col, F.lit(-1)))
    joined = lookup_join(ready, table, ["_last"], salt_by=keys, how="left")
    return joined.withColumn("new_ids", F.coalesce("new_ids", F.array(*[F.lit(x) for x in other]))).drop("_last")


def alias_columns(weights: list[int]) -> tuple[list[int], list[int]]:
    """(cut, alias) of each column: of ``sum(weights)`` units the first ``cut`` are its own, the rest its alias's.

    Whole numbers, so every entry gets exactly its share. Columns with too
    little are filled in order from those with too much, in order.
    """
    n, total = len(weights), sum(weights)
    cut, alias = [w * n for w in weights], list(range(n))
    small = deque(i for i in range(n) if cut[i] < total)
    large = deque(i for i in range(n) if cut[i] > total)
    while small and large:
        i, j = small.popleft(), large[0]
        alias[i] = j
        cut[j] -= total - cut[i]
        if cut[j] <= total:
            large.popleft()
            if cut[j] < total:
                small.append(j)
    return cut, alias


def _alias_arrays(labels: pa.Array, weights: pa.Array) -> pa.Array:
    rows = [alias_columns(w) for w in weights.to_pylist()]
    spelled = [[x[i] for i in alias] for x, (_, alias) in zip(labels.to_pylist(), rows)]
    return pa.StructArray.from_arrays(
        [pa.array([r[0] for r in rows], pa.list_(pa.int64())), pa.array(spelled, pa.list_(pa.int32()))], ["cut", "alias"]
    )


def alias_table(weighted: DataFrame) -> DataFrame:
    """(input_id, next_ids, cut, alias, total) from (input_id, label, weight) with whole positive weights.

    Column i of an id gives ``next_ids[i]`` for units below ``cut[i]`` of ``total``,
    else ``alias[i]``. At most a vocabulary of columns per id, labels ascending.
    """
    entries = F.array_sort(F.collect_list(F.struct("label", "weight")))
    rows = weighted.groupBy("input_id").agg(entries.alias("_e"), F.sum("weight").alias("total"))
    made = F.arrow_udf(_alias_arrays, "cut array<long>, alias array<int>")
    return rows.select("input_id", "total", F.col("_e.label").alias("next_ids"), F.col("_e.weight").alias("_w")).withColumn(
        "_a", made("next_ids", "_w")
    ).select("input_id", "next_ids", F.col("_a.cut").alias("cut"), F.col("_a.alias").alias("alias"), "total")


def weights_of(following: DataFrame, units: int = 1 << 32) -> DataFrame:
    """(input_id, label, weight) of a ``successors`` table: probabilities as whole numbers of ``units``, at least one."""
    pairs = following.select("input_id", F.explode(F.arrays_zip("next_ids", "probs")).alias("p"))
    weight = F.greatest(F.lit(1).cast("long"), F.round(F.col("p.probs") * units).cast("long"))
    return pairs.select("input_id", F.col("p.next_ids").alias("label"), weight.alias("weight"))


def shares(table: DataFrame) -> DataFrame:
    """(input_id, label, units): what the columns of an alias table give each label, of ``total`` times their number."""
    columns = table.select("input_id", "total", F.inline(F.arrays_zip("next_ids", "cut", "alias")))
    own = columns.select("input_id", F.col("next_ids").alias("label"), F.col("cut").alias("units"))
    lent = columns.select("input_id", F.col("alias").alias("label"), (F.col("total") - F.col("cut")).alias("units"))
    return own.unionByName(lent).groupBy("input_id", "label").agg(F.sum("units").alias("units"))


def _two_units(seed: str, keys: list[str]) -> tuple[Column, Column]:
    """Two repeatable numbers in [0, 1) from different digits of one md5."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *[F.col(k).cast("string") for k in keys]))

    def unit(first: int) -> Column:
        return F.conv(F.substring(digest, first, UNIT_DIGITS), 16, 10).cast("double") / float(16**UNIT_DIGITS)

    return unit(1), unit(1 + UNIT_DIGITS)


def draw(column: Column, unit: Column) -> Column:
    """The label that two numbers in [0, 1) pick from the alias columns of the row; one column is read."""
    place = F.floor(column * F.size("next_ids")).cast("int")
    below = F.floor(unit * F.col("total")) < F.get("cut", place)
    return F.when(below, F.get("next_ids", place)).otherwise(F.get("alias", place))


def generate_sampled(
    prompts: DataFrame, table: DataFrame, keys: list[str], steps: int, seed: int = DEFAULT_SEED, ids_col: str = "ids"
) -> DataFrame:
    """Prompts with ``new_ids``: ``steps`` ids drawn one after another from a written ``alias_table``.

    A draw is repeatable: it depends on the seed, the step and ``keys``. An id
    without a row is followed by the unknown id.
    """
    columns = table.withColumnRenamed("input_id", "_last")
    small = fits_broadcast(table)
    state = prompts.withColumn("_last", F.try_element_at(ids_col, F.lit(-1))).withColumn("new_ids", F.array().cast("array<int>"))
    written = None
    for step in range(steps):
        if step and step % STEPS_PER_WRITE == 0:
            written, done = materialise(state, "sampled"), written
            state = written
            if done is not None:
                discard(done)
        met = lookup_join(state, columns, ["_last"], salt_by=keys, how="left", small=small)
        drawn = F.coalesce(draw(*_two_units(f"{seed}:{step}", keys)), F.lit(UNK)).cast("int")
        state = met.withColumn("_next", drawn).select(
            *prompts.columns, F.col("_next").alias("_last"), F.concat("new_ids", F.array("_next")).alias("new_ids")
        )
    return state.drop("_last")
