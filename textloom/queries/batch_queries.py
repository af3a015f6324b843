"""Epoch order, batches, step plan, padding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import batches as B
from textloom.operators import permutation as P
from textloom.operators.split import split_by_hash
from textloom.plans.storage import materialise
from textloom.queries.common import (
    BATCH,
    MARKED_SQL,
    MAX_LENGTH,
    documents,
    encode_sql,
    encoded,
    fit_sql,
    full_encode_sql,
    full_fit_sql,
    full_tokenizer,
    joined,
    rounded,
    with_recursive_sql,
    with_sql,
)

EPOCH = 3


def _keys(spark: SparkSession, sf_dir: str, split: str) -> DataFrame:
    marked = split_by_hash(documents(spark, sf_dir).select("doc_id"), ["doc_id"])
    return marked.where(F.col("split") == split).select("doc_id")


def epoch_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.epoch_positions(_keys(spark, sf_dir, "train"), ["doc_id"], EPOCH)


def epoch_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the train split in an epoch, from dense ids by a keyed permutation."""
    ids = materialise(B.sequential_positions(_keys(spark, sf_dir, "train"), ["doc_id"]), "positions")
    placed = P.epoch_places(ids.withColumnRenamed("pos", "row_id"), ids.count(), EPOCH)
    return placed.select("doc_id", "pos")


def resumed_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the second epoch from its third step on, and of the third epoch, without planning what came before."""
    ids = materialise(B.sequential_positions(_keys(spark, sf_dir, "train"), ["doc_id"]), "positions")
    n = ids.count()
    per_epoch = B.n_batches(n, BATCH)
    plan = P.step_rows(spark, n, per_epoch + 3, 3 * per_epoch, BATCH)
    rows = plan.join(ids.select("doc_id", F.col("pos").alias("row_id")), "row_id")
    return rows.select("step", "epoch", "batch_id", "pos", "doc_id")


def val_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = B.sequential_positions(_keys(spark, sf_dir, "validation"), ["doc_id"])
    return placed.select("doc_id", "pos", B.batch_of(F.col("pos"), BATCH).alias("batch_id"))


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = B.epoch_positions(_keys(spark, sf_dir, "train"), ["doc_id"], EPOCH)
    assembled = B.assemble(placed, ["doc_id"], BATCH)
    return assembled.select("batch_id", "n_rows", joined("doc_id").alias("doc_ids"))


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of an epoch over the whole table."""
    return B.epoch_positions(documents(spark, sf_dir).select("doc_id"), ["doc_id"], EPOCH)


def pad_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = materialise(encoded(spark, sf_dir), "ids")
    padded = B.pad_to_longest(ids, _positions(spark, sf_dir), ["doc_id"], batch_size=BATCH)
    return padded.select(
        "doc_id", "batch_id", joined("input_ids").alias("input_ids"), joined("attention_mask").alias("attention_mask")
    )


def step_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10,000 steps over the batches of the train split, with the rows each one reads."""
    placed = materialise(B.sequential_positions(_keys(spark, sf_dir, "train"), ["doc_id"]), "positions")
    per_batch = placed.groupBy(B.batch_of(F.col("pos"), BATCH).alias("batch_id")).agg(F.count("*").alias("n_rows"))
    plan = B.step_plan(spark, B.n_batches(placed.count(), BATCH))
    return plan.join(per_batch, "batch_id").select("step", "epoch", "batch_id", "n_rows")


def padding_waste(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of padding in batches of ids of the whole vocabulary."""
    ids = encoded(spark, sf_dir, full_tokenizer(spark, sf_dir))
    wasted = B.padding_waste(ids, _positions(spark, sf_dir), ["doc_id"], MAX_LENGTH, batch_size=BATCH)
    return wasted.select("batch_id", "n_rows", "n_real", rounded("waste_fixed"), rounded("waste_dynamic"))


QUERIES = {
    "epoch_shuffle": epoch_shuffle,
    "epoch_permutation": epoch_permutation,
    "resumed_steps": resumed_steps,
    "val_batches": val_batches,
    "batches": batches,
    "pad_dynamic": pad_dynamic,
    "step_plan": step_plan,
    "padding_waste": padding_waste,
}

_SHUFFLED = f"""shuffled AS (
  SELECT doc_id, row_number() OVER (ORDER BY md5('42:{EPOCH}:' || doc_id), doc_id) - 1 AS pos
  FROM marked WHERE split = 'train')"""
_PLACED = f"""placed AS (
  SELECT doc_id, ids, (row_number() OVER (ORDER BY md5('42:{EPOCH}:' || doc_id), doc_id) - 1) // {BATCH} AS batch_id
  FROM enc)"""



def _rounds_sql(value: str, epoch: str) -> str:
    """Columns of all rounds over ``value``; the last one is ``x``, for sides ``a`` and ``b``."""

    def shift(k: int, half: str) -> str:
        return f"('0x' || substr(md5('42:' || {epoch} || ':{k}:' || {half}), 1, {P.DIGITS}))::BIGINT"

    columns = [f"{value} // b AS l0", f"{value} % b AS r0"]
    for k in range(P.ROUNDS):
        columns.append(f"(l{k} + {shift(k, f'r{k}')}) % a AS l{k + 1}" if k % 2 == 0 else f"l{k} AS l{k + 1}")
        columns.append(f"r{k} AS r{k + 1}" if k % 2 == 0 else f"(r{k} + {shift(k, f'l{k}')}) % b AS r{k + 1}")
    return ", ".join(columns) + f", l{P.ROUNDS} * b + r{P.ROUNDS} AS x"


def _permuted_sql(epochs: str) -> str:
    """CTE ``permuted(doc_id, epoch, n, x)``: the place x of every train row in the epochs of a list."""
    return f"""ids AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS id, count(*) OVER () AS n FROM marked WHERE split = 'train'),
sized AS (SELECT *, ceil(n / a)::BIGINT AS b
          FROM (SELECT doc_id, id, n, ceil(sqrt(n))::BIGINT AS a, unnest({epochs}) AS epoch FROM ids)),
walk AS (
  SELECT doc_id, epoch, n, a, b, x FROM (SELECT *, {_rounds_sql('id', 'epoch')} FROM sized)
  UNION ALL
  SELECT doc_id, epoch, n, a, b, y FROM (SELECT * EXCLUDE (x), x AS y0 FROM walk WHERE x >= n)
    , LATERAL (SELECT x AS y FROM (SELECT {_rounds_sql('y0', 'epoch')}))),
permuted AS (SELECT doc_id, epoch, n, x FROM walk WHERE x < n)"""


SQL = {
    "epoch_permutation": f"""WITH RECURSIVE {MARKED_SQL}, {_permuted_sql(f'[{EPOCH}]')}
SELECT doc_id, x AS pos FROM permuted""",
    "resumed_steps": f"""WITH RECURSIVE {MARKED_SQL}, {_permuted_sql('[1, 2]')},
steps AS (SELECT doc_id, epoch::BIGINT AS epoch, x AS pos, x // {BATCH} AS batch_id, (n + {BATCH - 1}) // {BATCH} AS per_epoch FROM permuted)
SELECT epoch * per_epoch + batch_id + 1 AS step, epoch, batch_id, pos, doc_id FROM steps
WHERE epoch * per_epoch + batch_id + 1 >= per_epoch + 3""",
    "epoch_shuffle": f"WITH {MARKED_SQL}, {_SHUFFLED} SELECT doc_id, pos FROM shuffled",
    "val_batches": f"""WITH {MARKED_SQL}
SELECT doc_id, pos, pos // {BATCH} AS batch_id
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM marked WHERE split = 'validation')""",
    "batches": f"""WITH {MARKED_SQL}, {_SHUFFLED}
SELECT pos // {BATCH} AS batch_id, count(*)::INT AS n_rows, string_agg(doc_id, ' ' ORDER BY pos) AS doc_ids
FROM shuffled GROUP BY 1""",
    "pad_dynamic": with_sql(fit_sql(), encode_sql("documents", "doc_id"), _PLACED)
    + """SELECT doc_id, batch_id, array_to_string(list_resize(ids, longest, 1), ' ') AS input_ids,
  array_to_string(list_resize(list_transform(ids, lambda i: 1), longest, 0), ' ') AS attention_mask
FROM (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS longest FROM placed)""",
    "step_plan": f"""WITH {MARKED_SQL},
per_batch AS (
  SELECT pos // {BATCH} AS batch_id, count(*) AS n_rows
  FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM marked WHERE split = 'train') GROUP BY 1),
steps AS (
  SELECT s + 1 AS step, s // n AS epoch, s % n AS batch_id
  FROM range(10000) t(s), (SELECT count(*) AS n FROM per_batch))
SELECT step, epoch, batch_id, n_rows FROM steps JOIN per_batch USING (batch_id)""",
    "padding_waste": with_recursive_sql(full_fit_sql(), full_encode_sql("documents", "doc_id"), _PLACED)
    + f"""SELECT batch_id, count(*) AS n_rows, sum(n)::BIGINT AS n_real,
  round(1 - sum(n) / (count(*) * {MAX_LENGTH}), 6) AS waste_fixed,
  round(1 - sum(n) / (count(*) * max(n)), 6) AS waste_dynamic
FROM (SELECT batch_id, least(len(ids), {MAX_LENGTH}) AS n FROM placed) GROUP BY batch_id""",
}
