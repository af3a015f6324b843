"""Exact-size seeded split, positional selection, ordered prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import is_usable
from textloom.plans.ordering import HASH_BITS, first_k, hash_prefix, order_hash

# Seed, share of the train split.
DEFAULT_SEED = 42
DEFAULT_RATIO = 0.9


def train_predicate(df: DataFrame, keys: list[str], ratio: float = DEFAULT_RATIO, seed: int = DEFAULT_SEED) -> Column:
    """True for exactly ``int(n * ratio)`` rows, chosen by the hash of a unique key."""
    digest = order_hash(seed, *keys)
    order = [digest, *[F.col(k) for k in keys]]
    bounds = (0, 2**HASH_BITS - 1)
    return first_k(df, order, lambda n: int(n * ratio), prefix=hash_prefix(digest), bounds=bounds)


def split_by_hash(
    df: DataFrame,
    keys: list[str],
    ratio: float = DEFAULT_RATIO,
    seed: int = DEFAULT_SEED,
    key_table: DataFrame | None = None,
) -> DataFrame:
    """``df`` with ``split`` = train or validation. Membership is a filter on
    literals found from the key column alone; the rows themselves do not move.
    A ``key_table`` that holds the same keys saves reading ``df`` for them."""
    is_train = train_predicate(df if key_table is None else key_table, keys, ratio, seed)
    return df.withColumn("split", F.when(is_train, F.lit("train")).otherwise(F.lit("validation")))


def split_sizes(marked: DataFrame) -> DataFrame:
    return marked.groupBy("split").agg(F.count("*").alias("n_rows"))


def select_by_index(df: DataFrame, index: DataFrame, id_col: str = "row_id", place_col: str = "place") -> DataFrame:
    """Rows listed in ``index`` (id, place), carrying the place for ordering."""
    return df.join(index.select(id_col, place_col), id_col)


def sample_prefix(
    df: DataFrame, num_samples: int | None = None, order_key: str = "row_id", text_col: str = "text"
) -> DataFrame:
    """The first ``num_samples`` rows with usable text, by a unique integer key; all of them if None."""
    usable = df.where(is_usable(df, text_col))
    if num_samples is None:
        return usable
    if num_samples <= 0:
        raise ValueError("num_samples must be positive")
    return usable.where(first_k(usable, [F.col(order_key)], lambda n: num_samples))


def sample_stats(sample: DataFrame, text_col: str = "text") -> DataFrame:
    return sample.agg(
        F.count("*").alias("n_texts"), F.coalesce(F.sum(F.length(text_col)), F.lit(0)).alias("n_chars")
    )
