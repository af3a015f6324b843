"""Corpus statistics behind tokenizer fitting: words, characters, adjacent pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import characters, pretokens

# Fixed value: pairs seen less often are not merged.
MIN_FREQUENCY = 2


def tokens(df: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """(key, pos, word): one row per pre-token, in text order."""
    return df.select(key, F.posexplode(pretokens(F.col(text_col))).alias("pos", "word"))


def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n). Counted per task first, so a frequent word costs one row per task."""
    return df.select(F.explode(pretokens(F.col(text_col))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def alphabet(words: DataFrame) -> DataFrame:
    """The distinct characters of a ``word`` column."""
    return words.select(F.explode(characters(F.col("word"))).alias("ch")).distinct()


def adjacent(symbols: Column) -> Column:
    """Array of (l, r) structs, overlapping: three equal symbols give two pairs."""
    inner = F.greatest(F.size(symbols) - 1, F.lit(0))
    return F.arrays_zip(
        F.slice(symbols, F.lit(1), inner).alias("l"), F.slice(symbols, F.lit(2), inner).alias("r")
    )


def pair_counts(words: DataFrame, symbols: Column, min_frequency: int = 1) -> DataFrame:
    """(l, r, n): adjacent symbols weighted by the word count ``n``."""
    pairs = words.select(F.explode(adjacent(symbols)).alias("p"), "n")
    counted = pairs.groupBy(F.col("p.l").alias("l"), F.col("p.r").alias("r")).agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_frequency) if min_frequency > 1 else counted


def top_pairs(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent pairs, ties by the left then the right symbol."""
    return pairs.orderBy(F.desc("n"), "l", "r").limit(k)


# A word as symbols: every symbol between single spaces, so that two neighbours
# are separated by two spaces and a merge is one string replacement.


def spaced(symbols: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(symbols, "  "), F.lit(" "))


def unspaced(state: Column) -> Column:
    return F.split(F.trim(state), "  ")


def apply_merge(state: Column, left: object, right: object, merged: object) -> Column:
    """Left to right, without overlap; also exact when both symbols are equal."""
    return F.replace(state, F.lit(f" {left}  {right} "), F.lit(f" {merged} "))
