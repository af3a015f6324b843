"""Corpus statistics and tokenizer fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import characters
from textloom.operators import corpus_stats as C
from textloom.operators.bpe import fit_bpe
from textloom.operators.split import split_by_hash
from textloom.plans.layout import spread
from textloom.queries.common import (
    MARKED_SQL,
    N_MERGES,
    PRETOKENS,
    documents,
    fit_sql,
    full_fit_sql,
    full_tokenizer,
    texts,
    tokenizer,
    with_recursive_sql,
    with_sql,
)
from textloom.queries.source_queries import MERGES_SQL


def pretokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.tokens(texts(spark, sf_dir), "doc_id").select("doc_id", "pos", "word")


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.word_counts(texts(spark, sf_dir))


def train_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts of the train split: the whole chain from table to statistics."""
    marked = split_by_hash(documents(spark, sf_dir).select("doc_id", "text"), ["doc_id"])
    return C.word_counts(spread(marked.where(F.col("split") == "train"), "doc_id"))


def alphabet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.alphabet(_counts(spark, sf_dir))


def pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.pair_counts(_counts(spark, sf_dir), characters(F.col("word")))


def pair_counts_min2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.pair_counts(_counts(spark, sf_dir), characters(F.col("word")), C.MIN_FREQUENCY)


def top_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.top_pairs(pair_counts(spark, sf_dir), 50)


def apply_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commonest pair of letters and a doubled letter, merged in every distinct word."""
    spaced = C.spaced(characters(F.col("word")))
    merged = C.apply_merge(C.apply_merge(spaced, "t", "h", "th"), "e", "e", "ee")
    return _counts(spark, sf_dir).select("word", "n", F.array_join(C.unspaced(merged), " ").alias("symbols"))


def bpe_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fit_bpe(texts(spark, sf_dir), order_key="doc_id", max_merges=N_MERGES)
    return model.merges_table(spark)


def bpe_full_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All merges of a fit to 8,192 ids; SQL cannot unroll them."""
    return full_tokenizer(spark, sf_dir).merges_table(spark)


def bpe_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenizer(spark, sf_dir).vocab_table(spark)


def vocab_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the vocabulary of a whole fit: 8,192 ids, or fewer if no other pair is seen often enough."""
    return full_tokenizer(spark, sf_dir).vocab_table(spark).agg(F.count("*").alias("vocab_size"))


QUERIES = {
    "pretokenize": pretokenize,
    "word_counts": _counts,
    "train_word_counts": train_word_counts,
    "alphabet": alphabet,
    "pair_counts": pair_counts,
    "pair_counts_min2": pair_counts_min2,
    "top_pairs": top_pairs,
    "apply_merge": apply_merge,
    "bpe_merges": bpe_merges,
    "bpe_full_merges": bpe_full_merges,
    "bpe_vocab": bpe_vocab,
    "vocab_size": vocab_size,
}

_WORDS = f"""words AS (
  SELECT word, count(*) AS n FROM (SELECT unnest({PRETOKENS}) AS word FROM documents) GROUP BY word)"""
_PAIRS = f"""{_WORDS},
pairs AS (
  SELECT a[i] AS l, a[i + 1] AS r, sum(n)::BIGINT AS n
  FROM (SELECT n, a, unnest(range(1, len(a))) AS i
        FROM (SELECT n, regexp_extract_all(word, '.') AS a FROM words))
  GROUP BY 1, 2)"""

SQL = {
    "pretokenize": f"""SELECT doc_id, (generate_subscripts(ws, 1) - 1)::INT AS pos, unnest(ws) AS word
FROM (SELECT doc_id, {PRETOKENS} AS ws FROM documents)""",
    "word_counts": f"WITH {_WORDS} SELECT word, n FROM words",
    "train_word_counts": f"""WITH {MARKED_SQL}
SELECT word, count(*) AS n FROM (SELECT unnest({PRETOKENS}) AS word FROM marked WHERE split = 'train') GROUP BY word""",
    "alphabet": f"WITH {_WORDS} SELECT DISTINCT unnest(regexp_extract_all(word, '.')) AS ch FROM words",
    "pair_counts": f"WITH {_PAIRS} SELECT l, r, n FROM pairs",
    "pair_counts_min2": f"WITH {_PAIRS} SELECT l, r, n FROM pairs WHERE n >= 2",
    "top_pairs": f"WITH {_PAIRS} SELECT l, r, n FROM pairs ORDER BY n DESC, l, r LIMIT 50",
    "apply_merge": f"""WITH {_WORDS}
SELECT word, n, replace(trim(replace(replace(' ' || array_to_string(regexp_extract_all(word, '.'), '  ') || ' ',
  ' t  h ', ' th '), ' e  e ', ' ee ')), '  ', ' ') AS symbols FROM words""",
    "bpe_merges": with_sql(fit_sql()) + MERGES_SQL,
    "bpe_vocab": with_sql(fit_sql()) + "SELECT token, id::INT AS id, kind FROM vocab",
    "vocab_size": with_recursive_sql(full_fit_sql()) + "SELECT count(*) AS vocab_size FROM vocab",
}
