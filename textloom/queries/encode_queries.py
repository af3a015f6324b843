"""Encoding, shaping and decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import arrays
from textloom.operators.bpe import PAD, SPECIAL_TOKENS, encode, fit_bpe, length_profile, tokenize
from textloom.plans.layout import spread
from textloom.queries.common import (
    MAX_LENGTH,
    PRETOKENS,
    documents,
    encode_sql,
    encoded,
    full_tokenizer,
    fit_sql,
    joined,
    rounded,
    table,
    texts,
    tokenizer,
    with_sql,
)


# More than the fit applies before it rewrites its word table.
LONG_MERGES = 80


def bpe_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(spark, sf_dir).select("doc_id", joined("ids").alias("ids"))


def long_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fit of LONG_MERGES merges, which rewrites its word table on the way.

    SQL cannot unroll that many merges; it knows that decoding gives back a text
    without white space, and that all ids are in the vocabulary.
    """
    data = texts(spark, sf_dir)
    model = fit_bpe(data, order_key="doc_id", max_merges=LONG_MERGES)
    ids = data.select("doc_id", encode(model, F.col("text"), spark).alias("ids"))
    known = F.forall("ids", lambda i: (i >= len(SPECIAL_TOKENS)) & (i < model.vocab_size))
    merges = F.lit(len(model.merges))
    return ids.select("doc_id", F.md5(model.decode(F.col("ids"))).alias("text_md5"), known.alias("known"), merges.alias("n_merges"))


def full_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by the vocabulary of 8,192 ids: decoding gives back a text without white space."""
    model = full_tokenizer(spark, sf_dir)
    ids = texts(spark, sf_dir).select("doc_id", encode(model, F.col("text"), spark).alias("ids"))
    known = F.forall("ids", lambda i: (i >= len(SPECIAL_TOKENS)) & (i < model.vocab_size))
    return ids.select("doc_id", F.md5(model.decode(F.col("ids"))).alias("text_md5"), known.alias("known"))


def encode_unk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents encoded with a tokenizer that only saw the benchmark texts."""
    model = tokenizer(spark, sf_dir, "benchmark", "item_id")
    ids = encode(model, F.col("text"), spark)
    return texts(spark, sf_dir).select("doc_id", ids.alias("ids")).select(
        "doc_id", joined("ids").alias("ids"), F.size(F.filter("ids", lambda i: i == 0)).alias("n_unknown")
    )


def _cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = arrays.truncate(F.col("ids"), MAX_LENGTH)
    return encoded(spark, sf_dir).select("doc_id", ids.alias("ids"))


def truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cut(spark, sf_dir).select("doc_id", joined("ids").alias("ids"))


def pad_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cut(spark, sf_dir).select("doc_id", joined(arrays.pad_right(F.col("ids"), MAX_LENGTH, PAD)).alias("ids"))


def attention_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    mask = arrays.attention_mask(F.col("ids"), MAX_LENGTH)
    return _cut(spark, sf_dir).select("doc_id", joined(mask).alias("mask"))


def shift_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = _cut(spark, sf_dir).withColumn("ids", arrays.pad_right(F.col("ids"), MAX_LENGTH, PAD))
    return padded.select("doc_id", joined(arrays.shift_labels(F.col("ids"), PAD)).alias("labels"))


def tokenize_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = spread(documents(spark, sf_dir).select("doc_id", "text", "lang"), "doc_id")
    tokenized = tokenize(corpus, tokenizer(spark, sf_dir), MAX_LENGTH)
    return tokenized.select(
        "doc_id", "lang", joined("input_ids").alias("input_ids"), joined("labels").alias("labels")
    )


def encode_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = table(spark, sf_dir, "conversations")
    ids = encode(tokenizer(spark, sf_dir), F.col("text"), spark)
    return prompts.select("conv_id", "turn", ids.alias("ids")).select("conv_id", "turn", joined("ids").alias("ids"))


def decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents there and back, with the special ids of fixed padding to skip."""
    padded = encoded(spark, sf_dir).withColumn("ids", F.concat("ids", F.array(F.lit(PAD), F.lit(2), F.lit(3), F.lit(0))))
    model = tokenizer(spark, sf_dir)
    return padded.select("doc_id", model.decode(F.col("ids")).alias("text"))


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = length_profile(encoded(spark, sf_dir), MAX_LENGTH)
    return measured.select(*[c for c in measured.columns if c != "avg_ids"], rounded("avg_ids"))


QUERIES = {
    "bpe_encode": bpe_encode,
    "bpe_long_fit": long_fit,
    "bpe_full_encode": full_encode,
    "encode_unk": encode_unk,
    "truncate": truncate,
    "pad_fixed": pad_fixed,
    "attention_mask": attention_mask,
    "shift_labels": shift_labels,
    "tokenize_corpus": tokenize_corpus,
    "encode_prompts": encode_prompts,
    "decode": decode,
    "length_profile": profile,
}

ENC = with_sql(fit_sql(), encode_sql("documents", "doc_id"))
_PADDED = f"list_resize(ids[1:{MAX_LENGTH}], {MAX_LENGTH}, 1)"

SQL = {
    "bpe_long_fit": f"""SELECT doc_id, md5(array_to_string({PRETOKENS}, '')) AS text_md5, true AS known, {LONG_MERGES} AS n_merges
FROM documents""",
    "bpe_full_encode": f"""SELECT doc_id, md5(array_to_string({PRETOKENS}, '')) AS text_md5, true AS known FROM documents""",
    "bpe_encode": ENC + "SELECT doc_id, array_to_string(ids, ' ') AS ids FROM enc",
    "encode_unk": with_sql(fit_sql("benchmark", "item_id"), encode_sql("documents", "doc_id"))
    + """SELECT doc_id, array_to_string(ids, ' ') AS ids, len(list_filter(ids, lambda i: i = 0))::INT AS n_unknown
FROM enc""",
    "truncate": ENC + f"SELECT doc_id, array_to_string(ids[1:{MAX_LENGTH}], ' ') AS ids FROM enc",
    "pad_fixed": ENC + f"SELECT doc_id, array_to_string({_PADDED}, ' ') AS ids FROM enc",
    "attention_mask": ENC
    + f"""SELECT doc_id, array_to_string(list_resize(list_transform(ids[1:{MAX_LENGTH}], lambda i: 1), {MAX_LENGTH}, 0), ' ')
  AS mask FROM enc""",
    "shift_labels": ENC
    + f"SELECT doc_id, array_to_string(list_append({_PADDED}[2:], 1), ' ') AS labels FROM enc",
    "tokenize_corpus": ENC
    + f"""SELECT doc_id, lang, array_to_string({_PADDED}, ' ') AS input_ids,
  array_to_string(list_append({_PADDED}[2:], 1), ' ') AS labels FROM enc JOIN documents USING (doc_id)""",
    "encode_prompts": with_sql(
        fit_sql(),
        "prompts AS (SELECT conv_id * 1000 + turn AS k, conv_id, turn, text FROM conversations)",
        encode_sql("prompts", "k"),
    )
    + "SELECT conv_id, turn, array_to_string(ids, ' ') AS ids FROM enc JOIN prompts USING (k)",
    # every token of the corpus is known, so decoding gives the text without white space
    "decode": r"SELECT doc_id, regexp_replace(text, '\s+', '', 'g') AS text FROM documents",
    "length_profile": ENC
    + f"""SELECT count(*) AS n_rows, sum(len(ids))::BIGINT AS n_ids,
  sum(least(len(ids), {MAX_LENGTH}))::BIGINT AS n_kept,
  sum(greatest(len(ids) - {MAX_LENGTH}, 0))::BIGINT AS n_cut,
  sum(greatest({MAX_LENGTH} - len(ids), 0))::BIGINT AS n_pad,
  max(len(ids))::INT AS max_ids, count(*) FILTER (len(ids) > {MAX_LENGTH}) AS n_truncated_rows,
  round(avg(len(ids)), 6) AS avg_ids FROM enc""",
}
