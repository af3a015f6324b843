"""One registered query per operator, over whole tables, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import (
    html_text,
    merkle,
    mixing,
    neighbours,
    packing,
    quality_rules,
    quotation,
    sentence_pieces,
    sharding,
    simhash,
    substring_dedup,
    suffix_dedup,
    vector_codes,
)
from textloom.llm.common import table
from textloom.llm.digest_sql import codes_sql, merkle_sql

# The place of the vocabulary files is a parameter of the operators; this is the one the queries use.
VOCABULARY = "word_bpe_49k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_vocabulary_path() -> str:
    return vocabulary_path(PIECE_VOCABULARY)


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~quality_rules.passes("base-1")).alias("base_failed"),
        quality_rules.passes(quality_rules.POLICY).alias("kept"),
        "failures",
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.token_count(F.col("text")).alias("tokens"))
    copies, _ = mixing.schedule(docs)
    return copies.select("doc_id", "source", "tokens", F.col("pass").alias("turn"), "start", "block")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = packing.pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary_path())
    narrow = made.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.assign(narrow, ["doc_id", "piece", "ids_crc32"])


def op5_quotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotation.link(table(spark, sf_dir, "conversations"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = substring_dedup.remove_earlier(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = piece_vocabulary_path()
    made = sentence_pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return made.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(sentence_pieces.decode(F.col("ids"), path).cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return made.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", "codebooks_sha256")


QUERIES = {f.__name__: f for f in (
    op1_nearest_neighbours,
    op2_quality_rules,
    op3_mixing,
    op4_best_fit_packing,
    op5_quotation,
    op6_html_text,
    op7_suffix_dedup,
    op8_simhash,
    op9_sharding,
    op10_substring_dedup,
    op11_sentencepiece,
    op12_merkle_manifest,
    op13_vector_codes,
)}

SQL = {
    "op2_quality_rules": r"""WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
win AS (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c
        FROM (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS k
              FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8))),
rep AS (SELECT r, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n
        FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM win WHERE c > 1) GROUP BY r),
run AS (SELECT r, count(*) AS n FROM (SELECT r, unnest(range(2, len(ws) + 1)) AS i, ws FROM w) WHERE ws[i] = ws[i - 1] GROUP BY r),
m AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(run.n, 0) AS n_run_words
      FROM w LEFT JOIN rep USING (r) LEFT JOIN run USING (r)),
f AS (SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
             + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END)
             + (CASE WHEN 5 * n_run_words > n_words THEN 16 ELSE 0 END) + (CASE WHEN word_chars > 60 * n_words THEN 32 ELSE 0 END) AS failures FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words, failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures::BIGINT AS failures
FROM f""",
    "op3_mixing": r"""WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens FROM documents),
s AS (SELECT source, sum(tokens)::BIGINT AS total FROM d GROUP BY source),
-- one pass for the largest source and two for the smallest: the limit fixes the exponent
e AS (SELECT round(CASE WHEN max(total) <= 2 * min(total) THEN 0 ELSE 1 - ln(2.0) / ln(max(total) / min(total)) END, 6) AS power,
             max(total)::DOUBLE AS largest FROM s WHERE total > 0),
b AS (SELECT source, total, CASE WHEN total > 0 THEN floor(total * pow(largest / total, 1 - power) + 0.5)::BIGINT ELSE 0 END AS budget
      FROM s, e),
n AS (SELECT greatest(1, sum(budget)::BIGINT // 1048576) AS n_blocks FROM b),
p AS (SELECT d.*, total, budget, unnest(range(0, greatest(0, CASE WHEN total > 0 THEN (budget - 1) // total ELSE 0 END) + 1)) AS turn
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source),
c AS (SELECT *, turn * total + coalesce(sum(tokens) OVER (PARTITION BY source, turn ORDER BY md5('7:' || turn || ':' || doc_id), doc_id, tokens
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM p)
SELECT doc_id, source, tokens, turn::BIGINT AS turn, start::BIGINT AS start,
       least(n_blocks - 1, start::HUGEINT * n_blocks // greatest(budget, 1))::BIGINT AS block
FROM c, n WHERE turn = 0 OR start < budget""",
    "op12_merkle_manifest": merkle_sql(),
    "op13_vector_codes": codes_sql(),
}
