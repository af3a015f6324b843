"""Row identity, split and selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.split import (
    sample_prefix,
    sample_stats,
    select_by_index,
    split_by_hash,
    split_sizes,
)
from textloom.plans.ordering import row_ids, with_row_id
from textloom.queries.common import MARKED_SQL, documents, table

PREFIX = 500


def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_ids(documents(spark, sf_dir), "doc_id")


def _side(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        marked = split_by_hash(documents(spark, sf_dir).select("doc_id", "lang", "n_chars"), ["doc_id"])
        return marked.where(F.col("split") == name).drop("split")

    return query


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_sizes(split_by_hash(documents(spark, sf_dir).select("doc_id"), ["doc_id"]))


def by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents at the positions listed in ``labels``, best quality first."""
    numbered = with_row_id(documents(spark, sf_dir).select("doc_id", "lang"), "doc_id")
    order = row_ids(table(spark, sf_dir, "labels").select((-F.col("quality")).alias("q"), "doc_id"), "q", "doc_id", id_col="place")
    index = order.select(F.col("doc_id").alias("row_id"), "place")
    return select_by_index(numbered, index).select("place", "row_id", "doc_id", "lang")


def prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_prefix(documents(spark, sf_dir).select("doc_id", "text"), PREFIX, "doc_id").select(
        "doc_id", F.length("text").alias("n")
    )


def prefix_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_stats(sample_prefix(documents(spark, sf_dir).select("doc_id", "text"), order_key="doc_id"))


QUERIES = {
    "row_index": row_index,
    "split_train": _side("train"),
    "split_validation": _side("validation"),
    "split_sizes": sizes,
    "select_by_index": by_index,
    "sample_prefix": prefix,
    "sample_stats": prefix_stats,
}

SQL = {
    "row_index": "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_id FROM documents",
    "split_train": f"WITH {MARKED_SQL} SELECT doc_id, lang, n_chars FROM marked WHERE split = 'train'",
    "split_validation": f"WITH {MARKED_SQL} SELECT doc_id, lang, n_chars FROM marked WHERE split = 'validation'",
    "split_sizes": f"WITH {MARKED_SQL} SELECT split, count(*) AS n_rows FROM marked GROUP BY split",
    "select_by_index": """WITH numbered AS (
  SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_id, doc_id, lang FROM documents),
chosen AS (
  SELECT row_number() OVER (ORDER BY quality DESC, doc_id) - 1 AS place, doc_id AS row_id FROM labels)
SELECT place, row_id, doc_id, lang FROM chosen JOIN numbered USING (row_id)""",
    "sample_prefix": f"""SELECT doc_id, length(text)::INT AS n FROM documents
WHERE text IS NOT NULL AND text <> '' ORDER BY doc_id LIMIT {PREFIX}""",
    "sample_stats": """SELECT count(*) AS n_texts, sum(length(text))::BIGINT AS n_chars
FROM documents WHERE text <> ''""",
}
