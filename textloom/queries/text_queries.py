"""Projections, predicates, coercion and string scalars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.queries.common import documents, table


def _graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its grade, if it has one."""
    grades = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return documents(spark, sf_dir).select("doc_id", "text").join(grades, "doc_id", "left")


def usable_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only graded documents carry a text; bad grades blank it."""
    text = F.when(F.col("quality") == 1, F.col("text")).when(F.col("quality") == 0, F.lit(""))
    graded = _graded(spark, sf_dir).select("doc_id", text.alias("text"))
    return graded.where(T.is_usable(graded)).select("doc_id", F.md5("text").alias("text_md5"))


def coerce_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _graded(spark, sf_dir).select("doc_id", T.coerce_text(F.col("quality")).alias("text"))


def drop_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).drop("text")


def slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", T.slug(F.col("p_name")).alias("slug"))


def strip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrapped = F.concat(F.lit(" \n"), F.col("text"), F.lit("\t \r\n"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.strip(wrapped).alias("text"))


def strip_lead_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leading dots and slashes off the part of a URL after its scheme, made relative."""
    path = F.concat(F.lit("./.\\.."), F.regexp_replace("url", "^[a-z]+:/", ""))
    return table(spark, sf_dir, "pages").select("page_id", T.strip_leading_dots(path).alias("path"))


QUERIES = {
    "usable_text": usable_text,
    "coerce_text": coerce_text,
    "drop_text": drop_text,
    "slug": slug,
    "strip_text": strip_text,
    "strip_lead_set": strip_lead_set,
}

SQL = {
    "usable_text": """SELECT doc_id, md5(t) AS text_md5
FROM (SELECT doc_id, CASE WHEN quality = 1 THEN text WHEN quality = 0 THEN '' END AS t
      FROM documents LEFT JOIN labels USING (doc_id))
WHERE t IS NOT NULL AND t <> ''""",
    "coerce_text": """SELECT doc_id, coalesce(CAST(quality AS VARCHAR), '') AS text
FROM documents LEFT JOIN labels USING (doc_id)""",
    "drop_text": "SELECT doc_id, lang, source, n_chars FROM documents",
    "slug": "SELECT p_partkey, replace(lower(p_name), ' ', '-') AS slug FROM part",
    "strip_text": r"""SELECT conv_id, turn,
  regexp_replace(chr(32) || chr(10) || text || chr(9) || ' ' || chr(13) || chr(10), '^\s+|\s+$', '', 'g') AS text
FROM conversations""",
    "strip_lead_set": r"""SELECT page_id, ltrim(ltrim('./.\..' || regexp_replace(url, '^[a-z]+:/', ''), './'), '.\') AS path
FROM pages""",
}
