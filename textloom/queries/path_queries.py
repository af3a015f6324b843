"""Selection over the paths of ``pages``, and pattern lines from ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import paths as P
from textloom.plans.storage import scratch_path
from textloom.queries.common import table, texts

DIRS = ["fr", "de"]
EXCLUDE_ROOT = ["/fr", "/de/", "/en/853", "/es/25/"]
EXCLUDE_DEEP = ["*7", "e?/1*", "12*/", "fr/", "[2-4]5"]
EXCLUDE = ["# local folders", "", *EXCLUDE_ROOT, *EXCLUDE_DEEP]
INCLUDE = ["./fr/*5", "de/**", "*.html", "en/[!1-7]?"]


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://[^/]+/", ""), "[?#].*$", "")
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_replace(path, "/$", "").alias("path"))


def paths_excl_dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paths(spark, sf_dir).where(P.outside_dirs(F.col("path"), DIRS))


def pattern_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document read as a pattern line."""
    lines = texts(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return P.pattern_rules(lines)


def _excluding(patterns: list[str]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return P.exclude(_paths(spark, sf_dir), patterns)

    return query


def include_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.include(_paths(spark, sf_dir), INCLUDE)


def collect_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.collect_paths(_paths(spark, sf_dir), EXCLUDE, INCLUDE, excluded_dirs=["es"])


def relative_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    relative = P.relative_path(F.col("path"), "en")
    return _paths(spark, sf_dir).select("page_id", relative.alias("relative"))


def exclude_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thousands of rules: the keys of all customers as names, those of all suppliers with one more character."""
    customers = table(spark, sf_dir, "customer").select(F.concat(F.col("c_custkey").cast("string"), F.lit("")).alias("line"))
    suppliers = table(spark, sf_dir, "supplier").select(F.concat(F.col("s_suppkey").cast("string"), F.lit("?")).alias("line"))
    rules = scratch_path(spark, "rules")
    customers.unionByName(suppliers).write.text(rules)
    return P.exclude(_paths(spark, sf_dir), rules)


QUERIES = {
    "exclude_many": exclude_many,
    "paths_excl_dirs": paths_excl_dirs,
    "pattern_rules": pattern_rules,
    "exclude_root": _excluding(EXCLUDE_ROOT),
    "exclude_any_depth": _excluding(EXCLUDE_DEEP),
    "exclude_rules": _excluding(EXCLUDE),
    "include_rules": include_rules,
    "collect_paths": collect_paths,
    "relative_path": relative_path,
}

_PATHS = r"""paths AS (
  SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '^[a-z]+://[^/]+/', ''), '[?#].*$', ''), '/$', '') AS path
  FROM pages)"""
_ROOT = """(starts_with(path, 'fr/') OR path = 'fr' OR starts_with(path, 'de/') OR starts_with(path, 'en/853/')
  OR path = 'en/853' OR starts_with(path, 'es/25/'))"""
_DEEP = r"""(regexp_matches(path, '(^|/)[^/]*7(/.*)?$') OR regexp_matches(path, '(^|/)e[^/]/1[^/]*(/.*)?$')
  OR regexp_matches(path, '(^|/)12[^/]*/.+$') OR regexp_matches(path, '(^|/)fr/.+$')
  OR regexp_matches(path, '(^|/)[2-4]5(/.*)?$'))"""
_INCLUDED = r"""(regexp_matches(path, '(^|/)fr/[^/]*5$') OR regexp_matches(path, '^de/.*$')
  OR regexp_matches(path, '(^|/)[^/]*\.html$') OR regexp_matches(path, '(^|/)en/[^1-7][^/]$'))"""

_GLOB = "body"
_GLOB = rf"regexp_replace({_GLOB}, '\[!([^\]/]+)\]', chr(4) || '\1' || chr(6), 'g')"
_GLOB = rf"regexp_replace({_GLOB}, '\[([^\]/]+)\]', chr(5) || '\1' || chr(6), 'g')"
for _wildcard, _mark in (("**/", 1), ("**", 2), ("*", 3)):
    _GLOB = f"replace({_GLOB}, '{_wildcard}', chr({_mark}))"
_GLOB = rf"regexp_replace({_GLOB}, '([\\.^$+(){{}}|\[\]])', '\\\1', 'g')"
_GLOB = f"replace({_GLOB}, '?', '[^/]')"
for _mark, _meaning in ((1, "(?:[^/]+/)*"), (2, ".*"), (3, "[^/]*"), (4, "[^"), (5, "["), (6, "]")):
    _GLOB = f"replace({_GLOB}, chr({_mark}), '{_meaning}')"

SQL = {
    "exclude_many": f"""WITH {_PATHS}, parts AS (SELECT DISTINCT path, unnest(string_split(path, '/')) AS part FROM paths)
SELECT page_id, path FROM paths WHERE path NOT IN (
  SELECT path FROM parts WHERE part IN (SELECT c_custkey::VARCHAR FROM customer)
  UNION ALL SELECT path FROM parts JOIN supplier ON part[:-2] = s_suppkey::VARCHAR AND length(part) > 1)""",
    "paths_excl_dirs": f"""WITH {_PATHS} SELECT page_id, path FROM paths
WHERE NOT list_has_any(string_split(path, '/'), ['fr', 'de'])""",
    "pattern_rules": rf"""WITH lines AS (
  SELECT doc_id, (generate_subscripts(ls, 1) - 1)::INT AS line_no, regexp_replace(unnest(ls), '^\s+|\s+$', '', 'g') AS rule
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
rooted AS (
  SELECT doc_id, line_no, starts_with(rule, '/') AS root_relative,
         CASE WHEN starts_with(rule, '/') THEN rule[2:] ELSE rule END AS b
  FROM lines WHERE rule <> '' AND NOT starts_with(rule, '#')),
bodies AS (
  SELECT doc_id, line_no, root_relative, ends_with(b, '/') AS dir_only,
         CASE WHEN ends_with(b, '/') THEN b[1:-2] ELSE b END AS body FROM rooted)
SELECT doc_id, line_no, root_relative, dir_only, body AS pattern,
  CASE WHEN NOT root_relative THEN '(^|/)' || {_GLOB} || CASE WHEN dir_only THEN '/.+$' ELSE '(/.*)?$' END END AS regex
FROM bodies""",
    "exclude_root": f"WITH {_PATHS} SELECT page_id, path FROM paths WHERE NOT {_ROOT}",
    "exclude_any_depth": f"WITH {_PATHS} SELECT page_id, path FROM paths WHERE NOT {_DEEP}",
    "exclude_rules": f"WITH {_PATHS} SELECT page_id, path FROM paths WHERE NOT {_ROOT} AND NOT {_DEEP}",
    "include_rules": f"WITH {_PATHS} SELECT page_id, path FROM paths WHERE {_INCLUDED}",
    "collect_paths": f"""WITH {_PATHS} SELECT DISTINCT path FROM paths
WHERE (NOT list_contains(string_split(path, '/'), 'es') AND NOT {_ROOT} AND NOT {_DEEP}) OR {_INCLUDED}""",
    "relative_path": f"""WITH {_PATHS}
SELECT page_id, CASE WHEN starts_with(path, 'en/') THEN path[4:] ELSE string_split(path, '/')[-1] END AS relative
FROM paths""",
}
