"""Selection over a table of relative file paths.

Pattern lists are configuration: they are parsed with the same expressions as
a pattern table and then become one predicate, so applying them needs neither
a join nor a shuffle. Only files of patterns beyond LIST_BYTES stay tables: a
rule then meets the paths that hold its longest literal piece, and is tried on
those alone. A directory is any proper '/'-prefix of a path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.globs import glob_regex, is_rule
from textloom.functions.path_rules import Glob, by_parts, matcher
from textloom.functions.text import strip, strip_leading_dots
from textloom.plans.lookup import spread_join
from textloom.plans.ordering import any_of
from textloom.plans.storage import bytes_of, line_table, materialise, read_lines

# Directories left out of a listing by default.
EXCLUDED_DIRS = [".git", "__pycache__", ".venv", "venv", "node_modules", ".pytest_cache"]

# Globs joined into one regular expression ...
GLOBS_AT_ONCE = 500
# ... and the length of a list from which on an automaton over path parts takes their place.
MANY = 500
# Bytes of a file of patterns from which on its rules are joined to the paths instead of becoming a predicate.
LIST_BYTES = 256 << 10


def outside_dirs(path: Column, names: Sequence[str] = EXCLUDED_DIRS) -> Column:
    """True unless a part of the path is one of ``names``."""
    return ~F.arrays_overlap(F.split(path, "/"), F.array(*[F.lit(n) for n in names]))


def pattern_rules(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Exclusion lines as rules; blank and comment lines are dropped, other columns stay.

    A leading '/' ties a literal path to the root, a trailing '/' restricts a
    rule to directories, everything else is a glob at any depth.
    """
    rule = strip(F.col(line_col))
    rooted = rule.startswith("/")
    body = F.when(rooted, F.substr(rule, F.lit(2))).otherwise(rule)
    only_dirs = body.endswith("/")
    body = F.when(only_dirs, F.substr(body, F.lit(1), F.length(body) - 1)).otherwise(body)
    return (
        lines.where(is_rule(F.col(line_col)))
        .withColumn("root_relative", rooted)
        .withColumn("dir_only", only_dirs)
        .withColumn("pattern", body)
        .withColumn(
            "regex",
            F.when(
                ~rooted,
                F.concat(F.lit("(^|/)"), glob_regex(body), F.when(only_dirs, F.lit("/.+$")).otherwise(F.lit("(/.*)?$"))),
            ),
        )
        .drop(line_col)
    )


def read_patterns(spark: SparkSession, patterns: str | Sequence[str] | None) -> DataFrame:
    """Pattern lines (``line``) from a text file or a list; a missing file or anything else gives none."""
    lines = read_lines(spark, patterns) if isinstance(patterns, str) else patterns or []
    return spark.createDataFrame([(p,) for p in lines], "line string")


def prefixes(path: Column) -> Column:
    """Directories a path lies in: 'a/b/c' gives 'a' and 'a/b'."""
    parts = F.split(path, "/")
    return F.transform(
        F.slice(parts, 1, F.size(parts) - 1), lambda _, i: F.array_join(F.slice(parts, 1, i + 1), "/")
    )


def _matches_any(path: Column, rules: dict[str, Glob]) -> list[Column]:
    """Predicates that hold if one of the rules matches, given as regular expressions with their globs.

    A short list stays a regular expression. Of a long one only globs that
    cannot be taken part by part do, a bounded number of them in each.
    """
    parted = {r: g for r, g in rules.items() if by_parts(g[0])} if len(rules) > MANY else {}
    found = sorted(rules.keys() - parted.keys())
    conditions = [path.rlike("|".join(found[i : i + GLOBS_AT_ONCE])) for i in range(0, len(found), GLOBS_AT_ONCE)]
    return [matcher(sorted(parted.values()), path), *conditions] if parted else conditions


def _is_table(spark: SparkSession, patterns: str | Sequence[str] | None) -> bool:
    """Whether the patterns are too many for a predicate."""
    return isinstance(patterns, str) and bytes_of(spark, patterns) > LIST_BYTES


def _pieces(part: Column) -> Column:
    """Keys of one part of a path or of a glob without wildcards: itself, what it begins with, what it ends with."""
    ends = F.sequence(F.lit(1), F.length(part))
    heads = F.transform(ends, lambda i: F.concat(F.lit("h"), F.substr(part, F.lit(1), i)))
    tails = F.transform(ends, lambda i: F.concat(F.lit("t"), F.substr(part, i)))
    return F.when(part == "", F.array().cast("array<string>")).otherwise(F.concat(F.array(F.concat(F.lit("p"), part)), heads, tails))


def _glob_key(glob: Column) -> Column:
    """The longest literal piece that every matching path has; null for globs without one or not taken part by part."""

    def piece(kind: str, value: Column) -> Column:
        return F.struct(F.length(value).alias("n"), F.concat(F.lit(kind), value).alias("key"))

    def of_part(part: Column) -> Column:
        head = F.regexp_extract(part, r"(?s)^[^*?\[\]]*", 0)
        tail = F.regexp_extract(part, r"(?s)[^*?\[\]]*\z", 0)
        return F.when(head == part, piece("p", part)).otherwise(F.greatest(piece("h", head), piece("t", tail)))

    parts = F.split(glob, "/")
    apart = F.forall(parts, lambda p: (p != "") & ((p == "**") | ~p.contains("**")))
    longest = F.array_max(F.transform(parts, of_part))
    return F.when(apart & (longest["n"] > 0), longest["key"])


def _matched(paths: DataFrame, path_col: str, rules: DataFrame, rest: Column) -> DataFrame:
    """(path): the distinct paths that a rule (key, regex) matches, or for which ``rest`` holds.

    Only paths with a rule's key are tried. A rule without a regex matches wherever its key is.
    """
    path = F.col("path")
    distinct = materialise(paths.select(F.col(path_col).alias("path")).where("path IS NOT NULL").distinct(), "paths")
    by_key = rules.distinct().groupBy("key").agg(F.collect_list("regex").alias("regexes"), F.bool_or(F.isnull("regex")).alias("always"))
    keys = F.array_distinct(
        F.concat(
            F.flatten(F.transform(F.split(path, "/"), _pieces)),
            F.transform(prefixes(path), lambda p: F.concat(F.lit("d"), p)),
            F.array(F.concat(F.lit("w"), path)),
        )
    )
    # the keys of rules are few beside the pieces of paths
    met = distinct.select("path", F.explode(keys).alias("key")).join(by_key.select("key"), "key", "left_semi")
    tried = spread_join(materialise(met, "path-keys"), by_key, "key", ["path"])
    found = tried.where(F.col("always") | F.exists("regexes", lambda r: F.rlike(path, r))).select("path")
    return found.union(distinct.where(rest)).distinct()


def _joined(paths: DataFrame, path_col: str, globs: DataFrame, others: DataFrame | None, subtree: bool) -> DataFrame:
    """``_matched`` for globs (regex, glob, deep, dir_only) and other rules (key, regex).

    Globs without any literal piece are listed, as those of short lists are.
    """
    # unlike '$' this ends behind a line break, and '.' may be one
    regex = F.concat(F.lit("(?s)"), F.substr("regex", F.lit(1), F.length("regex") - 1), F.lit(r"\z"))
    keyed = materialise(globs.withColumn("key", _glob_key(F.col("glob"))), "path-globs")
    loose = {r["regex"]: (r["glob"], r["deep"], r["dir_only"], subtree) for r in keyed.where("key IS NULL").collect()}
    rules = keyed.where("key IS NOT NULL").select("key", regex.alias("regex"))
    rules = rules if others is None else rules.union(others)
    return _matched(paths, path_col, rules, any_of(_matches_any(F.col("path"), loose)))


def _excluded_paths(paths: DataFrame, path_col: str, patterns: str) -> DataFrame | None:
    """(path): the distinct paths that a large file of exclusion patterns covers; None if all are."""
    rules = materialise(pattern_rules(line_table(paths.sparkSession, patterns)), "path-rules")
    literal = rules.where("root_relative")
    if literal.where("pattern = ''").limit(1).count():
        return None
    globs = rules.where("NOT root_relative").select("regex", F.col("pattern").alias("glob"), F.lit(True).alias("deep"), "dir_only")
    none = F.lit(None).cast("string")
    dirs = literal.select(F.concat(F.lit("d"), "pattern").alias("key"), none.alias("regex"))
    whole = literal.where("NOT dir_only").select(F.concat(F.lit("w"), "pattern"), none)
    return _joined(paths, path_col, globs, dirs.union(whole), True)


def excluded_by(spark: SparkSession, path: Column, patterns: str | Sequence[str] | None) -> Column:
    """True for paths that any exclusion pattern covers.

    Literal patterns are looked up as a set, once for each directory of a path
    and for the path itself, so their number does not matter.
    """
    rules = pattern_rules(read_patterns(spark, patterns)).collect()  # a configuration
    literal = [r for r in rules if r["root_relative"]]
    if any(r["pattern"] == "" for r in literal):
        return F.lit(True)
    dirs = sorted({r["pattern"] for r in literal})
    whole = sorted({r["pattern"] for r in literal if not r["dir_only"]})
    globs = {r["regex"]: (r["pattern"], True, r["dir_only"], True) for r in rules if not r["root_relative"]}
    conditions = _matches_any(path, globs)
    if dirs:
        conditions.append(F.exists(prefixes(path), lambda p: p.isin(dirs)))
    if whole:
        conditions.append(path.isin(whole))
    return any_of(conditions)


def _inclusions(lines: DataFrame) -> DataFrame:
    """(regex, glob, deep, dir_only) of inclusion globs: anchored at the root if they contain ``**``."""
    glob = strip_leading_dots(F.col("line"))
    rooted = glob.contains("**")
    depth = F.when(rooted, F.lit("^")).otherwise(F.lit("(^|/)"))
    regex = F.concat(depth, glob_regex(glob), F.lit("$"))
    return lines.select(regex.alias("regex"), glob.alias("glob"), (~rooted).alias("deep"), F.lit(False).alias("dir_only"))


def included_by(spark: SparkSession, path: Column, patterns: str | Sequence[str] | None) -> Column:
    """True for paths that any inclusion glob matches, from the root or, unless it
    contains ``**``, at any depth."""
    found = _inclusions(read_patterns(spark, patterns)).collect()
    return any_of(_matches_any(path, {r["regex"]: (r["glob"], r["deep"], False, False) for r in found}))


def exclude(paths: DataFrame, patterns: str | Sequence[str] | None, path_col: str = "path") -> DataFrame:
    """Paths that no exclusion pattern covers; a large file of patterns is joined, not collected."""
    if not _is_table(paths.sparkSession, patterns):
        return paths.where(~excluded_by(paths.sparkSession, F.col(path_col), patterns))
    covered = _excluded_paths(paths, path_col, patterns)
    if covered is None:
        return paths.where(F.lit(False))
    return paths.join(covered.withColumnRenamed("path", "_covered"), F.col(path_col) == F.col("_covered"), "left_anti")


def include(paths: DataFrame, patterns: str | Sequence[str] | None, path_col: str = "path") -> DataFrame:
    """Paths that an inclusion glob matches; a large file of globs is joined, not collected."""
    if not _is_table(paths.sparkSession, patterns):
        return paths.where(included_by(paths.sparkSession, F.col(path_col), patterns))
    found = _joined(paths, path_col, _inclusions(line_table(paths.sparkSession, patterns)), None, False)
    return paths.join(found.withColumnRenamed("path", "_found"), F.col(path_col) == F.col("_found"), "left_semi")


def collect_paths(
    paths: DataFrame,
    exclude_patterns: str | Sequence[str] | None = None,
    include_patterns: str | Sequence[str] | None = None,
    excluded_dirs: Sequence[str] = EXCLUDED_DIRS,
    path_col: str = "path",
) -> DataFrame:
    """Distinct paths that are kept or explicitly included; inclusion wins."""
    spark, path = paths.sparkSession, F.col(path_col)
    if _is_table(spark, exclude_patterns) or _is_table(spark, include_patterns):
        only = paths.select(path_col)
        outside = exclude(only.where(outside_dirs(path, excluded_dirs)), exclude_patterns, path_col)
        return outside.union(include(only, include_patterns, path_col)).distinct()
    kept = outside_dirs(path, excluded_dirs) & ~excluded_by(spark, path, exclude_patterns)
    return paths.where(kept | included_by(spark, path, include_patterns)).select(path_col).distinct()


def relative_path(path: Column, root: str) -> Column:
    """The path below ``root``, or the file name if it lies elsewhere."""
    prefix = root.rstrip("/") + "/"
    return F.when(path.startswith(prefix), F.substr(path, F.lit(len(prefix) + 1))).otherwise(
        F.element_at(F.split(path, "/"), -1)
    )
