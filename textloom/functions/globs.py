"""Pattern lines as Columns: flags and the regular expression of a glob.

In a glob ``**/`` matches any depth, ``*``, ``?`` and ``[...]`` stay
within one path part.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import strip


def is_rule(line: Column) -> Column:
    """Neither blank nor a comment, after trimming."""
    return (strip(line) != "") & ~strip(line).startswith("#")


def glob_regex(glob: Column) -> Column:
    """The regular expression for a whole glob, without anchors."""
    # classes and wildcards are set aside first so that escaping cannot touch them
    marked = F.regexp_replace(glob, r"\[!([^\]/]+)\]", "\u0004$1\u0006")
    marked = F.regexp_replace(marked, r"\[([^\]/]+)\]", "\u0005$1\u0006")
    for wildcard, mark in (("**/", "\u0001"), ("**", "\u0002"), ("*", "\u0003")):
        marked = F.replace(marked, F.lit(wildcard), F.lit(mark))
    regex = F.regexp_replace(marked, r"([\\.^$+(){}|\[\]])", r"\\$1")
    for mark, meaning in (
        ("?", "[^/]"),
        ("\u0001", "(?:[^/]+/)*"),
        ("\u0002", ".*"),
        ("\u0003", "[^/]*"),
        ("\u0004", "[^"),
        ("\u0005", "["),
        ("\u0006", "]"),
    ):
        regex = F.replace(regex, F.lit(mark), F.lit(meaning))
    return regex
