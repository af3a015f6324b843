"""Text predicates, coercion and string scalars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: runs of word characters, or runs of anything else that is not space.
PRETOKEN_PATTERN = r"((?U)\w+|[^\w\s]+)"


def is_usable(df: DataFrame, column: str = "text") -> Column:
    """A string, not null and not empty; whitespace-only text counts as usable.

    No value of a column of another type is a string, so none of it is usable.
    """
    if not isinstance(df.schema[column].dataType, T.StringType):
        return F.lit(False)
    return F.col(column).isNotNull() & (F.col(column) != "")


def coerce_text(value: Column) -> Column:
    """Null becomes the empty string, everything else its string form."""
    return F.coalesce(value.cast("string"), F.lit(""))


def slug(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit(" "), F.lit("-"))


def strip(text: Column) -> Column:
    """Unicode white space removed from both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def strip_leading_dots(text: Column) -> Column:
    """All leading dots and slashes, then all leading dots and backslashes."""
    return F.ltrim(F.ltrim(text, F.lit("./")), F.lit(".\\"))


def pretokens(text: Column) -> Column:
    """Word and punctuation runs as ARRAY<STRING>."""
    return F.regexp_extract_all(text, F.lit(PRETOKEN_PATTERN), 1)


def characters(text: Column) -> Column:
    """Code points as ARRAY<STRING> (a split on '' would cut surrogate pairs)."""
    return F.regexp_extract_all(text, F.lit("(?s)(.)"), 1)
