"""Plain-text corpus output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import is_usable

# Fixed value: a blank line follows every text.
SEPARATOR = "\n\n"


def write_corpus(df: DataFrame, path: str, text_col: str = "text", mode: str = "errorifexists") -> None:
    """Every usable text followed by a blank line, UTF-8, one file per partition."""
    texts = df.where(is_usable(df, text_col)).select(F.col(text_col).alias("value"))
    texts.write.mode(mode).option("lineSep", SEPARATOR).text(path)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Records of a written corpus; a text with blank lines inside comes back in pieces."""
    return spark.read.option("lineSep", SEPARATOR).text(path).withColumnRenamed("value", "text")
