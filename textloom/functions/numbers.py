"""Integer arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(value: Column, by: int) -> Column:
    """Whole quotient as bigint, exact for every bigint."""
    return F.call_function("div", value, F.lit(by))
