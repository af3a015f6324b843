"""Shaping of id arrays: cut, pad, mask, shift, crop, decode."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import strip


def _int(value: int) -> Column:
    return F.lit(value).cast("int")


def truncate(ids: Column, max_length: int) -> Column:
    return F.slice(ids, 1, max_length)


def pad_right(ids: Column, length: Column | int, pad_id: int) -> Column:
    length = F.lit(length) if isinstance(length, int) else length
    return F.concat(ids, F.array_repeat(_int(pad_id), length - F.size(ids)))


def attention_mask(ids: Column, length: Column | int) -> Column:
    """1 for every real id, 0 for the padding up to ``length``."""
    length = F.lit(length) if isinstance(length, int) else length
    return F.concat(
        F.array_repeat(_int(1), F.size(ids)), F.array_repeat(_int(0), length - F.size(ids))
    )


def shift_labels(ids: Column, pad_id: int) -> Column:
    """Next-id labels: drop the first id, append the pad id."""
    return F.concat(F.slice(ids, F.lit(2), F.greatest(F.size(ids) - 1, F.lit(0))), F.array(_int(pad_id)))


def crop_context(ids: Column, max_context: int) -> Column:
    """The last ``max_context`` ids."""
    start = F.greatest(F.size(ids) - F.lit(max_context), F.lit(0)) + 1
    return F.slice(ids, start, F.lit(max_context))


def string_table(values: list[str]) -> Column:
    """A constant ARRAY<STRING>. Folded by the optimizer; one literal in the plan
    instead of one expression per entry. Used for vocabularies only, so its size
    is bounded by the vocabulary size."""
    return F.from_json(F.lit(json.dumps(values)), "array<string>")


def decode(ids: Column, tokens: list[str], special_ids: list[int]) -> Column:
    """Ids to text without special ids, tokens joined directly, ends stripped."""
    table = string_table(tokens)
    kept = F.filter(ids, lambda i: ~i.isin(special_ids))
    return strip(F.array_join(F.transform(kept, lambda i: F.get(table, i)), ""))
