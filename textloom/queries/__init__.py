"""Registered queries: every operator over the shared tables, with its SQL."""

from __future__ import annotations

from textloom.queries import (
    batch_queries,
    corpus_queries,
    encode_queries,
    metric_queries,
    path_queries,
    scoring_queries,
    source_queries,
    split_queries,
    text_queries,
)

_SECTIONS = (
    source_queries,
    split_queries,
    text_queries,
    corpus_queries,
    encode_queries,
    batch_queries,
    metric_queries,
    scoring_queries,
    path_queries,
)

QUERIES = {name: query for section in _SECTIONS for name, query in section.QUERIES.items()}
SQL = {name: sql for section in _SECTIONS for name, sql in section.SQL.items()}
