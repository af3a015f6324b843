"""Named dataset snapshots already present in a cache directory.

Layout: ``{cache_dir}/{dataset_id}/{split}/*.parquet``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.plans.storage import exists, list_names


def first_split(spark: SparkSession, dataset_id: str, cache_dir: str) -> str:
    root = f"{cache_dir.rstrip('/')}/{dataset_id}"
    names = list_names(spark, root) if exists(spark, root) else []
    if not names:
        raise ValueError(f"no snapshot of '{dataset_id}' in {cache_dir}")
    return names[0]


def scan_snapshot(spark: SparkSession, dataset_id: str, cache_dir: str, split: str | None = None) -> DataFrame:
    """The named split, or the first one in sorted order."""
    split = split or first_split(spark, dataset_id, cache_dir)
    path = f"{cache_dir.rstrip('/')}/{dataset_id}/{split}"
    if not exists(spark, path):
        raise ValueError(f"snapshot of '{dataset_id}' has no split '{split}'")
    return spark.read.parquet(path)
