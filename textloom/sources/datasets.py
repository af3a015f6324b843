"""From a dataset configuration to train and validation tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.split import DEFAULT_RATIO, DEFAULT_SEED, split_by_hash
from textloom.sources.files import numbered, scan, with_file_order
from textloom.sources.snapshots import scan_snapshot

# The fields each source needs, by the source's name.
REQUIRED_FIELDS = {
    "local": ("data_dir", "type"),
    "huggingface": ("dataset_id", "data_dir"),
    "modelscope": ("dataset_id", "data_dir"),
}


def select_config(catalogue: dict[str, Any]) -> dict[str, Any]:
    """The configuration that ``select`` names among ``configs``."""
    name = catalogue.get("select")
    chosen = (catalogue.get("configs") or {}).get(name)
    if not chosen:
        raise ValueError(f"dataset '{name}' is not defined")
    return chosen


def read_source(spark: SparkSession, config: dict[str, Any]) -> DataFrame:
    """The configured table; without a ``key`` also the columns that hold its file order."""
    source = str(config.get("source", "local")).lower()
    if source not in REQUIRED_FIELDS:
        raise ValueError(f"unknown source '{source}', expected one of {', '.join(REQUIRED_FIELDS)}")
    missing = [f for f in REQUIRED_FIELDS[source] if not config.get(f)]
    if missing:
        raise ValueError(f"source '{source}' needs {', '.join(missing)}")
    key = config.get("key")
    if source == "local":
        options = config.get("options") or {}
        df = scan(spark, config["data_dir"], config["type"], config.get("schema"), keep_order=not key, **options)
    else:
        split = "train" if source == "modelscope" else None
        df = scan_snapshot(spark, config["dataset_id"], config["data_dir"], split)
        if not key:
            df = with_file_order(df, indexed=True)
    if "text" not in df.columns:
        raise ValueError("the dataset has no 'text' column")
    return df


def dataset_from_config(
    spark: SparkSession, config: dict[str, Any], split: str | None = None, seed: int = DEFAULT_SEED
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """(train, validation), or just the one that ``split`` names.

    Rows are identified by ``key`` when the configuration names a unique column,
    otherwise by a dense ``row_id`` over file order; the files are then read once
    to count their rows, and the split is found from the ids alone.
    """
    df = read_source(spark, config)
    key = config.get("key")
    ids = None
    if not key:
        mode = {k.lower(): v for k, v in (config.get("options") or {}).items()}.get("mode", "")
        df, rows = numbered(df, frozen=mode.upper() == "DROPMALFORMED")
        key, ids = "row_id", spark.range(rows).toDF("row_id")
    ratio = float(config.get("train_ratio", DEFAULT_RATIO))
    marked = split_by_hash(df, [key], ratio, seed, key_table=ids)
    parts = {name: marked.where(F.col("split") == name).drop("split") for name in ("train", "validation")}
    if split is None:
        return parts["train"], parts["validation"]
    if split not in parts:
        raise ValueError(f"unknown split '{split}'")
    return parts[split]
