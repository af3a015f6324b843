"""Tokenizer tables: save, load, load-or-fit."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from textloom.operators.bpe import BpeModel, fit_bpe
from textloom.sources.datasets import dataset_from_config
from textloom.sources.registry import LATEST, is_published, publish, resolve


def save_model(spark: SparkSession, model: BpeModel, path: str) -> int:
    """Publish ``vocab`` and ``merges`` tables as the next version below ``path``; earlier ones stay readable."""

    def write(folder: str) -> None:
        model.vocab_table(spark).coalesce(1).write.parquet(f"{folder}/vocab")
        model.merges_table(spark).coalesce(1).write.parquet(f"{folder}/merges")

    return publish(spark, path, write)


def has_model(spark: SparkSession, path: str) -> bool:
    return is_published(spark, path)


def load_model(spark: SparkSession, path: str, version: int | str = LATEST) -> BpeModel:
    folder = resolve(spark, path, version)
    return BpeModel.from_tables(spark.read.parquet(f"{folder}/vocab"), spark.read.parquet(f"{folder}/merges"))


def load_or_train(
    spark: SparkSession,
    path: str,
    dataset: DataFrame | None = None,
    vocab_size: int = 8192,
    num_samples: int | None = None,
    force_retrain: bool = False,
    order_key: str = "row_id",
    **fit_options: Any,
) -> BpeModel:
    """The saved model when there is one and no refit is asked for, else a new fit."""
    if not force_retrain and has_model(spark, path):
        return load_model(spark, path)
    if dataset is None:
        raise ValueError("no saved tokenizer and no dataset to fit one")
    model = fit_bpe(dataset, vocab_size=vocab_size, num_samples=num_samples, order_key=order_key, **fit_options)
    save_model(spark, model, path)
    return model


def load_or_train_from_config(
    spark: SparkSession,
    path: str,
    config: dict[str, Any] | None = None,
    force_retrain: bool = False,
    **fit_options: Any,
) -> BpeModel:
    """As ``load_or_train``, reading the train split of a dataset configuration if needed."""
    if not force_retrain and has_model(spark, path):
        return load_model(spark, path)
    if config is None:
        raise ValueError("no saved tokenizer and no dataset configuration")
    train = dataset_from_config(spark, config, split="train")
    fit_options.setdefault("order_key", config.get("key") or "row_id")
    return load_or_train(spark, path, train, force_retrain=force_retrain, **fit_options)
