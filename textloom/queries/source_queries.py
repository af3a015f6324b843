"""Reading and writing corpora, configurations, tokenizer tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.plans.ordering import row_ids
from textloom.plans.storage import materialise, scratch_path
from textloom.queries.common import MARKED_SQL, N_MERGES, documents, fit_sql, texts, tokenizer, with_sql
from textloom.sources.artifacts import load_model, load_or_train, load_or_train_from_config, save_model
from textloom.sources.datasets import dataset_from_config, select_config
from textloom.sources.files import number_rows, scan, sorted_files
from textloom.sources.registry import resolve
from textloom.sources.sinks import read_corpus, write_corpus
from textloom.sources.snapshots import scan_snapshot

# Files that a language is written to, at most.
FILES_PER_LANG = 32

# Rows of a CSV file: with quoted line breaks a file is read by one task, so a large table has to be many files.
ROWS_PER_FILE = 8192

# Text goes out as it is, quotes doubled.
_CSV = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _written(spark: SparkSession, sf_dir: str, fmt: str, **options: str) -> str:
    path = scratch_path(spark, f"corpus-{fmt}")
    documents(spark, sf_dir).write.options(**options).format(fmt).save(path)
    return path


def _checked(df: DataFrame) -> DataFrame:
    """Passthrough columns, and the text as a digest."""
    return df.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.md5("text").alias("text_md5"),
        F.col("lang"),
        F.col("source"),
        F.col("n_chars").cast("bigint").alias("n_chars"),
    )


_CHECKED_SQL = "SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents"


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(spark, sf_dir, "csv", **_CSV, maxRecordsPerFile=ROWS_PER_FILE)
    return _checked(scan(spark, path, "csv"))


def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(scan(spark, _written(spark, sf_dir, "json"), "json"))


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(scan(spark, _written(spark, sf_dir, "parquet"), "parquet"))


def scan_txt(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "corpus-txt")
    documents(spark, sf_dir).select("text").write.text(path)
    return scan(spark, path, "txt").groupBy(F.md5("text").alias("line_md5")).agg(F.count("*").alias("n_lines"))


def _in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).repartitionByRange("doc_id").sortWithinPartitions("doc_id")


def numbered_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet rows by their place in file order, found from the files' row counts."""
    path = scratch_path(spark, "corpus-in-order")
    _in_order(spark, sf_dir).write.parquet(path)
    rows = number_rows(scan(spark, path, "parquet", keep_order=True))
    return rows.select("row_id", F.col("doc_id").cast("bigint").alias("doc_id"), F.md5("text").alias("text_md5"))


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of text files by their place in file order, found from the splits' line counts."""
    path = scratch_path(spark, "lines-in-order")
    _in_order(spark, sf_dir).select("text").write.text(path)
    rows = number_rows(scan(spark, path, "txt", keep_order=True))
    return rows.select("row_id", F.md5("text").alias("line_md5"))


def _snapshot(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "snapshots")
    documents(spark, sf_dir).write.parquet(f"{root}/corpus/train")
    return root


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(scan_snapshot(spark, "corpus", _snapshot(spark, sf_dir)))


def config_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot configuration whose rows are identified by a unique column."""
    config = {"source": "ModelScope", "dataset_id": "corpus", "data_dir": _snapshot(spark, sf_dir), "key": "doc_id"}
    train, validation = dataset_from_config(spark, config)
    sides = {"train": train, "validation": validation}
    first, second = (df.select("doc_id", F.lit(name).alias("split")) for name, df in sides.items())
    return first.unionByName(second)


def config_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A local CSV configuration; rows are numbered in file order."""
    path = scratch_path(spark, "corpus-csv")
    _in_order(spark, sf_dir).write.options(**_CSV, maxRecordsPerFile=ROWS_PER_FILE).csv(path)
    catalogue = {
        "select": "csv_corpus",
        "configs": {"csv_corpus": {"source": "local", "data_dir": path, "type": "csv", "train_ratio": 0.8}},
    }
    train = dataset_from_config(spark, select_config(catalogue), split="train")
    return train.select("row_id", F.col("doc_id").cast("bigint").alias("doc_id"), F.md5("text").alias("text_md5"))


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of a corpus written by language, in order of their paths.

    Names and number of Spark's files are not known to SQL. Per language: its
    place among the languages, whether its files stand together in the listing,
    and the rows found by reopening the files listed.
    """
    path = scratch_path(spark, "corpus-by-lang")
    rows = documents(spark, sf_dir).select("lang", "doc_id")
    rows.repartition("lang", F.pmod(F.xxhash64("doc_id"), F.lit(FILES_PER_LANG))).write.partitionBy("lang").parquet(path)
    listed = sorted_files(spark, path, "*.parquet").where(F.col("length") > 0)
    placed = materialise(row_ids(listed, "path", id_col="at"), "listing-order")
    found = spark.read.parquet(path).select("doc_id", F.regexp_replace(F.input_file_name(), "^.*/(lang=)", "$1").alias("path"))
    counts = found.groupBy("path").agg(F.count("*").alias("n_rows"))
    files = placed.join(counts, "path", "left").withColumn("lang", F.regexp_extract("path", "^lang=([^/]+)/", 1))
    langs = files.groupBy("lang").agg(
        F.min("at").alias("first"),
        (F.max("at") - F.min("at") + 1 == F.count("*")).alias("together"),
        F.sum("n_rows").alias("n_rows"),
    )
    order = row_ids(materialise(langs, "listing-langs"), "first", id_col="place", carry=["lang", "together", "n_rows"])
    return order.select("lang", "place", "together", "n_rows")


def corpus_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "corpus-text")
    write_corpus(texts(spark, sf_dir), path)
    return read_corpus(spark, path).agg(
        F.count("*").alias("n_records"), F.sum(F.length("text")).cast("bigint").alias("n_chars")
    )


def tokenizer_artifact_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokenizer")
    save_model(spark, tokenizer(spark, sf_dir), path)
    return spark.read.parquet(f"{resolve(spark, path)}/merges")


def published_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fits published one after the other: the merges of both versions."""
    path = scratch_path(spark, "tokenizer")
    data = texts(spark, sf_dir)
    load_or_train(spark, path, data, order_key="doc_id", max_merges=N_MERGES // 2)
    load_or_train(spark, path, data, order_key="doc_id", max_merges=N_MERGES, force_retrain=True)
    both = [load_model(spark, path, v).merges_table(spark).select(F.lit(v).alias("version"), "*") for v in (0, 1)]
    return both[0].unionByName(both[1])


def tokenizer_vocab_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokenizer")
    save_model(spark, tokenizer(spark, sf_dir), path)
    return load_model(spark, path).vocab_table(spark)


def load_or_train_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merges fitted on the train split of a snapshot configuration, read back from the saved model."""
    path = scratch_path(spark, "tokenizer")
    config = {"source": "modelscope", "dataset_id": "corpus", "data_dir": _snapshot(spark, sf_dir), "key": "doc_id"}
    load_or_train_from_config(spark, path, config, max_merges=N_MERGES)
    return load_or_train_from_config(spark, path).merges_table(spark)


def load_or_train_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokenizer")
    load_or_train(spark, path, texts(spark, sf_dir), order_key="doc_id", max_merges=N_MERGES)
    load_or_train(spark, path)  # no dataset: must come from the saved tables
    return load_model(spark, path).vocab_table(spark)


QUERIES = {
    "scan_csv": scan_csv,
    "scan_json": scan_json,
    "scan_parquet": scan_parquet,
    "scan_txt": scan_txt,
    "numbered_parquet": numbered_parquet,
    "numbered_lines": numbered_lines,
    "scan_snapshot": snapshot,
    "dataset_from_config": config_local,
    "dataset_from_snapshot_config": config_snapshot,
    "file_listing": file_listing,
    "corpus_sink_roundtrip": corpus_sink_roundtrip,
    "tokenizer_artifact_roundtrip": tokenizer_artifact_roundtrip,
    "tokenizer_vocab_roundtrip": tokenizer_vocab_roundtrip,
    "published_models": published_models,
    "load_or_train": load_or_train_twice,
    "load_or_train_config": load_or_train_config,
}

MERGES_SQL = """SELECT (rank - 1)::INT AS rank, x.token AS l, y.token AS r, n AS freq
FROM mer JOIN vocab x ON x.id = mer.l JOIN vocab y ON y.id = mer.r"""

SQL = {
    "scan_csv": _CHECKED_SQL,
    "scan_json": _CHECKED_SQL,
    "scan_parquet": _CHECKED_SQL,
    "scan_snapshot": _CHECKED_SQL,
    "scan_txt": """SELECT md5(line) AS line_md5, count(*) AS n_lines
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1""",
    "numbered_parquet": """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_id, doc_id, md5(text) AS text_md5
FROM documents""",
    "numbered_lines": """SELECT row_number() OVER (ORDER BY doc_id, place) - 1 AS row_id, md5(line) AS line_md5
FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place
      FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))""",
    "dataset_from_config": """WITH numbered AS (
  SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_id, doc_id, text FROM documents),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || row_id), row_id) AS place, count(*) OVER () AS n FROM numbered)
SELECT row_id, doc_id, md5(text) AS text_md5 FROM ranked WHERE place <= floor(0.8 * n)""",
    "dataset_from_snapshot_config": """SELECT doc_id, CASE WHEN place <= floor(0.9 * n) THEN 'train' ELSE 'validation' END AS split
FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS place, count(*) OVER () AS n
      FROM documents)""",
    "file_listing": """SELECT lang, row_number() OVER (ORDER BY 'lang=' || lang || '/') - 1 AS place, true AS together,
  count(*) AS n_rows FROM documents GROUP BY lang""",
    "corpus_sink_roundtrip": """SELECT sum(pieces)::BIGINT AS n_records, sum(n_chars)::BIGINT AS n_chars
FROM (SELECT len(string_split(text, chr(10) || chr(10))) AS pieces,
             length(replace(text, chr(10) || chr(10), '')) AS n_chars
      FROM documents WHERE text <> '')""",
    "tokenizer_artifact_roundtrip": with_sql(fit_sql()) + MERGES_SQL,
    "tokenizer_vocab_roundtrip": with_sql(fit_sql()) + "SELECT token, id::INT AS id, kind FROM vocab",
    "published_models": with_sql(fit_sql())
    + f"SELECT version, m.* FROM ({MERGES_SQL}) m JOIN (VALUES (0, {N_MERGES // 2}), (1, {N_MERGES})) v(version, size) ON rank < size",
    "load_or_train_config": with_sql(
        MARKED_SQL, "train_docs AS (SELECT * FROM marked WHERE split = 'train')", fit_sql("train_docs")
    )
    + MERGES_SQL,
    "load_or_train": with_sql(fit_sql()) + "SELECT token, id::INT AS id, kind FROM vocab",
}
