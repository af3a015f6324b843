"""Corpus files in one directory, and listings of files."""

from __future__ import annotations

import fnmatch
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.plans.lookup import lookup_join
from textloom.plans.ordering import running_total
from textloom.plans.storage import any_file, exists, matching_names, materialise

# Reader and options for a file type; a type not listed is used as the reader's name.
READERS = {
    "txt": ("text", {}),
    "json": ("json", {}),
    "jsonl": ("json", {}),
    "csv": ("csv", {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "inferSchema": "true"}),
    "parquet": ("parquet", {}),
}

ORDER_COLUMNS = ("_file", "_block", "_line")

_MIN_SPLITS = "spark.sql.files.minPartitionNum"


def scan(
    spark: SparkSession,
    data_dir: str,
    filetype: str,
    schema: str | None = None,
    keep_order: bool = False,
    **options: str,
) -> DataFrame:
    """All ``*.{filetype}`` files directly in ``data_dir`` as one table.

    ``keep_order`` adds columns that sort the rows as they stand: by file path,
    then by place in the file. A given ``schema`` saves the inference pass,
    which for CSV and JSON reads the data once more; a CSV column ``text`` is a
    string whatever is inferred. ``options`` go to the reader, for instance
    multiLine=false for CSV without line breaks in quotes, which splits large
    files. Spark's readers pass over names that begin with '_' or '.', so a
    directory that has such files of this type is refused.
    """
    if not exists(spark, data_dir):
        raise ValueError(f"no such directory: {data_dir}")
    place = data_dir.rstrip("/")
    if not any_file(spark, f"{place}/*.{filetype}"):
        raise ValueError(f"no *.{filetype} files in {data_dir}")
    hidden = matching_names(spark, f"{place}/[_.]*.{filetype}")
    if hidden:
        raise ValueError(f"files in {data_dir} that a scan would pass over, rename them: {', '.join(hidden[:20])}")
    reader, preset = READERS.get(filetype, (filetype, {}))
    source = spark.read.format(reader).options(**{**preset, **options}).option("pathGlobFilter", f"*.{filetype}")
    source = source.option("recursiveFileLookup", "false")
    if schema:
        source = source.schema(schema)
    elif reader == "csv":
        inferred = source.load(place).schema
        as_text = [T.StructField(f.name, T.StringType() if f.name == "text" else f.dataType) for f in inferred]
        source = source.schema(T.StructType(as_text))
    df = source.load(place)
    if filetype == "txt":
        df = df.withColumnRenamed("value", "text")
    return with_file_order(df, indexed=reader == "parquet") if keep_order else df


def with_file_order(scanned: DataFrame, indexed: bool = False) -> DataFrame:
    """A file scan with the ORDER_COLUMNS: file, start of the split, counter within the split.

    ``indexed`` scans (Parquet) know each row's place in its file, whatever
    splits it is read in; there the split's start is 0.
    """
    file = F.col("_metadata.file_path")
    if indexed:
        values = (file, F.lit(0).cast("bigint"), F.col("_metadata.row_index"))
    else:
        values = (file, F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return scanned.select("*", *[v.alias(name) for v, name in zip(values, ORDER_COLUMNS)])


_MOVED = "rows do not stand where they were counted: files or split settings changed; number them with frozen=True"


def number_rows(ordered: DataFrame, id_col: str = "row_id", frozen: bool = False) -> DataFrame:
    """A scan with order columns, numbered from 0 in file order instead."""
    return numbered(ordered, id_col, frozen)[0]


def numbered(ordered: DataFrame, id_col: str = "row_id", frozen: bool = False) -> tuple[DataFrame, int]:
    """A scan with order columns, numbered from 0 in file order instead, and the number of rows.

    The scan is read twice and nothing of it is written or moved: first rows
    are counted per split, then a row's id is its split's first id plus its
    place in the split. Splits are those of the whole file for Parquet, whose
    ids do not depend on how it is read. Other files must be split alike both
    times, so the split settings are held fixed for the session
    (``spark.sql.files.minPartitionNum``, otherwise taken from the cores at
    hand); a row outside the places counted fails the query. ``frozen`` writes the table
    instead and numbers what was written, for a reader that drops rows
    depending on the columns asked for (CSV and JSON with mode DROPMALFORMED).
    """
    spark = ordered.sparkSession
    if frozen:
        ordered = materialise(ordered, "scan")
    elif spark.conf.get(_MIN_SPLITS, None) is None:
        spark.conf.set(_MIN_SPLITS, str(spark.sparkContext.defaultParallelism))
    file, block, line = ORDER_COLUMNS
    splits = ordered.groupBy(file, block).agg(F.min(line).alias("_first"), F.count("*").alias("_n"))
    totals = running_total(splits, [file, block], "_n", carry=["_first", "_n"])
    starts = materialise(totals, "splits")
    met = lookup_join(ordered, starts, [file, block], salt_by=[line], how="left")
    place = F.col(line) - F.col("_first")
    stands = (place >= 0) & (place < F.col("_n"))
    row_id = F.when(stands, F.col("_before") + place).otherwise(F.raise_error(F.lit(_MOVED)).cast("bigint"))
    rows = starts.agg(F.sum("_n")).first()[0] or 0
    return met.withColumn(id_col, row_id).drop(*ORDER_COLUMNS, "_first", "_n", "_before"), rows


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, length, modified) of every file below ``root``, hidden ones included; contents are not read.

    Directories are listed level by level in tasks, so only the depth of the
    tree decides how many rounds there are. ``path`` is relative to ``root``.
    """
    found = None
    level = spark.createDataFrame([("",)], "path string")
    while True:
        rows = level.repartition("path").mapInArrow(_lister(root), _LISTED)
        entries = materialise(rows, "listing")
        files = entries.where("NOT is_dir")
        found = files if found is None else found.union(files)
        level = entries.where("is_dir").select("path")
        if not level.limit(1).count():
            break
    named = found.select("path", "length", "modified")
    if glob is None:
        return named
    return named.where(F.regexp_extract("path", "[^/]*$", 0).rlike(fnmatch.translate(glob).replace("\\Z", "$").replace("\\z", "$")))


_LISTED = "path string, is_dir boolean, length long, modified timestamp"


def _lister(root: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = pafs.FileSystem.from_uri(root if ":" in root.split("/")[0] else f"file://{root}")
        base = base.rstrip("/")
        for batch in batches:
            for directory in batch.column(0).to_pylist():
                listed = system.get_file_info(pafs.FileSelector(f"{base}/{directory}".rstrip("/")))
                below = [f"{directory}/{f.base_name}".lstrip("/") for f in listed]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(below, pa.string()),
                        pa.array([f.type == pafs.FileType.Directory for f in listed], pa.bool_()),
                        pa.array([f.size or 0 for f in listed], pa.int64()),
                        pa.array([f.mtime for f in listed], pa.timestamp("us", "UTC")),
                    ],
                    ["path", "is_dir", "length", "modified"],
                )

    return entries


def sorted_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    return list_files(spark, root, glob).orderBy("path")
