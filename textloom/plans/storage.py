"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``.

Long lineages are cut by writing a Parquet table rather than by caching: the
table survives lost executors, can be column-pruned when read back, and its
size is known to the optimizer.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CHECKPOINT_CONF = "spark.checkpoint.dir"

# Local mode without the setting: one folder per application.
_own_dirs: dict[str, str] = {}


def named_dir(spark: SparkSession) -> str | None:
    """The folder the session names, if any."""
    return spark.conf.get(_CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(_CHECKPOINT_CONF)


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, visible to every executor."""
    named = named_dir(spark)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_CONF} to a folder that all executors can reach")
    if context.applicationId not in _own_dirs:
        _own_dirs[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="textloom-")
    return _own_dirs[context.applicationId]


def app_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_dir(spark)}/textloom/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path that no other call will be given."""
    return f"{app_dir(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Drop all intermediate tables of this application. Frames that read them end here."""
    fs, path = _hadoop_path(spark, app_dir(spark))
    fs.delete(path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and continue from the written table."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.scratch = path
    return written


def discard(written: DataFrame) -> None:
    """Delete the table behind a ``materialise`` result that nothing reads any more."""
    fs, path = _hadoop_path(written.sparkSession, written.scratch)
    fs.delete(path, True)


def _hadoop_path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = _hadoop_path(spark, path)
    return fs.exists(jvm_path)


def matching_names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the files that match a path pattern, hidden ones included."""
    fs, path = _hadoop_path(spark, pattern)
    return sorted(s.getPath().getName() for s in fs.globStatus(path) or [] if s.isFile())


def any_file(spark: SparkSession, pattern: str) -> bool:
    """Whether a file matches a path pattern; only the answer leaves the JVM."""
    fs, path = _hadoop_path(spark, pattern)
    return len(fs.globStatus(path) or []) > 0


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless there is one; of several writers exactly one gets True.

    On a local or mounted file system the finished file is linked to its name;
    elsewhere the store has to refuse to create a file twice, as HDFS does.
    """
    fs, target = _hadoop_path(spark, path)
    fs.mkdirs(target.getParent())
    if fs.getScheme() == "file":
        local = target.toUri().getPath()
        written = os.path.join(os.path.dirname(local), f".{uuid.uuid4().hex}")
        with open(written, "w", encoding="utf-8") as file:
            file.write(text)
        try:
            os.link(written, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(written)
        return True
    try:
        stream = fs.create(target, False)
    except Py4JJavaError as error:
        if fs.exists(target):
            return False
        raise error
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def read_lines(spark: SparkSession, path: str) -> list[str]:
    """Lines of one small text file, or of the files of a directory, whatever their names; none if there is neither."""
    fs, jvm_path = _hadoop_path(spark, path)
    if not fs.exists(jvm_path):
        return []
    lines: list[str] = []
    for status in fs.listStatus(jvm_path):
        name = status.getPath().getName()
        if not status.isFile() or (name.endswith(".crc") or name == "_SUCCESS") and fs.getFileStatus(jvm_path).isDirectory():
            continue
        stream = fs.open(status.getPath())
        try:
            lines += spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
        finally:
            stream.close()
    return lines


def line_table(spark: SparkSession, path: str) -> DataFrame:
    """(line): what ``read_lines`` gives, without the lines passing through the driver."""
    fs, jvm_path = _hadoop_path(spark, path)
    directory = fs.getFileStatus(jvm_path).isDirectory()
    files = [s.getPath() for s in fs.listStatus(jvm_path) if s.isFile()]
    # Spark's readers pass over hidden files and take some characters for a pattern
    plain = [f.toString() for f in files if not f.getName().startswith(("_", ".")) and not re.search(r"[*?\[\]{}\\]", f.toString())]
    known = set(plain)
    rest = [f for f in files if f.toString() not in known]
    skipped = [f for f in rest if directory and (f.getName().endswith(".crc") or f.getName() == "_SUCCESS")]
    lines = [line for f in rest if f not in skipped for line in read_lines(spark, f.toString())]
    table = spark.createDataFrame([(line,) for line in lines], "line string")
    if plain:
        # str.splitlines ends a line at these characters too
        parts = F.explode(F.split("value", "[\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]"))
        table = table.union(spark.read.text(plain).select(parts.alias("line")))
    return table


def bytes_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all below a directory; none if there is neither."""
    fs, jvm_path = _hadoop_path(spark, path)
    return fs.getContentSummary(jvm_path).getLength() if fs.exists(jvm_path) else 0


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path`` in sorted order, hidden ones left out."""
    fs, jvm_path = _hadoop_path(spark, path)
    names = (status.getPath().getName() for status in fs.listStatus(jvm_path))
    return sorted(n for n in names if not n.startswith(("_", ".")))


def is_written(spark: SparkSession, path: str) -> bool:
    """True once a Spark write to ``path`` has been committed."""
    return exists(spark, f"{path}/_SUCCESS")
