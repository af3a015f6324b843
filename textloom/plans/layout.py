"""Task layout of scans, and of what goes to Python."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Give heavy per-row work at least one task per core.

    A large scan already has more splits than cores and is returned as it is;
    only a table stored in a few files or row groups is redistributed. ``scan``
    must be a plain scan (no shuffle in it).
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, *keys)


def bounded_batches(spark: SparkSession | None = None) -> None:
    """Hand texts to Python in batches of a few megabytes, unless the session sets a size of its own.

    The default of 64 MB is held several times over by either side of the pipe.
    Without ``spark`` it is the active session, the one that plans the query.
    """
    spark = spark or SparkSession.active()
    if spark.conf.get(_BATCH_BYTES) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_BYTES, str(2 << 20))


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_DEFAULT = "67108864b"
