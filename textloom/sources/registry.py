"""Published versions of an artifact: written under a fresh name, then numbered by a pointer.

``root/files`` holds artifacts nobody overwrites; ``root/versions`` holds one
small file per version, created only if it is absent, whose text names the
artifact. Writers that publish at the same time get different numbers, and a
reader sees a whole version or the one before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textloom.plans.storage import create_once, exists, matching_names, read_lines

LATEST = "latest"
# Digits of a version in its pointer's name, so that names sort like numbers.
DIGITS = 10


def _pointer(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/versions/{version:0{DIGITS}d}"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers taken so far, ascending; a number is taken before its pointer can be read."""
    return sorted(int(n) for n in matching_names(spark, f"{root.rstrip('/')}/versions/{'[0-9]' * DIGITS}"))


def _target(spark: SparkSession, root: str, version: int) -> str | None:
    """Where a version lies; none while its pointer is missing or being written."""
    lines = read_lines(spark, _pointer(root, version))
    # the second line closes the pointer
    return f"{root.rstrip('/')}/files/{lines[0]}" if len(lines) == 2 and lines[1] == "." else None


def publish(spark: SparkSession, root: str, write: Callable[[str], None]) -> int:
    """Have ``write`` fill a fresh folder, then publish it as the next version and return its number."""
    name = uuid.uuid4().hex
    write(f"{root.rstrip('/')}/files/{name}")
    taken = _numbers(spark, root)
    version = taken[-1] + 1 if taken else 0
    # another writer may take the number first
    while not create_once(spark, _pointer(root, version), f"{name}\n.\n"):
        version += 1
    return version


def resolve(spark: SparkSession, root: str, version: int | str = LATEST) -> str:
    """The folder of a version, or of the latest one that can be read."""
    if version != LATEST:
        found = _target(spark, root, int(version))
        if found is None:
            raise ValueError(f"no version {version} in {root}")
        return found
    for number in reversed(_numbers(spark, root)):
        found = _target(spark, root, number)
        if found is not None:
            return found
    raise ValueError(f"nothing is published in {root}")


def is_published(spark: SparkSession, root: str) -> bool:
    return exists(spark, root) and any(_target(spark, root, n) is not None for n in reversed(_numbers(spark, root)))


def versions(spark: SparkSession, root: str) -> DataFrame:
    """(version, path) of everything published."""
    found = [(n, _target(spark, root, n)) for n in _numbers(spark, root)]
    return spark.createDataFrame([f for f in found if f[1]], "version int, path string")
