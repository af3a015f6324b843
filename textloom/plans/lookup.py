"""Equi-joins against a lookup side whose size is checked first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.plans.storage import materialise

# Bytes of lookup data worth broadcasting.
BROADCAST_BYTES = 32 << 20
SALTS = 32

# A key of more facts than this, and than its even share among HOT_KEYS keys, is hot.
HOT_FACTS = 4_096
HOT_KEYS = 10_000


def _width(field: T.StructField) -> Column:
    """Bytes that a value takes in memory, about."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8
    if isinstance(field.dataType, T.ArrayType):
        if isinstance(field.dataType.elementType, T.StringType):
            return F.coalesce(F.octet_length(F.array_join(value, "")) + 8 * F.size(value), F.lit(8))
        return F.coalesce(8 * F.size(value), F.lit(0)) + 8
    return F.lit(8)


def fits_broadcast(lookup: DataFrame) -> bool:
    """Whether ``lookup``, a written table, takes few enough bytes to broadcast; strings and arrays count in full."""
    row = F.lit(0)
    for field in lookup.schema.fields:
        row = row + _width(field)
    return (lookup.agg(F.sum(row.cast("bigint"))).first()[0] or 0) <= BROADCAST_BYTES


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    salt_by: list[str],
    how: str = "inner",
    small: bool | None = None,
) -> DataFrame:
    """Join ``facts`` to ``lookup`` (unique on ``on``) without a hot-key task.

    A lookup side that ``fits_broadcast`` is broadcast (pass the answer as
    ``small`` when joining to the same table repeatedly). Beyond that each fact
    gets a salt hashed from ``salt_by`` and the lookup side is repeated once per
    salt, which spreads one key over SALTS tasks. Without ``salt_by`` the facts
    are unique on ``on`` too, so no key is hot and nothing is repeated.
    """
    if fits_broadcast(lookup) if small is None else small:
        return facts.join(F.broadcast(lookup), on, how)
    if not salt_by:
        return facts.join(lookup, on, how)
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(SALTS)).cast("int"))
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def spread_join(facts: DataFrame, lookup: DataFrame, key: str, salt_by: list[str], how: str = "inner") -> DataFrame:
    """Join ``facts``, a written table, to ``lookup`` (unique on ``key``), however many facts a key has.

    Facts are counted per key first. Hot keys, fewer than HOT_KEYS by their
    definition, are told to all tasks with a number of parts; their facts are
    dealt to parts by ``salt_by``, and only their lookup rows are repeated.
    Neither side is broadcast, and without hot keys it is a plain join.
    """
    counts = facts.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_n"))
    most = max(HOT_FACTS, facts.count() // HOT_KEYS)
    parts = F.ceil(F.col("_n") / most).cast("int").alias("_parts")
    hot = materialise(counts.where((F.col("_n") > most) & F.col("_hot").isNotNull()).select("_hot", parts), "hot-keys")
    if not hot.limit(1).count():
        return facts.join(lookup, key, how)

    def marked(side: DataFrame) -> DataFrame:
        return side.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").drop("_hot")

    many = F.coalesce("_parts", F.lit(1))
    dealt = marked(facts).withColumn("_part", F.pmod(F.xxhash64(*salt_by), many).cast("int")).drop("_parts")
    repeated = marked(lookup).withColumn("_part", F.explode(F.sequence(F.lit(0), many - 1))).drop("_parts")
    return dealt.join(repeated, [key, "_part"], how).drop("_part")
