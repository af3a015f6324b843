"""Scores in long form, (keys, token_id, logit): a row per candidate, for vocabularies too wide for an array.

Sums of exponentials are taken in chunks of a position's candidates and then
merged, each chunk with its own maximum, so that no task holds a position and
nothing overflows. Only candidates that survive a top-k cut of their chunk meet
those of other chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.plans.lookup import lookup_join
from textloom.plans.storage import materialise

# Chunks that the candidates of one position are dealt to by their ids.
CHUNKS = 16


def _chunk(chunks: int) -> Column:
    return F.pmod(F.xxhash64("token_id"), F.lit(chunks)).cast("int")


def _scaled(peak: Column) -> Column:
    return F.sum(F.exp(F.col("logit") - peak))


def log_sum_exp(scores: DataFrame, keys: list[str], chunks: int = CHUNKS) -> DataFrame:
    """(keys, peak, total): the greatest logit and the sum of exp(logit - peak) of every position.

    A chunk's sum is relative to its own greatest logit and is rescaled when
    chunks are merged; both aggregations are combined on the map side.
    """
    dealt = scores.where(F.col("logit").isNotNull()).withColumn("_chunk", _chunk(chunks))
    peaks = dealt.groupBy(*keys, "_chunk").agg(F.max("logit").alias("_peak"))
    # one row per position and chunk
    parts = dealt.join(peaks, [*keys, "_chunk"]).groupBy(*keys, "_chunk").agg(
        F.first("_peak").alias("_peak"), _scaled(F.col("_peak")).alias("_sum")
    )
    merged = parts.groupBy(*keys).agg(F.max("_peak").alias("peak"), F.collect_list(F.struct("_peak", "_sum")).alias("_parts"))
    sums = F.zip_with(
        "_parts", F.array_repeat(F.col("peak"), F.size("_parts")), lambda p, top: p["_sum"] * F.exp(p["_peak"] - top)
    )
    return merged.select(*keys, "peak", F.aggregate(F.array_sort(sums), F.lit(0.0), lambda a, x: a + x).alias("total"))


def cross_entropy(scores: DataFrame, targets: DataFrame, keys: list[str], chunks: int = CHUNKS) -> DataFrame:
    """(keys, loss) of every position of ``targets`` (keys, target): log-sum-exp minus the logit of the target.

    A position whose target has no logit has a null loss.
    """
    wanted = scores.join(targets.select(*keys, F.col("target").alias("token_id")), [*keys, "token_id"]).select(
        *keys, F.col("logit").alias("_own")
    )
    norm = log_sum_exp(scores, keys, chunks)
    found = targets.select(*keys).join(norm, keys, "left").join(wanted, keys, "left")
    return found.select(*keys, (F.col("peak") + F.log("total") - F.col("_own")).alias("loss"))


def top_k(scores: DataFrame, keys: list[str], k: int, chunks: int = CHUNKS) -> DataFrame:
    """Rows whose logit is at least the k-th greatest of their position; ties with it stay, ``k <= 0`` keeps all.

    A row below the k-th of its own chunk is below the k-th of all, so chunks
    are cut before their rows meet; what meets is about ``chunks * k`` rows and their ties.
    """
    live = scores.where(F.col("logit").isNotNull())
    if k <= 0:
        return live
    # ties beyond the k-th all have its logit: ranks over distinct logits would keep too much, so cuts are by value
    cuts = _kth(live.withColumn("_chunk", _chunk(chunks)), [*keys, "_chunk"], k)
    kept = live.withColumn("_chunk", _chunk(chunks)).join(cuts, [*keys, "_chunk"]).where(F.col("logit") >= F.col("_cut"))
    rows = materialise(kept.drop("_chunk", "_cut"), "top-k")
    final = materialise(_kth(rows, keys, k), "top-k-cuts")
    return lookup_join(rows, final, keys, salt_by=["token_id"]).where(F.col("logit") >= F.col("_cut")).drop("_cut")


def _kth(rows: DataFrame, group: list[str], k: int) -> DataFrame:
    """(group, _cut): the k-th greatest logit of each group, or its least if there are fewer.

    Equal logits are counted first, so a group of many ties is few rows.
    """
    counted = rows.groupBy(*group, "logit").agg(F.count("*").alias("_n"))
    down = Window.partitionBy(*group).orderBy(F.desc("logit")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.withColumn("_above", F.coalesce(F.sum("_n").over(down), F.lit(0)))
    return ranked.where(F.col("_above") < k).groupBy(*group).agg(F.min("logit").alias("_cut"))


def softmax(scores: DataFrame, keys: list[str], temperature: float = 1.0, chunks: int = CHUNKS) -> DataFrame:
    """Rows with ``p``: their share of the exponentials of the position, at a temperature."""
    scaled = scores.withColumn("logit", F.col("logit") / F.lit(float(temperature)))
    norm = materialise(log_sum_exp(scaled, keys, chunks), "softmax-norm")
    joined = lookup_join(scaled.where(F.col("logit").isNotNull()), norm, keys, salt_by=["token_id"])
    return joined.withColumn("p", F.exp(F.col("logit") - F.col("peak")) / F.col("total")).drop("peak", "total")


def greedy(scores: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, token_id) with the greatest logit, the least id on ties."""
    best = F.max_by(F.col("token_id"), F.struct(F.col("logit"), -F.col("token_id")))
    return scores.where(F.col("logit").isNotNull()).groupBy(*keys).agg(best.alias("token_id"))
