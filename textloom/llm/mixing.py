"""Temperature mixing of sources.

Source token shares are raised to an exponent and normalised; the exponent is
bisected until the weights meet a target entropy or a repetition limit. The
budget is the smallest at which every source gets at least one whole pass, so
nothing is lost: small sources are repeated, none is cut. Each pass over a
source is a permutation of its own, the last one is cut where the budget ends,
and every source is dealt evenly over the blocks of the mixture.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import fresh, placed, running_sum, words
from textloom.plans.storage import materialise

SEED = 7
BLOCK_TOKENS = 1 << 20
# Six bisection steps are evaluated by one job, as their 63 possible midpoints.
STEPS_PER_JOB = 6
JOBS = 6
PLACES = 6


@dataclass(frozen=True)
class Target:
    """Exactly one of: the entropy of the weights as a share of its maximum, or
    how often the most repeated source may be seen."""

    entropy: float | None = None
    repeats: float | None = None


TARGET = Target(repeats=2.0)


def token_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.size(words(text)).cast("long")


def shares(rows: DataFrame) -> DataFrame:
    """(source, tokens) of rows (source, tokens); a null source is one of its own."""
    return rows.groupBy("source").agg(F.sum("tokens").alias("tokens"))


def _measure(target: Target, exponent: float) -> Column:
    """What the target limits, as an aggregate over sources with ``x`` = tokens / largest."""
    x = F.col("x")
    if target.repeats is not None:
        return F.max(F.pow(x, F.lit(exponent - 1.0)))
    z = F.sum(F.pow(x, F.lit(exponent)))
    return (F.log(z) - F.lit(exponent) * F.sum(F.pow(x, F.lit(exponent)) * F.log(x)) / z) / F.log(F.count("*"))


def exponent(sources: DataFrame, target: Target = TARGET) -> float:
    """The exponent in [0, 1] that meets the target, to PLACES decimals.

    Lower exponents flatten: entropy and repetition both fall as the exponent
    rises. 0 if even equal weights stay within a repetition limit, 1 if the
    shares as they are have the target entropy or more.
    """
    used = sources.where("tokens > 0")
    largest = used.agg(F.max("tokens"), F.count("*")).first()
    if not largest[1] or largest[1] == 1:
        return 1.0
    scaled = used.select((F.col("tokens") / F.lit(largest[0])).alias("x"))
    want = target.repeats if target.repeats is not None else target.entropy
    lo, hi = 0.0, 1.0
    n = 1 << STEPS_PER_JOB
    for _ in range(JOBS):
        points = [lo + (hi - lo) * i / n for i in range(n + 1)]
        values = scaled.agg(*[_measure(target, p).alias(f"m{i}") for i, p in enumerate(points)]).first()
        # the measure falls with the exponent: the last point still at or above the target
        above = [i for i, v in enumerate(values) if v >= want]
        if not above:
            return 0.0 if lo == 0.0 else round(lo, PLACES)
        if above[-1] == n:
            return round(hi, PLACES)
        lo, hi = points[above[-1]], points[above[-1] + 1]
    return round(hi if target.repeats is not None else lo, PLACES)


def budgets(sources: DataFrame, power: float) -> DataFrame:
    """(source, tokens, budget): weights times the smallest budget with one pass for each source."""
    largest = sources.agg(F.max("tokens")).first()[0] or 0
    ratio = F.pow(F.lit(float(largest)) / F.col("tokens"), F.lit(1.0 - power))
    budget = F.floor(F.col("tokens") * ratio + 0.5).cast("long")
    return sources.withColumn("budget", F.when(F.col("tokens") > 0, budget).otherwise(0))


def _key(turn: Column, ident: Column) -> Column:
    """Place of a document in a pass of its source."""
    return F.md5(F.concat_ws(":", F.lit(str(SEED)), turn.cast("string"), ident.cast("string")))


def _passes(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """A row per document and pass that the budget reaches: at most the repetition limit, rounded up."""
    renamed = plan.select(F.col("source").alias("_s"), F.col("tokens").alias("total"), "budget")
    joined = rows.join(renamed, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    last = F.when(F.col("total") > 0, F.call_function("div", F.col("budget") - 1, F.col("total"))).otherwise(0)
    return joined.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(last, F.lit(0)))))


def schedule(docs: DataFrame, target: Target = TARGET, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """(copies, plan) of rows (doc_id, source, tokens).

    Copies: doc_id, source, tokens, pass, start and block. ``start`` counts the
    source's tokens dealt before this copy, over all passes. The first pass is
    always whole, also for sources without a token.
    """
    rows = materialise(docs.select("doc_id", "source", "tokens"), "mix-rows")
    sources = materialise(shares(rows), "mix-sources")
    plan = materialise(budgets(sources, exponent(sources, target)), "mix-plan")
    n_blocks = max(1, (plan.agg(F.sum("budget")).first()[0] or 0) // block_tokens)
    keyed = _passes(rows, plan).withColumn("key", _key(F.col("pass"), F.col("doc_id")))
    order = ["source", "pass", "key", "doc_id", "tokens"]
    summed = running_sum(placed(keyed, order, "mix-order"), ["source", "pass"], "tokens", "_prior")
    start = F.col("pass") * F.col("total") + F.col("_prior")
    dealt = summed.withColumn("start", start).where((F.col("pass") == 0) | (F.col("start") < F.col("budget")))
    block = F.expr(f"cast(start as decimal(38, 0)) * {n_blocks} div greatest(budget, 1)").cast("long")
    return dealt.withColumn("block", F.least(block, F.lit(n_blocks - 1))), plan


def mix(docs: DataFrame, target: Target = TARGET, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with a row for every copy the mixture takes, columns unchanged.

    Texts do not move: a copy is decided by the pass and by comparing the
    document's key with the last one its source's budget reaches. Null ids share
    a key; null sources are one source; null texts have no tokens and stay once.
    """
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), token_count(F.col(text_col)).alias("tokens")
    )
    copies, plan = schedule(narrow, target)
    cuts = copies.where("pass > 0").groupBy("source", "pass").agg(F.max("key").alias("cut"))
    table = (
        plan.select(F.col("source").alias("_s"))
        .join(cuts.groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("pass", "cut"))).alias("_cuts")),
              F.col("_s").eqNullSafe(F.col("source")), "left")
        .select("_s", "_cuts")
    )
    table = materialise(table, "mix-cuts")
    cut_name, s_name = fresh(docs, "_cuts"), fresh(docs, "_s")
    joined = docs.join(table.select(F.col("_s").alias(s_name), F.col("_cuts").alias(cut_name)),
                       F.col(source_col).eqNullSafe(F.col(s_name)), "left")
    reached = F.filter(
        F.map_entries(cut_name), lambda e: _key(e["key"], F.col(id_col)) <= e["value"]
    )
    n = F.when(F.col(cut_name).isNull(), 1).otherwise(1 + F.size(reached))
    copy = fresh(docs, "_copy")
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), n))).select(*[F.col(f"`{c}`") for c in docs.columns])
