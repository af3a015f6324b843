"""Next-token count model: fit, held-out scoring, generation for a prompt table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import scores
from textloom.functions.arrays import crop_context, shift_labels, truncate
from textloom.operators.bpe import PAD, UNK
from textloom.operators.split import DEFAULT_SEED
from textloom.plans.lookup import fits_broadcast, lookup_join
from textloom.plans.ordering import unit_hash
from textloom.plans.storage import discard, materialise

# Steps of a generation between two writes of the prompt table.
STEPS_PER_WRITE = 16


def weighted_pairs(ids: Column, max_length: int | None = None) -> Column:
    """(input_id, label, w) structs of a whole row, or of one truncated and padded to ``max_length``.

    Every id is paired with the next one, the last one with the pad id. The (pad, pad) pairs of one row are a single entry with their number as
    weight, so padding does not multiply the rows to count.
    """
    cut = ids if max_length is None else truncate(ids, max_length)
    n = F.size(cut)
    real = F.zip_with(
        cut,
        shift_labels(cut, PAD),
        lambda x, y: F.struct(x.alias("input_id"), y.alias("label"), F.lit(1).cast("bigint").alias("w")),
    )
    # an empty row has labels of one pad but no id to pair it with
    pairs = F.when(n > 0, real).otherwise(F.slice(real, 1, 0))
    if max_length is None:
        return pairs
    pads = F.struct(
        F.lit(PAD).alias("input_id"), F.lit(PAD).alias("label"), (max_length - n).cast("bigint").alias("w")
    )
    return F.when(n < max_length, F.concat(pairs, F.array(pads))).otherwise(pairs)


def pair_rows(
    encoded: DataFrame, keys: list[str], ids_col: str = "ids", max_length: int | None = None
) -> DataFrame:
    return encoded.select(*keys, F.inline(weighted_pairs(F.col(ids_col), max_length)))


def fit_counts(encoded: DataFrame, ids_col: str = "ids", max_length: int | None = None) -> DataFrame:
    """(input_id, label, n): at most vocabulary size squared rows."""
    return pair_rows(encoded, [], ids_col, max_length).groupBy("input_id", "label").agg(F.sum("w").alias("n"))


def score_pairs(pairs: DataFrame, counts: DataFrame, vocab_size: int, keys: list[str]) -> DataFrame:
    """Pairs (keys, input_id, label, w) with ``loss`` under add-one smoothing.

    ``counts`` must be a written table. Without ``keys`` the pairs are summed, each is there once.
    """
    # one row per input id, so bounded by the vocabulary
    totals = counts.groupBy("input_id").agg(F.sum("n").alias("total"))
    joined = lookup_join(pairs, counts, ["input_id", "label"], salt_by=[*keys, "input_id", "label"] if keys else [], how="left")
    joined = joined.join(F.broadcast(totals), "input_id", "left")
    seen = F.coalesce(F.col("n"), F.lit(0)) + 1
    total = F.coalesce(F.col("total"), F.lit(0)) + vocab_size
    return joined.withColumn("loss", -F.log(seen / total))


def _weighted_mean() -> list[Column]:
    loss = F.sum(F.col("loss") * F.col("w")) / F.sum("w")
    return [F.sum("w").alias("n_pairs"), loss.alias("loss")]


def heldout_by_document(
    encoded: DataFrame,
    counts: DataFrame,
    vocab_size: int,
    key: str,
    ids_col: str = "ids",
    max_length: int | None = None,
) -> DataFrame:
    """Mean loss and perplexity of every document; equal pairs of a document are summed before the lookup."""
    pairs = pair_rows(encoded, [key], ids_col, max_length)
    pairs = pairs.groupBy(key, "input_id", "label").agg(F.sum("w").alias("w"))
    scored = score_pairs(pairs, counts, vocab_size, [key])
    return scored.groupBy(key).agg(*_weighted_mean()).withColumn("perplexity", F.exp("loss"))


def heldout_overall(
    encoded: DataFrame,
    counts: DataFrame,
    vocab_size: int,
    ids_col: str = "ids",
    max_length: int | None = None,
) -> DataFrame:
    """Mean loss and perplexity of all positions; pairs are summed before the lookup."""
    pairs = fit_counts(encoded, ids_col, max_length).withColumnRenamed("n", "w")
    scored = score_pairs(pairs, counts, vocab_size, [])
    return scored.agg(*_weighted_mean()).withColumn("perplexity", F.exp("loss"))


def successors(counts: DataFrame, top_k: int = 1, temperature: float = 1.0) -> DataFrame:
    """(input_id, next_ids, probs): what may follow an id and how likely.

    Scores are log counts over the labels seen after the id, at most a
    vocabulary of them. ``top_k`` = 1 keeps the single best label, the lowest id
    on ties; otherwise ties with the k-th best stay.
    """
    if top_k == 1:
        best = F.max_by(F.col("label"), F.struct(F.col("n"), -F.col("label")))
        return counts.groupBy("input_id").agg(best.alias("_b")).select(
            "input_id", F.array("_b").alias("next_ids"), F.array(F.lit(1.0)).alias("probs")
        )
    entries = F.array_sort(F.collect_list(F.struct("label", "n")))
    rows = counts.groupBy("input_id").agg(entries.alias("_e"))
    logits = F.transform(F.col("_e.n"), lambda n: F.log(n.cast("double")))
    masked = rows.select(
        "input_id",
        F.col("_e.label").alias("_labels"),
        scores.top_k_mask(scores.scale(logits, temperature), top_k).alias("_masked"),
    )
    scored = masked.select("input_id", F.arrays_zip("_labels", scores.softmax(F.col("_masked")).alias("_p")).alias("_z"))
    likely = scored.withColumn("_z", F.filter("_z", lambda e: e["_p"] > 0))
    return likely.select("input_id", F.col("_z._labels").alias("next_ids"), F.col("_z._p").alias("probs"))


def generate(
    prompts: DataFrame,
    following: DataFrame,
    keys: list[str],
    steps: int,
    max_context: int,
    seed: int = DEFAULT_SEED,
    ids_col: str = "ids",
) -> DataFrame:
    """Prompts with ``new_ids``: ``steps`` ids drawn one after another.

    Every prompt advances one id per step through a lookup of its last id;
    ``following`` (a written ``successors`` table) has one row per vocabulary
    entry. New ids are kept apart from the context, which is cropped to
    ``max_context``. There is no stop id. An id never seen before is followed
    by the unknown id.
    """
    table = following.withColumnRenamed("input_id", "_last")
    small = fits_broadcast(following)
    state = prompts.withColumn("_context", F.col(ids_col)).withColumn(
        "new_ids", F.array().cast("array<int>")
    )
    written = None
    for step in range(steps):
        if step and step % STEPS_PER_WRITE == 0:
            written, done = materialise(state, "generation"), written
            state = written
            if done is not None:
                discard(done)
        state = state.withColumn("_context", crop_context(F.col("_context"), max_context))
        state = state.withColumn("_last", F.try_element_at("_context", F.lit(-1)))
        state = lookup_join(state, table, ["_last"], salt_by=keys, how="left", small=small)
        place = scores.pick(F.col("probs"), unit_hash(f"{seed}:{step}", *keys))
        drawn = F.coalesce(F.get("next_ids", place), F.lit(UNK)).cast("int")
        state = (
            state.withColumn("_next", drawn)
            .withColumn("_context", F.concat("_context", F.array("_next")))
            .withColumn("new_ids", F.concat("new_ids", F.array("_next")))
            .drop("_last", "next_ids", "probs", "_next")
        )
    return state.drop("_context")
