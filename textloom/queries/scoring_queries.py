"""Score arrays, count model, generation.

``embeddings`` stands in for score rows: 64 scores, the place of a score is the
token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import arrays, scores
from textloom.operators import generation as G
from textloom.operators import score_tables as T
from textloom.operators import scoring as S
from textloom.operators.bpe import BpeModel, encode
from textloom.plans.ordering import unit_hash
from textloom.plans.storage import materialise
from textloom.queries.common import (
    MARKED_SQL,
    encode_sql,
    encoded,
    encoded_split,
    fit_sql,
    full_encode_sql,
    full_fit_sql,
    full_tokenizer,
    joined,
    rounded,
    table,
    tokenizer,
    with_recursive_sql,
    with_sql,
)

TEMPERATURE = 0.7
TOP_K = 5
STEPS = 4
CONTEXT = 256
# Fixed value: ids generated for a prompt by default.
LONG_STEPS = 100


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = scores.scale(scores.as_scores(F.col("embedding")), TEMPERATURE)
    return table(spark, sf_dir, "embeddings").select("vec_id", z.alias("z"))


def _tokens(df: DataFrame, values: Column, name: str) -> DataFrame:
    return df.select("vec_id", F.posexplode(values).alias("token_id", name))


def topk_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _tokens(_scores(spark, sf_dir), scores.top_k_mask(F.col("z"), TOP_K), "z")
    return kept.where(F.col("z").isNotNull()).select("vec_id", "token_id", rounded("z"))


def _probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = _scores(spark, sf_dir).select("vec_id", scores.top_k_mask(F.col("z"), TOP_K).alias("z"))
    return masked.select("vec_id", scores.softmax(F.col("z")).alias("p"))


def topk_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _tokens(_probabilities(spark, sf_dir), F.col("p"), "p")
    return kept.where(F.col("p") > 0).select("vec_id", "token_id", rounded("p"))


def sample_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = scores.pick(F.col("p"), unit_hash("42:0", "vec_id"))
    return _probabilities(spark, sf_dir).select("vec_id", token.alias("token_id"))


def greedy_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select("vec_id", scores.greedy(F.col("z")).alias("token_id"))


def _long_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, token_id, logit): the scores as a row per candidate."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("token_id", "logit"))
    return rows.withColumn("logit", F.col("logit").cast("double"))


def long_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("target"))
    return T.cross_entropy(_long_scores(spark, sf_dir), targets, ["vec_id"]).select("vec_id", rounded("loss"))


def long_topk_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = T.top_k(_long_scores(spark, sf_dir), ["vec_id"], TOP_K)
    return T.softmax(kept, ["vec_id"], TEMPERATURE).select("vec_id", "token_id", rounded("p"))


def long_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.greedy(_long_scores(spark, sf_dir), ["vec_id"])


def _counts(spark: SparkSession, sf_dir: str, model: BpeModel | None = None) -> DataFrame:
    train = encoded_split(spark, sf_dir, model).where(F.col("split") == "train")
    return materialise(S.fit_counts(train), "pair-model")


def bigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of neighbouring ids of the whole vocabulary."""
    train = encoded_split(spark, sf_dir, full_tokenizer(spark, sf_dir)).where(F.col("split") == "train")
    return S.fit_counts(train)


def _validation(spark: SparkSession, sf_dir: str, model: BpeModel | None = None) -> DataFrame:
    return encoded_split(spark, sf_dir, model).where(F.col("split") == "validation")


def heldout_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = tokenizer(spark, sf_dir).vocab_size
    scored = S.heldout_by_document(_validation(spark, sf_dir), _counts(spark, sf_dir), size, "doc_id")
    return scored.select("doc_id", "n_pairs", rounded("loss"), rounded("perplexity"))


def heldout_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss and perplexity of the validation split by the whole vocabulary."""
    model = full_tokenizer(spark, sf_dir)
    scored = S.heldout_overall(_validation(spark, sf_dir, model), _counts(spark, sf_dir, model), model.vocab_size)
    return scored.select("n_pairs", rounded("loss"), rounded("perplexity"))


def _generated(
    spark: SparkSession, sf_dir: str, prompts: DataFrame, keys: list[str], top_k: int = 1, temperature: float = 1.0
) -> DataFrame:
    model = tokenizer(spark, sf_dir)
    following = materialise(S.successors(_counts(spark, sf_dir), top_k, temperature), "successors")
    ready = prompts.select(*keys, encode(model, F.col("text"), spark).alias("ids"))
    made = S.generate(ready, following, keys, STEPS, CONTEXT)
    return made.select(*keys, joined("new_ids").alias("new_ids"), model.decode(F.col("new_ids")).alias("output"))


def generate_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _generated(spark, sf_dir, table(spark, sf_dir, "conversations"), ["conv_id", "turn"])


def generate_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = table(spark, sf_dir, "conversations")
    return _generated(spark, sf_dir, prompts, ["conv_id", "turn"], TOP_K, TEMPERATURE)


def generate_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy walks of LONG_STEPS ids, by jumps on the vocabulary."""
    model = tokenizer(spark, sf_dir)
    best = materialise(S.successors(_counts(spark, sf_dir)), "successors")
    ready = table(spark, sf_dir, "conversations").select("conv_id", "turn", encode(model, F.col("text"), spark).alias("ids"))
    following = best.select("input_id", F.element_at("next_ids", 1).alias("next_id"))
    made = G.generate_greedy(ready, following, ["conv_id", "turn"], LONG_STEPS)
    return made.select("conv_id", "turn", joined("new_ids").alias("new_ids"), model.decode(F.col("new_ids")).alias("output"))


def _alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = _counts(spark, sf_dir).select("input_id", "label", F.col("n").alias("weight"))
    return materialise(G.alias_table(weighted), "alias")


def alias_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the alias columns give each label: its count times the number of columns."""
    return G.shares(_alias(spark, sf_dir))


def generate_sampled_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LONG_STEPS ids drawn from all labels seen after an id; SQL does not build alias columns."""
    model = tokenizer(spark, sf_dir)
    ready = table(spark, sf_dir, "conversations").select("conv_id", "turn", encode(model, F.col("text"), spark).alias("ids"))
    made = G.generate_sampled(ready, _alias(spark, sf_dir), ["conv_id", "turn"], LONG_STEPS)
    return made.select("conv_id", "turn", joined("new_ids").alias("new_ids"), model.decode(F.col("new_ids")).alias("output"))


def prompt_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark text as a prompt."""
    return _generated(spark, sf_dir, table(spark, sf_dir, "benchmark"), ["item_id"])


def context_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = arrays.crop_context(F.col("ids"), CONTEXT)
    return encoded(spark, sf_dir).select("doc_id", joined(ids).alias("ids"))


QUERIES = {
    "topk_filter": topk_filter,
    "topk_softmax": topk_softmax,
    "sample_token": sample_token,
    "greedy_token": greedy_token,
    "long_cross_entropy": long_cross_entropy,
    "long_topk_softmax": long_topk_softmax,
    "long_greedy": long_greedy,
    "bigram_counts": bigram_counts,
    "heldout_perplexity": heldout_perplexity,
    "heldout_overall": heldout_overall,
    "generate_batch": generate_batch,
    "generate_sampled": generate_sampled,
    "generate_long": generate_long,
    "alias_shares": alias_shares,
    "generate_sampled_alias": generate_sampled_alias,
    "context_crop": context_crop,
    "prompt_suite": prompt_suite,
}

_Z = f"""z AS (
  SELECT vec_id, (generate_subscripts(embedding, 1) - 1)::INT AS token_id, unnest(embedding)::DOUBLE / {TEMPERATURE} AS z
  FROM embeddings),
kept AS (
  SELECT vec_id, token_id, z FROM (SELECT *, rank() OVER (PARTITION BY vec_id ORDER BY z DESC) AS k FROM z)
  WHERE k <= {TOP_K}),
probs AS (
  SELECT vec_id, token_id, e / sum(e) OVER (PARTITION BY vec_id) AS p
  FROM (SELECT *, exp(z - max(z) OVER (PARTITION BY vec_id)) AS e FROM kept))"""

_PAIRS = """pairs AS MATERIALIZED (
  SELECT doc_id, split, unnest(ids) AS input_id, unnest(list_append(ids[2:], 1)) AS label
  FROM enc JOIN marked USING (doc_id) WHERE len(ids) > 0),
counts AS MATERIALIZED (
  SELECT input_id, label, count(*) AS n FROM pairs WHERE split = 'train' GROUP BY ALL)"""
_MODEL = with_sql(fit_sql(), encode_sql("documents", "doc_id"), MARKED_SQL, _PAIRS)
_FULL = [full_fit_sql(), full_encode_sql("documents", "doc_id"), MARKED_SQL, _PAIRS]
_HELDOUT = """heldout AS (
  SELECT doc_id, -ln((coalesce(n, 0) + 1) / (coalesce(total, 0) + (SELECT count(*) FROM vocab))) AS loss
  FROM pairs LEFT JOIN counts USING (input_id, label)
  LEFT JOIN (SELECT input_id, sum(n) AS total FROM counts GROUP BY 1) USING (input_id)
  WHERE split = 'validation')"""


_GREEDY = "succ AS MATERIALIZED (SELECT input_id, first(label ORDER BY n DESC, label) AS next_id FROM counts GROUP BY 1)"
_SAMPLED = f"""succ AS MATERIALIZED (
  SELECT input_id, label, sum(p) OVER (PARTITION BY input_id ORDER BY label ROWS UNBOUNDED PRECEDING) AS cum
  FROM (SELECT input_id, label, e / sum(e) OVER (PARTITION BY input_id) AS p
        FROM (SELECT *, exp(z - max(z) OVER (PARTITION BY input_id)) AS e
              FROM (SELECT input_id, label, ln(n) / {TEMPERATURE} AS z,
                           rank() OVER (PARTITION BY input_id ORDER BY n DESC) AS k FROM counts)
              WHERE k <= {TOP_K})))"""
_CONVERSATIONS = "prompts AS (SELECT conv_id * 1000 + turn AS k, conv_id, turn, text FROM conversations)"
_BENCHMARK = "prompts AS (SELECT item_id AS k, item_id, text FROM benchmark)"


def _greedy_step(i: int, before: str) -> str:
    return f"""g{i} AS MATERIALIZED (
  SELECT g.*, coalesce(s.next_id, 0) AS x{i} FROM g{i - 1} g LEFT JOIN succ s ON s.input_id = g.{before})"""


def _sampled_step(i: int, before: str) -> str:
    return f"""g{i} AS MATERIALIZED (
  SELECT g.*, coalesce(c.drawn, 0) AS x{i} FROM g{i - 1} g LEFT JOIN (
    SELECT k, coalesce(min(label) FILTER (round(cum, 12) > u), max(label)) AS drawn
    FROM (SELECT k, {before} AS input_id,
                 ('0x' || substr(md5('42:{i - 1}:' || conv_id || ':' || turn), 1, 8))::BIGINT / 4294967296 AS u
          FROM g{i - 1} JOIN prompts USING (k)) JOIN succ USING (input_id) GROUP BY k) c USING (k))"""


def _generate_sql(prompts: str, out: str, following: str, one_step) -> str:
    numbers = range(1, STEPS + 1)
    steps = [one_step(i, "last" if i == 1 else f"x{i - 1}") for i in numbers]
    ids = " || ' ' || ".join(f"x{i}" for i in numbers)
    tokens = ", ".join(f"(SELECT CASE WHEN kind = 'special' THEN '' ELSE token END FROM vocab WHERE id = x{i})" for i in numbers)
    return (
        with_sql(
            fit_sql(),
            encode_sql("documents", "doc_id"),
            MARKED_SQL,
            _PAIRS,
            following,
            prompts,
            encode_sql("prompts", "k", "prompt"),
            "g0 AS (SELECT k, ids[-1] AS last FROM prompt)",
            *steps,
        )
        + f"SELECT {out}, {ids} AS new_ids, concat({tokens}) AS output FROM g{STEPS} JOIN prompts USING (k)"
    )


SQL = {
    "topk_filter": f"WITH {_Z} SELECT vec_id, token_id, round(z, 6) AS z FROM kept",
    "topk_softmax": f"WITH {_Z} SELECT vec_id, token_id, round(p, 6) AS p FROM probs",
    "sample_token": f"""WITH {_Z},
cumulated AS (
  SELECT *, sum(p) OVER (PARTITION BY vec_id ORDER BY token_id ROWS UNBOUNDED PRECEDING) AS cum,
         ('0x' || substr(md5('42:0:' || vec_id), 1, 8))::BIGINT / 4294967296 AS u,
         max(token_id) OVER (PARTITION BY vec_id) AS last_id
  FROM probs)
SELECT vec_id, coalesce(min(token_id) FILTER (round(cum, 12) > u), max(last_id)) AS token_id
FROM cumulated GROUP BY vec_id""",
    "greedy_token": f"WITH {_Z} SELECT vec_id, first(token_id ORDER BY z DESC, token_id) AS token_id FROM z GROUP BY vec_id",
    "long_cross_entropy": """SELECT vec_id, round(max(peak) + ln(sum(exp(z - peak))) - max(z) FILTER (token_id = label), 6) AS loss
FROM (SELECT vec_id, label, token_id, z, max(z) OVER (PARTITION BY vec_id) AS peak
      FROM (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS token_id, unnest(embedding)::DOUBLE AS z FROM embeddings))
GROUP BY vec_id""",
    "long_topk_softmax": f"WITH {_Z} SELECT vec_id, token_id, round(p, 6) AS p FROM probs",
    "long_greedy": f"WITH {_Z} SELECT vec_id, first(token_id ORDER BY z DESC, token_id) AS token_id FROM z GROUP BY vec_id",
    "bigram_counts": with_recursive_sql(*_FULL) + "SELECT input_id, label, n FROM counts",
    "heldout_perplexity": with_sql(fit_sql(), encode_sql("documents", "doc_id"), MARKED_SQL, _PAIRS, _HELDOUT)
    + """SELECT doc_id, count(*) AS n_pairs, round(avg(loss), 6) AS loss, round(exp(avg(loss)), 6) AS perplexity
FROM heldout GROUP BY doc_id""",
    "heldout_overall": with_recursive_sql(*_FULL, _HELDOUT)
    + "SELECT count(*) AS n_pairs, round(avg(loss), 6) AS loss, round(exp(avg(loss)), 6) AS perplexity FROM heldout",
    "generate_batch": _generate_sql(_CONVERSATIONS, "conv_id, turn", _GREEDY, _greedy_step),
    "generate_sampled": _generate_sql(_CONVERSATIONS, "conv_id, turn", _SAMPLED, _sampled_step),
    "generate_long": with_sql(
        fit_sql(),
        encode_sql("documents", "doc_id"),
        MARKED_SQL,
        _PAIRS,
        _GREEDY,
        _CONVERSATIONS,
        encode_sql("prompts", "k", "prompt"),
    ).replace("WITH ", "WITH RECURSIVE ", 1).rstrip()
    + f""",
walk AS (
  SELECT k, 1 AS step, coalesce(next_id, 0) AS x FROM prompt LEFT JOIN succ ON input_id = ids[-1]
  UNION ALL
  SELECT k, step + 1, coalesce(next_id, 0) FROM walk LEFT JOIN succ ON input_id = x WHERE step < {LONG_STEPS})
SELECT conv_id, turn, string_agg(x, ' ' ORDER BY step) AS new_ids,
  string_agg(CASE WHEN kind = 'special' THEN '' ELSE token END, '' ORDER BY step) AS output
FROM walk JOIN vocab ON id = x JOIN prompts USING (k) GROUP BY k, conv_id, turn""",
    "alias_shares": _MODEL + "SELECT input_id, label, (n * count(*) OVER (PARTITION BY input_id))::BIGINT AS units FROM counts",
    "context_crop": with_sql(fit_sql(), encode_sql("documents", "doc_id"))
    + f"SELECT doc_id, array_to_string(ids[greatest(len(ids) - {CONTEXT}, 0) + 1:], ' ') AS ids FROM enc",
    "prompt_suite": _generate_sql(_BENCHMARK, "item_id", _GREEDY, _greedy_step),
}
