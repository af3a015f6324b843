"""Tables, the shared tokenizer, and SQL pieces used by several queries."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.bpe import VOCAB_SIZE, BpeModel, encode
from textloom.operators.corpus_stats import MIN_FREQUENCY
from textloom.operators.split import split_by_hash
from textloom.plans.layout import spread
from textloom.plans.storage import app_dir
from textloom.sources.artifacts import load_or_train

# Merges of the tokenizer of those registered queries whose SQL unrolls them; the others use the whole vocabulary.
N_MERGES = 24
MAX_LENGTH = 512
BATCH = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text), laid out for heavy work on the text."""
    return spread(documents(spark, sf_dir).select("doc_id", "text"), "doc_id")


def tokenizer(spark: SparkSession, sf_dir: str, source: str = "documents", key: str = "doc_id") -> BpeModel:
    """The tokenizer fitted on a whole table, saved once per application."""
    place = hashlib.md5(f"{sf_dir}:{source}".encode()).hexdigest()
    path = f"{app_dir(spark)}/tokenizer-{place}"
    data = spread(table(spark, sf_dir, source).select(key, "text"), key)
    return load_or_train(spark, path, data, order_key=key, max_merges=N_MERGES)


def full_tokenizer(spark: SparkSession, sf_dir: str) -> BpeModel:
    """The tokenizer of the default vocabulary size, fitted on all documents and saved once per application."""
    place = hashlib.md5(f"{sf_dir}:full".encode()).hexdigest()
    return load_or_train(spark, f"{app_dir(spark)}/tokenizer-{place}", texts(spark, sf_dir), order_key="doc_id")


def encoded(spark: SparkSession, sf_dir: str, model: BpeModel | None = None) -> DataFrame:
    """(doc_id, ids) of every document."""
    model = model or tokenizer(spark, sf_dir)
    return texts(spark, sf_dir).select("doc_id", encode(model, F.col("text"), spark).alias("ids"))


def encoded_split(spark: SparkSession, sf_dir: str, model: BpeModel | None = None) -> DataFrame:
    """(doc_id, ids, split)."""
    model = model or tokenizer(spark, sf_dir)
    marked = split_by_hash(documents(spark, sf_dir).select("doc_id", "text"), ["doc_id"])
    return spread(marked, "doc_id").select("doc_id", "split", encode(model, F.col("text"), spark).alias("ids"))


def joined(ids: Column | str) -> Column:
    """An array as one string, which both engines compare alike."""
    return F.array_join(ids, " ")


def rounded(name: str, places: int = 6) -> Column:
    return F.round(F.col(name), places).alias(name)


# --- SQL -------------------------------------------------------------------

WORD_CLASS = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}"
PRETOKENS = rf"regexp_extract_all(text, '[{WORD_CLASS}]+|[^{WORD_CLASS}\s]+')"

MARKED_SQL = """marked AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id)
                 <= floor(0.9 * count(*) OVER ()) THEN 'train' ELSE 'validation' END AS split
  FROM documents)"""


def fit_sql(source: str = "documents", key: str = "doc_id", n_merges: int = N_MERGES) -> str:
    """CTEs ``chars(c, id)``, ``mer(rank, l, r, n, merged)`` and ``vocab(token, id, kind)``."""
    parts = [
        f"""fit_words AS MATERIALIZED (
  SELECT w, count(*) AS n FROM (SELECT unnest({PRETOKENS}) AS w FROM {source} WHERE text <> '') GROUP BY w)""",
        """chars AS MATERIALIZED (
  SELECT c, 3 + row_number() OVER (ORDER BY c) AS id
  FROM (SELECT DISTINCT unnest(regexp_extract_all(w, '.')) AS c FROM fit_words))""",
        """s0 AS MATERIALIZED (
  SELECT n, ' ' || string_agg(id, '  ' ORDER BY p) || ' ' AS s
  FROM (SELECT w, n, unnest(regexp_extract_all(w, '.')) AS c, generate_subscripts(regexp_extract_all(w, '.'), 1) AS p
        FROM fit_words) JOIN chars USING (c) GROUP BY w, n)""",
    ]
    for r in range(1, n_merges + 1):
        parts.append(
            f"""b{r} AS MATERIALIZED (
  SELECT {r} AS rank, l, r, sum(n)::BIGINT AS n, (SELECT 3 + count(*) FROM chars) + {r} AS merged
  FROM (SELECT n, a[i]::INT AS l, a[i + 1]::INT AS r
        FROM (SELECT n, a, unnest(range(1, len(a))) AS i
              FROM (SELECT n, string_split(trim(s), '  ') AS a FROM s{r - 1})))
  GROUP BY l, r ORDER BY 4 DESC, l, r LIMIT 1)"""
        )
        if r < n_merges:
            parts.append(
                f"""s{r} AS MATERIALIZED (
  SELECT s.n, replace(s.s, ' ' || b.l || '  ' || b.r || ' ', ' ' || b.merged || ' ') AS s FROM s{r - 1} s, b{r} b)"""
            )
    union = " UNION ALL ".join(f"SELECT * FROM b{r}" for r in range(1, n_merges + 1))
    parts.append(f"mer AS MATERIALIZED ({union})")
    specials = "VALUES ('<unk>', 0, 'special'), ('<pad>', 1, 'special'), ('<bos>', 2, 'special'), ('<eos>', 3, 'special')"
    # a merged token is the concatenation of its two parts, themselves merged earlier or characters
    parts.append("t0 AS MATERIALIZED (SELECT c AS token, id FROM chars)")
    for r in range(1, n_merges + 1):
        parts.append(
            f"""t{r} AS MATERIALIZED (
  SELECT token, id FROM t{r - 1} UNION ALL
  SELECT x.token || y.token, b.merged FROM b{r} b JOIN t{r - 1} x ON x.id = b.l JOIN t{r - 1} y ON y.id = b.r)"""
        )
    parts.append(
        f"""vocab AS MATERIALIZED (
  SELECT * FROM ({specials}) v(token, id, kind)
  UNION ALL SELECT token, id, CASE WHEN id <= (SELECT max(id) FROM chars) THEN 'char' ELSE 'merged' END
  FROM t{n_merges})"""
    )
    return ",\n".join(parts)


def encode_sql(target: str, key: str, name: str = "enc", n_merges: int = N_MERGES) -> str:
    """CTE ``{name}(key, ids)``: ids as a list, for a relation with ``key`` and ``text``.

    Folding the merges in rank order equals the exact rule as long as no string
    is the result of two merges.
    """
    pivot = ", ".join(
        f"max(' ' || l || '  ' || r || ' ') FILTER (rank = {r}) AS p{r}, max(' ' || merged || ' ') FILTER (rank = {r}) AS m{r}"
        for r in range(1, n_merges + 1)
    )
    fold = "s"
    for r in range(1, n_merges + 1):
        fold = f"replace({fold}, p{r}, m{r})"
    return f"""{name}_tok AS MATERIALIZED (
  SELECT {key}, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos
  FROM (SELECT {key}, {PRETOKENS} AS ws FROM {target})),
{name}_pat AS MATERIALIZED (SELECT {pivot} FROM mer),
{name}_word AS MATERIALIZED (
  SELECT w, replace(trim({fold}), '  ', ' ') AS s
  FROM (SELECT w, ' ' || string_agg(coalesce(id, 0), '  ' ORDER BY p) || ' ' AS s
        FROM (SELECT w, unnest(regexp_extract_all(w, '.')) AS c,
                     generate_subscripts(regexp_extract_all(w, '.'), 1) AS p
              FROM (SELECT DISTINCT w FROM {name}_tok)) LEFT JOIN chars USING (c) GROUP BY w), {name}_pat),
{name} AS MATERIALIZED (
  SELECT {key}, coalesce(ids, []::INT[]) AS ids
  FROM (SELECT {key} FROM {target})
  LEFT JOIN (SELECT {key}, string_split(string_agg(s, ' ' ORDER BY pos), ' ')::INT[] AS ids
             FROM {name}_tok JOIN {name}_word USING (w) GROUP BY {key}) USING ({key}))"""


# In the whole fit a symbol is one character, this far above its id; a step ranks so many pairs, later ones wait for the next.
SYMBOL = 1 << 16
WINDOW = 1024


def full_fit_sql(source: str = "documents") -> str:
    """``chars``, ``mer`` and ``vocab`` as of ``fit_sql``, of a fit to VOCAB_SIZE ids; needs WITH RECURSIVE.

    A step counts the pairs of all words and applies the leading ones up to the first that another merge of the step
    could change: one that begins with a right symbol or ends with a left symbol before it. A pair of equal symbols and one
    whose string has an id already are a step of their own.
    """
    return f"""fit_words AS MATERIALIZED (
  SELECT w, count(*) AS n FROM (SELECT unnest({PRETOKENS}) AS w FROM {source} WHERE text <> '') GROUP BY w),
chars AS MATERIALIZED (
  SELECT c, 3 + row_number() OVER (ORDER BY c) AS id
  FROM (SELECT DISTINCT unnest(regexp_extract_all(w, '.')) AS c FROM fit_words)),
fit(kind, k, n, s) USING KEY (kind, k) AS (
  SELECT 'word', row_number() OVER (), n, s
  FROM (SELECT n, string_agg(chr({SYMBOL} + id::INT), '' ORDER BY p) AS s
        FROM (SELECT w, n, unnest(regexp_extract_all(w, '.')) AS c, generate_subscripts(regexp_extract_all(w, '.'), 1) AS p
              FROM fit_words) JOIN chars USING (c) GROUP BY w, n)
  UNION ALL
  SELECT 'token', id, 0, token
  FROM (VALUES ('<unk>', 0), ('<pad>', 1), ('<bos>', 2), ('<eos>', 3) UNION ALL SELECT c, id FROM chars) t(token, id)
  UNION
  (WITH words AS MATERIALIZED (SELECT k, n, s FROM recurring.fit WHERE kind = 'word' AND length(s) > 1),
   tokens AS MATERIALIZED (SELECT k, s, count(*) OVER () AS size FROM recurring.fit WHERE kind = 'token'),
   pairs AS MATERIALIZED (SELECT k, n, s[i:i + 1] AS p FROM (SELECT k, n, s, unnest(range(1, length(s))) AS i FROM words)),
   ranked AS MATERIALIZED (
     SELECT p, p[1] AS l, p[2] AS r, n, row_number() OVER (ORDER BY n DESC, p) AS i
     FROM (SELECT p, sum(n)::BIGINT AS n FROM pairs GROUP BY p HAVING sum(n) >= {MIN_FREQUENCY} ORDER BY n DESC, p LIMIT {WINDOW})),
   named AS MATERIALIZED (
     SELECT c.*, x.s || y.s AS token, x.size, min(i) OVER (PARTITION BY x.s || y.s) < i AS twin
     FROM ranked c JOIN tokens x ON x.k = unicode(l) - {SYMBOL} JOIN tokens y ON y.k = unicode(r) - {SYMBOL}),
   judged AS MATERIALIZED (
     SELECT c.*, t.k AS known, l = r OR t.k IS NOT NULL AS alone,
            coalesce(a.i < c.i, false) OR coalesce(b.i < c.i, false) OR twin AS changed
     FROM named c LEFT JOIN tokens t ON t.s = c.token
     LEFT JOIN (SELECT r AS x, min(i) AS i FROM ranked GROUP BY r) a ON a.x = c.l
     LEFT JOIN (SELECT l AS x, min(i) AS i FROM ranked GROUP BY l) b ON b.x = c.r),
   step AS MATERIALIZED (
     SELECT p, n, i, token, coalesce(known, size + i - 1) AS id, p || chr(({SYMBOL} + coalesce(known, size + i - 1))::INT) AS rule
     FROM judged
     WHERE i <= {VOCAB_SIZE} - size AND i < coalesce((
       SELECT min(i) FROM judged WHERE i > 1 AND (alone OR changed OR (SELECT bool_or(alone) FROM judged WHERE i = 1))), {WINDOW} + 1))
   SELECT 'word', w.k, w.n, list_reduce(list_prepend(w.s, h.rules), lambda a, x: replace(a, x[1:2], x[3]))
   FROM words w JOIN (SELECT k, list(DISTINCT rule) AS rules FROM pairs JOIN step USING (p) GROUP BY k) h USING (k)
   UNION ALL
   SELECT 'token', id, 0, token FROM step
   UNION ALL
   SELECT 'merge', i + (SELECT count(*) FROM recurring.fit WHERE kind = 'merge'), n, rule FROM step)),
mer AS MATERIALIZED (
  SELECT k AS rank, unicode(s[1]) - {SYMBOL} AS l, unicode(s[2]) - {SYMBOL} AS r, n, unicode(s[3]) - {SYMBOL} AS merged
  FROM fit WHERE kind = 'merge'),
vocab AS MATERIALIZED (
  SELECT s AS token, k AS id,
         CASE WHEN k < 4 THEN 'special' WHEN k <= (SELECT max(id) FROM chars) THEN 'char' ELSE 'merged' END AS kind
  FROM fit WHERE kind = 'token')"""


def full_encode_sql(target: str, key: str, name: str = "enc") -> str:
    """As ``encode_sql``, by the merges of ``full_fit_sql``; a step applies the lowest-ranked one of every word, leftmost first."""
    return f"""{name}_row AS MATERIALIZED (SELECT row_number() OVER () AS o, {key}, {PRETOKENS} AS ws FROM {target}),
{name}_tok AS MATERIALIZED (SELECT o, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM {name}_row),
{name}_rule AS MATERIALIZED (SELECT l, r, max(rank) AS rank, any_value(merged)::INT AS merged FROM mer GROUP BY l, r),
{name}_word(w, ids) USING KEY (w) AS (
  SELECT w, list(coalesce(id, 0)::INT ORDER BY p)
  FROM (SELECT w, unnest(regexp_extract_all(w, '.')) AS c, generate_subscripts(regexp_extract_all(w, '.'), 1) AS p
        FROM (SELECT DISTINCT w FROM {name}_tok)) LEFT JOIN chars USING (c) GROUP BY w
  UNION
  SELECT w, ids[:m.i - 1] || [m.merged] || ids[m.i + 2:]
  FROM (SELECT w, any_value(ids) AS ids, min({{rank: rank, i: i, merged: merged}}) AS m
        FROM (SELECT w, ids, unnest(range(1, len(ids))) AS i FROM {name}_word) JOIN {name}_rule ON l = ids[i] AND r = ids[i + 1]
        GROUP BY w)),
{name} AS MATERIALIZED (
  SELECT {key}, coalesce(ids, []::INT[]) AS ids
  FROM {name}_row
  LEFT JOIN (SELECT o, flatten(list(ids ORDER BY pos)) AS ids FROM {name}_tok JOIN {name}_word USING (w) GROUP BY o) USING (o))"""


def with_sql(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def with_recursive_sql(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"
