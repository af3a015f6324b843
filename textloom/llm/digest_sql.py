"""SQL of the Merkle and vector code queries, built level by level."""

from __future__ import annotations

# Levels that are written out: sources of up to 16 to the sixth rows, 16 to the third sources.
LOWER, UPPER = 6, 3

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0} END"
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)), 4294967295)"""


def _leaf(text: str) -> str:
    fields = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({fields})"


def _levels(name: str, first: str, n: int) -> list[str]:
    """CTEs ``{name}{k}``: nodes (t, pos, h) with their siblings and the number of nodes of their tree."""
    out = []
    for k in range(n + 1):
        source = first if k == 0 else f"""(SELECT t, pos // 16 AS pos,
    CASE WHEN max(cnt) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE max(h) END AS h FROM {name}{k - 1} GROUP BY t, pos // 16)"""
        out.append(f"""{name}{k} AS MATERIALIZED (
  SELECT t, pos, h, count(*) OVER (PARTITION BY t) AS cnt,
         coalesce(string_agg(h, '') OVER (PARTITION BY t, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
         coalesce(string_agg(h, '') OVER (PARTITION BY t, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
  FROM {source})""")
    return out


def merkle_sql() -> str:
    parts = [
        f"""leaves AS MATERIALIZED (
  SELECT doc_id, '=' || source AS s, {_leaf('text')} AS leaf,
         CASE WHEN {_CRC} % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents)""",
        """ranked AS MATERIALIZED (
  SELECT doc_id, leaf, changed, coalesce(s, '') AS t,
         row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves)""",
        *_levels("n", "(SELECT t, pos, leaf AS h FROM ranked)", LOWER),
        f"sources AS MATERIALIZED (SELECT t AS src, h AS subroot, row_number() OVER (ORDER BY t) - 1 AS pos FROM n{LOWER})",
        *_levels("u", "(SELECT '' AS t, pos, subroot AS h FROM sources)", UPPER),
    ]
    joins, steps = "", []
    for k in range(LOWER):
        joins += f"\n  JOIN n{k} ON n{k}.t = r.t AND n{k}.pos = r.pos // {16**k}"
        steps.append(f"n{k}")
    joins += "\n  JOIN sources ON src = r.t"
    for k in range(UPPER):
        joins += f"\n  JOIN u{k} ON u{k}.pos = sources.pos // {16**k}"
        steps.append(f"u{k}")
    proof = " || ".join(f"{s}.b || {s}.a" for s in steps)
    parts.append(f"""f0 AS (SELECT doc_id, leaf, subroot, sha256({proof}) AS proof_sha256, coalesce(changed, leaf) AS h,
  {", ".join(f"{s}.b AS b{i}, {s}.a AS a{i}, {s}.cnt AS c{i}" for i, s in enumerate(steps))}
  FROM ranked r{joins})""")
    for i in range(len(steps)):
        parts.append(f"f{i + 1} AS (SELECT * EXCLUDE (h), CASE WHEN c{i} > 1 THEN sha256(b{i} || h || a{i}) ELSE h END AS h FROM f{i})")
    return (
        "WITH "
        + ",\n".join(parts)
        + f"\nSELECT doc_id, leaf, subroot, u.h AS root, proof_sha256, f.h AS folded_root, f.h = u.h AS verified FROM f{len(steps)} f, u{UPPER} u"
    )


def codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2, width: int = 4) -> str:
    out = [
        """kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""cut AS MATERIALIZED (
  SELECT r, vec_id, p, v[p * {width} + 1 : p * {width} + {width}] AS c FROM kept, range({parts}) t(p))""",
        f"""b0 AS MATERIALIZED (
  SELECT p, e, c FROM (SELECT p, c, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM cut WHERE vec_id IS NOT NULL)
  WHERE e < {entries})""",
    ]
    distance = " + ".join(f"(x.c[{d}] - b.c[{d}]) * (x.c[{d}] - b.c[{d}])" for d in range(1, width + 1))
    mean = ", ".join(f"floor(sum(c[{d}]) / count(*))::BIGINT" for d in range(1, width + 1))
    for k in range(rounds + 1):
        out.append(f"""a{k} AS MATERIALIZED (
  SELECT r, p, c, low // {entries} AS d, low % {entries} AS e
  FROM (SELECT x.r, x.p, any_value(x.c) AS c, min(({distance}) * {entries} + b.e) AS low FROM cut x JOIN b{k} b USING (p) GROUP BY x.r, x.p))""")
        if k < rounds:
            out.append(f"""b{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM b{k} b
  LEFT JOIN (SELECT p, e, [{mean}] AS c FROM a{k} GROUP BY p, e) m USING (p, e))""")
    out.append(f"""coded AS (
  SELECT vec_id, label, code, error FROM kept
  JOIN (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY r) USING (r))""")
    return (
        "WITH "
        + ",\n".join(out)
        + f"""
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256 FROM coded"""
    )
