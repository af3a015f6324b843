"""Quality rules as a ledger of failure bits.

``ledger`` measures every text once and stores, per document, the measurements
and one bit per failed rule. Policies are masks over those bits, so applying a
version of a policy or asking what a rule does on its own never touches a text
again.

Everything is an expression inside the row: no shuffle, no Python.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import SPACE_CHARS, fresh, let, without, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_run_words"]

# Rules in bit order: new rules go to the end, so stored ledgers keep their meaning.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "word_runs": "5 * n_run_words > n_words",
    "unbroken_text": "word_chars > 60 * n_words",
}

# A version of a policy never changes once documents were selected with it.
POLICIES: dict[str, Sequence[str]] = {
    "base-1": ["few_words", "repeated_windows"],
    "clean-1": ["few_words", "repeated_windows", "symbols", "repeated_lines", "word_runs", "unbroken_text"],
}
POLICY = "clean-1"


def _repeated_words(hashes: Column) -> Column:
    """Words lying in a window of WINDOW words that occurs twice or more in the text.

    Windows are compared by a 64-bit hash within one document. Documents whose
    windows all differ, nearly all, are done after one pass; in the others the
    windows are sorted and equal neighbours found.
    """
    n = F.size(hashes)
    starts = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(starts, lambda i: F.xxhash64(*[hashes[i + k] for k in range(WINDOW)]))

    def covered(places: Column) -> Column:
        last = F.size(places) - 1
        gaps = F.transform(
            places, lambda p, k: F.when(k < last, F.least(F.lit(WINDOW), F.get(places, k + 1) - p)).otherwise(WINDOW)
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def repeats(rows: Column) -> Column:
        twice = F.filter(
            rows,
            lambda e, k: (F.get(rows, k - 1)["h"] == e["h"]) | (F.get(rows, k + 1)["h"] == e["h"]),
        )
        return let(F.sort_array(F.transform(twice, lambda e: e["p"])), covered)

    def count(found: Column) -> Column:
        by_hash = F.sort_array(F.transform(found, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("long")).otherwise(
            let(by_hash, repeats)
        )

    return let(windows, count)


def measurements(text: Column) -> Column:
    """A struct of MEASURES (long) for one text; null measures as the empty text."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.length(F.translate(line, SPACE_CHARS, "")) > 0)

    def of_hashes(hashes: Column) -> Column:
        runs = F.filter(hashes, lambda h, i: F.get(hashes, i - 1) == h)
        return F.struct(
            F.size(hashes).cast("long").alias("n_words"),
            _repeated_words(hashes).alias("n_repeat_words"),
            F.size(runs).cast("long").alias("n_run_words"),
        )

    def of_lines(found: Column) -> Column:
        n = F.size(found).cast("long")
        return F.struct(n.alias("n_lines"), (n - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"))

    hashed = F.transform(words(text), lambda w: F.xxhash64(w))
    by_word, by_line = let(hashed, of_hashes), let(lines, of_lines)
    return F.struct(
        by_word.alias("w"),
        by_line.alias("l"),
        F.length(F.translate(whole, SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )


def ledger(docs: DataFrame, text_col: str = "text", rules: Mapping[str, str] = RULES) -> DataFrame:
    """``docs`` without the text, with MEASURES and ``failures``, one bit per failed rule.

    Null and empty texts have no words and fail ``few_words``. Input columns
    named like a result column are replaced. Rows are neither dropped nor merged.
    """
    kept = [c for c in without(docs, [*MEASURES, "failures"]) if c != text_col]
    measured = docs.select(*kept, _flat(measurements(F.col(text_col))).alias(fresh(docs, "_quality")))
    measured = measured.select(*kept, F.col(f"{measured.columns[-1]}.*"))
    bits = [F.when(F.expr(test), F.lit(1 << i)).otherwise(0) for i, test in enumerate(rules.values())]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    return measured.withColumn("failures", failures.cast("long"))


def mask(policy: str | Sequence[str], rules: Mapping[str, str] = RULES) -> int:
    """The bits of a policy, given by name or as a list of rules."""
    names = POLICIES[policy] if isinstance(policy, str) else policy
    places = list(rules)
    return sum(1 << places.index(name) for name in names)


def passes(policy: str | Sequence[str], rules: Mapping[str, str] = RULES) -> Column:
    """Whether a ledger row fails no rule of the policy."""
    return F.col("failures").bitwiseAND(F.lit(mask(policy, rules))) == 0


def select_documents(docs: DataFrame, policy: str = POLICY, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with their own columns only.

    Null and empty texts go. Columns named like a measurement are left alone.
    """
    measured = fresh(docs, "_quality")
    failed = [_inside(RULES[name], measured) for name in POLICIES[policy]]
    marked = docs.withColumn(measured, _flat(measurements(F.col(text_col))))
    return marked.where(~F.expr(" OR ".join(failed))).drop(measured)


def _flat(measured: Column) -> Column:
    """MEASURES as one flat struct."""

    def flatten(m: Column) -> Column:
        fields = [m["w"][c] if c in ("n_words", "n_repeat_words", "n_run_words") else m["l"][c] if "lines" in c else m[c]
                  for c in MEASURES]
        return F.struct(*[f.alias(c) for f, c in zip(fields, MEASURES)])

    return let(measured, flatten)


def _inside(rule: str, struct: str) -> str:
    """A rule over the fields of a struct column."""
    return "(" + re.sub(r"\b(" + "|".join(MEASURES) + r")\b", rf"`{struct}`.\1", rule) + ")"


def policy_counts(rows: DataFrame, policies: Mapping[str, Sequence[str]] = POLICIES) -> DataFrame:
    """(policy, n_docs, n_kept) of a ledger, all policies in one pass."""
    counts = [F.count_if(passes(p)).alias(f"p{i}") for i, p in enumerate(policies)]
    one = rows.agg(F.count("*").alias("n_docs"), *counts)
    entries = [F.struct(F.lit(name).alias("policy"), F.col(f"p{i}").alias("n_kept")) for i, name in enumerate(policies)]
    return one.select("n_docs", F.inline(F.array(*entries))).select("policy", "n_docs", "n_kept")


def ablations(rows: DataFrame, policy: str = POLICY, rules: Mapping[str, str] = RULES) -> DataFrame:
    """What each rule of a policy does: (rule, n_failed, n_only, n_without).

    ``n_failed`` documents fail the rule, ``n_only`` fail no other rule of the
    policy, ``n_without`` would be rejected if the rule were left out. One pass
    over the failure bits; partial counts are all that is shuffled.
    """
    whole = mask(policy, rules)
    bits = F.col("failures").bitwiseAND(F.lit(whole))
    names = POLICIES[policy]
    counts = []
    for i, name in enumerate(names):
        bit = mask([name], rules)
        counts += [
            F.count_if(bits.bitwiseAND(F.lit(bit)) != 0).alias(f"f{i}"),
            F.count_if(bits == bit).alias(f"o{i}"),
            F.count_if(bits.bitwiseAND(F.lit(whole & ~bit)) != 0).alias(f"w{i}"),
        ]
    one = rows.agg(*counts)
    entries = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"f{i}").alias("n_failed"),
            F.col(f"o{i}").alias("n_only"),
            F.col(f"w{i}").alias("n_without"),
        )
        for i, name in enumerate(names)
    ]
    return one.select(F.inline(F.array(*entries)))
