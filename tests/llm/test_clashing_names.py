"""Inputs whose columns have the names that the operators use inside."""

import re
from pathlib import Path

import pytest

import corpus_pipeline
import textloom.llm

SOURCES = [p.read_text() for p in Path(textloom.llm.__path__[0]).glob("*.py")] + [
    (Path(textloom.llm.__path__[0]).parent / "plans" / f"{n}.py").read_text() for n in ("ordering", "lookup", "storage")
]
# every quoted identifier: columns made inside and aliases, whatever they are used for
INNER = sorted({name.lower() for s in SOURCES for name in re.findall(r"""["']([A-Za-z_][A-Za-z_0-9]*)["']""", s)})
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def crowded(spark):
    own = [n for n in INNER if n not in DOCUMENT]
    word = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    texts = [" ".join(f"{w}{i}" for w in word) + " end." for i in range(6)] + [None, ""]
    texts += [texts[0]]
    rows = [(i, t, "en", "a" if i % 2 else None, len(t or ""), *["x"] * len(own)) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in own)
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_takes_any_other_columns(spark, crowded, name, stage):
    plain = sorted(map(str, stage(spark, crowded.select(*DOCUMENT), "").select("doc_id").collect()))
    made = stage(spark, crowded, "")
    assert sorted(map(str, made.select("doc_id").collect())) == plain and len(plain) > 0
    made.write.format("noop").mode("overwrite").save()
