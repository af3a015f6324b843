"""Path rules on a small tree."""

import random
import re

import pytest
from pyspark.sql import functions as F

from textloom.operators import paths as P
from textloom.plans.storage import scratch_path

TREE = ["a.py", "src/a.py", "src/x/b.txt", "dataset/d.csv", "src/dataset/e.csv", ".git/config", "venv2/k", "x+y.txt"]


@pytest.fixture(scope="module")
def tree(spark):
    return spark.createDataFrame([(p,) for p in TREE], "path string")


def left(df):
    return sorted(r["path"] for r in df.collect())


def without(*gone):
    return sorted(set(TREE) - set(gone))


def test_default_directories(tree):
    assert left(tree.where(P.outside_dirs(F.col("path")))) == without(".git/config")


@pytest.mark.parametrize(
    "pattern,gone",
    [
        ("/dataset", ["dataset/d.csv"]),
        ("/dataset/", ["dataset/d.csv"]),
        ("/a.py", ["a.py"]),
        ("/a.py/", []),
        ("/src/x", ["src/x/b.txt"]),
        ("/*.py", []),  # a rooted pattern is literal
        ("dataset/", ["dataset/d.csv", "src/dataset/e.csv"]),
        ("dataset", ["dataset/d.csv", "src/dataset/e.csv"]),
        ("a.py/", []),
        ("*.txt", ["src/x/b.txt", "x+y.txt"]),
        ("x+y.txt", ["x+y.txt"]),
        ("src/x", ["src/x/b.txt"]),
        ("?.py", ["a.py", "src/a.py"]),
        ("[ab].*", ["a.py", "src/a.py", "src/x/b.txt"]),
        ("[!a].*", ["src/x/b.txt", "dataset/d.csv", "src/dataset/e.csv"]),
        ("src/**/e.csv", ["src/dataset/e.csv"]),
        ("venv", []),
        ("  *.csv  ", ["dataset/d.csv", "src/dataset/e.csv"]),
        ("# *.csv", []),
        ("", []),
        ("/", TREE),
    ],
)
def test_exclusion(tree, pattern, gone):
    assert left(P.exclude(tree, [pattern])) == without(*gone)


@pytest.mark.parametrize(
    "pattern,found",
    [
        ("./a.py", ["a.py", "src/a.py"]),
        ("*.csv", ["dataset/d.csv", "src/dataset/e.csv"]),
        ("src/**/*.csv", ["src/dataset/e.csv"]),
        ("**/b.txt", ["src/x/b.txt"]),
        ("src", []),
        (".git/config", []),  # leading dots go, as in the strip rule
    ],
)
def test_inclusion(tree, pattern, found):
    assert left(P.include(tree, [pattern])) == found


def test_collect_lets_inclusion_win(tree):
    doubled = tree.union(tree)
    got = P.collect_paths(doubled, ["*.csv", "/src/"], ["src/dataset/*", "c*g"])
    assert left(got) == sorted([".git/config", "a.py", "src/dataset/e.csv", "venv2/k", "x+y.txt"])


def test_rules_from_a_file(spark, tree):
    path = scratch_path(spark, "rules")
    spark.createDataFrame([("# note",), ("",), ("/dataset",), ("*.txt ",)], "value string").coalesce(1).write.text(path)
    assert left(P.exclude(tree, path)) == without("dataset/d.csv", "src/x/b.txt", "x+y.txt")
    assert P.read_patterns(spark, None).count() == 0


def test_rule_table(spark):
    lines = spark.createDataFrame([(0, "/a/"), (1, "b*"), (2, " "), (3, "#c")], "rule_id int, line string")
    got = {r["rule_id"]: (r["pattern"], r["root_relative"], r["dir_only"]) for r in P.pattern_rules(lines).collect()}
    assert got == {0: ("a", True, True), 1: ("b*", False, False)}


def test_relative_path(spark):
    df = spark.createDataFrame([("/r/x/a.py",), ("/other/b.py",), ("/r2/c",)], "path string")
    got = [r[0] for r in df.select(P.relative_path(F.col("path"), "/r")).collect()]
    assert got == ["x/a.py", "b.py", "c"]


def test_selection_is_one_filter(tree, capsys):
    P.exclude(tree, ["*.txt", "/src", "x/"]).explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan and "Exchange" not in plan


def test_pattern_file_of_any_name(spark, tmp_path):
    (tmp_path / ".gitignore").write_text("*.py\n/dataset\n")
    paths = spark.createDataFrame([("a.py",), ("dataset/x",), ("keep",)], "path string")
    assert [r[0] for r in P.exclude(paths, str(tmp_path / ".gitignore")).collect()] == ["keep"]
    assert P.exclude(paths, str(tmp_path / "none")).count() == 3


def test_twenty_thousand_rules(spark):
    rules = [f"/dir{i}/" for i in range(10_000)] + [f"*.x{i}" for i in range(10_000)]
    rows = [("dir7/a",), ("dir7",), ("dir9999/b/c",), ("dir10000/a",), ("a/b.x9998",), ("a/b.y",)]
    kept = P.exclude(spark.createDataFrame(rows, "path string"), rules)
    assert sorted(r[0] for r in kept.collect()) == ["a/b.y", "dir10000/a", "dir7"]


PARTS = ["a", "b", "ab", "abc", "x1", "x2", "y.py", "z.txt", "src", "lib"]


def many_rules(rng, n):
    piece = lambda: rng.choice(["a", "b*", "*c", "x?", "[xy]*", "[!a]b", "*", "*b*", "?", "src", "y.*", "**", "lib", "a*c", *PARTS])
    rules = []
    for _ in range(n):
        glob = "/".join(piece() for _ in range(rng.randint(1, 4)))
        rules.append(rng.choice([glob, f"{glob}/", f"{glob}{rng.randint(0, 99)}", f"a{glob}", f"/{glob}"]))
    return rules


@pytest.mark.parametrize("seed", range(3))
def test_the_automaton_equals_rule_by_rule(spark, monkeypatch, seed):
    rng = random.Random(seed)
    paths = sorted({"/".join(rng.choice(PARTS) for _ in range(rng.randint(1, 5))) for _ in range(120)})
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    rules = many_rules(rng, 40)
    monkeypatch.setattr(P, "MANY", 500)
    one_by_one = [
        (set(left(df.where(P.excluded_by(spark, F.col("path"), [r])))), set(left(P.include(df, [r.lstrip("/")])))) for r in rules[:12]
    ]
    monkeypatch.setattr(P, "MANY", 0)
    for rule, (gone, kept) in zip(rules, one_by_one):
        assert set(left(df.where(P.excluded_by(spark, F.col("path"), [rule])))) == gone, rule
        assert set(left(P.include(df, [rule.lstrip("/")]))) == kept, rule
    monkeypatch.setattr(P, "MANY", 500)
    together = left(P.exclude(df, rules)), left(P.include(df, rules))
    monkeypatch.setattr(P, "MANY", 3)
    assert (left(P.exclude(df, rules)), left(P.include(df, rules))) == together


def test_ten_thousand_rules_in_one_predicate(spark, capsys):
    rng = random.Random(9)
    rules = [f"gen{i}" if i % 3 else f"gen{i}*.tmp" if i % 2 else f"*.x{i}" for i in range(9_900)] + many_rules(rng, 100)
    paths = [f"src/gen{i}/f{i}.x{i + 5}" for i in range(0, 400, 7)] + ["src/keep.md", "k/gen6q.tmp", "k/gen9q.tmp", "m.x8", "m.x9"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    rows = P.pattern_rules(P.read_patterns(spark, rules)).collect()
    literal = {r["pattern"]: r["dir_only"] for r in rows if r["root_relative"]}
    regexes = [re.compile(r["regex"]) for r in rows if r["regex"]]
    want = [
        p
        for p in paths
        if not any(x.search(p) for x in regexes)
        and not any(p.startswith(f"{d}/") or (p == d and not only) for d, only in literal.items())
    ]
    kept = P.exclude(df, rules)
    assert left(kept) == sorted(want)
    kept.explain()
    plan = capsys.readouterr().out
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan


MANY_RULES = ["a", "b/", "c?", "*d", "e*f", "g/h", "g/**/i", "**/j", "k/**", "[l-n]o", "[!p]q/r?", "/s", "/t/u/", "v[w", "x]y", "*", "**z", "#c", " "]


@pytest.mark.parametrize("some", [range(0, 15), [0, 10, 16, 17, 18]])
def test_rules_as_a_table_equal_rules_as_a_predicate(spark, tmp_path, monkeypatch, some):
    rng = random.Random(7)
    parts = ["a", "b", "c1", "cc", "xd", "d", "exf", "ef", "g", "h", "i", "j", "k", "lo", "oo", "zq", "pq", "r1", "s", "t", "u", "v[w", "x]y", "é"]
    made = {"/".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(400)}
    paths = spark.createDataFrame([(p,) for p in sorted(made)] * 2, "path string")
    rules = [MANY_RULES[i] for i in some]
    (tmp_path / "rules").write_text("\n".join(rules) + "\x0bnever-there\n", "utf-8")
    place = str(tmp_path / "rules")
    short = [sorted(r["path"] for r in f(paths, place).collect()) for f in (P.exclude, P.include, P.collect_paths)]
    monkeypatch.setattr(P, "LIST_BYTES", 0)
    monkeypatch.setattr(P, "excluded_by", lambda *_: pytest.fail("rules of a large file are not collected"))
    long = [sorted(r["path"] for r in f(paths, place).collect()) for f in (P.exclude, P.include, lambda p, r: P.collect_paths(p, r, r))]
    assert long[:2] == short[:2]
    assert set(long[2]) == set(short[0]) | set(short[1])


def test_a_table_of_rules_with_hidden_files_and_one_that_covers_all(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "LIST_BYTES", 0)
    paths = spark.createDataFrame([("a/b",), ("c",), ("d",), (None,)], "path string")
    (tmp_path / "part-0").write_text("a\n")
    (tmp_path / "_more").write_text("c\n")
    assert {r["path"] for r in P.exclude(paths, str(tmp_path)).collect()} == {"d", None}
    (tmp_path / "part-1").write_text("/\n")
    assert P.exclude(paths, str(tmp_path)).count() == 0
