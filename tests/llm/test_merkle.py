"""The manifest against a plain recursive version."""

import random
import zlib
from hashlib import sha256

import pytest

from textloom.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def proofs(nodes):
    """(root, siblings of each node as (before, after) per level)."""
    steps = [[] for _ in nodes]
    place = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(place):
            run = nodes[p // 16 * 16 : p // 16 * 16 + 16]
            steps[i].append(("".join(run[: p % 16]), "".join(run[p % 16 + 1 :])))
        nodes = [H(*nodes[at : at + 16]) for at in range(0, len(nodes), 16)]
        place = [p // 16 for p in place]
    return nodes[0] if nodes else None, steps


def by_hand(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    below = {s: proofs([x[2] for x in sorted(trees[s], key=lambda x: x[:3])]) for s in names}
    root, above = proofs([below[s][0] for s in names])
    out = []
    for s, up in zip(names, above):
        for x, steps in zip(sorted(trees[s], key=lambda x: x[:3]), below[s][1]):
            row, steps = x[3], steps + up
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            node = leaf_of((*row[:4], lower(row[4]))) if tampered else x[2]
            for before, after in steps:
                node = H(before, node, after)
            out.append((row[0], x[2], below[s][0], root, H(*[b + a for b, a in steps]), node, node == root))
    return sorted(map(str, out))


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA + ", tree string, leaf string")
    got = merkle.manifest(df.repartition(3)).collect()
    assert sorted(str(tuple(r)) for r in got) == by_hand(rows)


def sample(n, sources):
    rng = random.Random(n)
    rows = [(i, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, i * 7]), rng.choice(["Abc É", "zÄ", "", None])) for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n", [1, 2, 17, 300])
def test_one_source(spark, n):
    check(spark, sample(n, ["a"]))


def test_many_sources_nulls_ties_and_long_texts(spark):
    rows = sample(700, ["hot"] * 30 + [None, "", "é", "Z", "z"] + [f"s{i}" for i in range(40)])
    rows += [rows[0], rows[0], (None, None, None, None, None), (None, "hot", None, None, "Q"), (-3, "hot", "EN", -1, "Long WORD " * 300_000)]
    rows += [(rows[5][0], rows[5][1], "other", 1, "A")]
    check(spark, rows)


def test_no_rows(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
