"""Vector codes against all distances, one vector at a time."""

import math
import random
from hashlib import sha256

import numpy as np
import pytest

from textloom.llm import vector_codes as V
from textloom.plans import lookup

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, vector string"


def by_hand(rows, parts, entries=64, rounds=2):
    kept = [
        (i, [math.floor(256 * x) for x in v], y)
        for i, v, y, *_ in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = sorted((r for r in kept if r[0] is not None), key=lambda r: r[:2])
    width = len(named[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(r[1], p) for r in named[:entries]] for p in range(parts)]

    def assign(v, p):
        measured = [sum((a - b) ** 2 for a, b in zip(cut(v, p), e)) for e in books[p]]
        return measured.index(min(measured)), min(measured)

    for _ in range(rounds):
        found = [[assign(r[1], p)[0] for p in range(parts)] for r in kept]
        new = []
        for p, book in enumerate(books):
            moved = []
            for e, old in enumerate(book):
                mine = [cut(r[1], p) for r, f in zip(kept, found) if f[p] == e]
                moved.append([sum(c) // len(mine) for c in zip(*mine)] if mine else old)
            new.append(moved)
        books = new
    digest = sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, labels = [], {}
    for i, v, y in kept:
        found = [assign(v, p) for p in range(parts)]
        error = sum(d for _, d in found)
        out.append((i, bytes(e for e, _ in found), error, y))
        labels[y] = labels.get(y, 0) + error
    return sorted((str(i), c.hex(), min(e, V.LONG_MAX), min(labels[y], V.LONG_MAX), digest) for i, c, e, y in out)


def made(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    got = V.compress(df, **options).collect()
    return sorted((str(r["vec_id"]), bytes(r["code"]).hex(), r["error"], r["label_error"], r["codebooks_sha256"]) for r in got)


def sample(n, dims, seed=1):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.3, (n, dims)).astype(np.float32)
    vectors[n // 2 :: 5] = vectors[0]  # a hot vector, ties
    order = random.Random(seed)
    return [(i, [float(x) for x in v], order.choice([None, 0, 1, 2])) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", limit)
    rows = sample(400, 32)
    odd = [(900, None, 1), (901, [float("nan")] * 32, 1), (902, [None] * 32, None), (903, [float("-inf")] * 32, 2), (1, [0.5] * 32, 1), (1, [0.25] * 32, 9)]
    odd += [(None, [0.1] * 32, None)]
    assert made(spark, rows + odd) == by_hand(rows + odd, 16)


def test_few_vectors_and_other_parts(spark):
    rows = sample(5, 12)
    assert made(spark, rows, parts=3, entries=4, rounds=3) == by_hand(rows, 3, 4, 3)


def test_integers_beyond_64_bits(spark):
    rows = [(i, [float(np.float32(x)) for x in ((-1) ** i * 3e38, 1.5, i, 2.0**60)], 0) for i in range(6)]
    assert made(spark, rows, parts=2, entries=3) == by_hand(rows, 2, 3)


def test_no_vectors(spark):
    assert made(spark, []) == [] and made(spark, [(1, None, 1)]) == []


def test_floor_goes_down():
    assert V.integers(np.array([[-0.001, 0.001, -1 / 256]], np.float32)).tolist() == [[-1, 0, -1]]


def test_parts_must_fit(spark):
    with pytest.raises(ValueError):
        made(spark, [(1, [0.0] * 6, 1)], parts=4)
