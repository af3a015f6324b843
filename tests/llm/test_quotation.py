"""Quotation linking against a plain search of every passage in every earlier message."""

import random
import re

import pytest

from textloom.llm import quotation
from textloom.plans import lookup

SCHEMA = "conv_id long, turn long, role string, text string, ck string, seq long, branch string"


def split(text):
    out = []
    for line in (text or "").split("\n"):
        marks = re.match(r"\s*(?:>\s?)+", line)
        level = marks.group().count(">") if marks else 0
        rest = line[marks.end() :] if marks else line
        out.append((level, re.sub(r"\s+", " ", rest.lower()).strip()))
    return out


def passages_of(text):
    runs, last = [], 0
    for level, line in split(text):
        if line:
            if level != last or not runs:
                runs.append((level, []))
                last = level
            runs[-1][1].append(line)
    return [(level, lines) for level, lines in runs if level]


def longest(passage, own):
    """Lines of the longest run of ``passage`` that is also a run of ``own``."""
    best = 0
    for i in range(len(passage)):
        for j in range(len(own)):
            n = 0
            while i + n < len(passage) and j + n < len(own) and passage[i + n] == own[j + n]:
                n += 1
            best = max(best, n)
    return best


def by_hand(rows):
    order = lambda x: (x is not None, x)
    out, talks = [], {}
    for r in rows:
        talks.setdefault(r[0], []).append(r)
    for conv, talk in talks.items():
        talk = sorted(talk, key=lambda r: [(x is not None, x if x is not None else 0) for x in r[1:2]] + [order(r[2]), order(r[3])])
        own = [[line for level, line in split(r[3]) if level == 0 and line] for r in talk]
        parents, linked, answered = [], [], set()
        heads, places = [], []
        for s, r in enumerate(talk):
            total, chosen = 0, (0, None)
            for level, passage in passages_of(r[3]):
                runs = [longest(passage, own[e]) for e in range(s)]
                best = max(runs, default=0)
                if best:
                    total += best
                    original = max(e for e in range(s) if runs[e] == best)
                    if level == 1:
                        chosen = max(chosen, (best, original))
            parent = chosen[1] if chosen[0] else (s - 1 if s else None)
            parents.append(parent)
            linked.append(total)
            if parent is None or parent in answered:
                heads.append(s)
                places.append(0)
            else:
                heads.append(heads[parent])
                places.append(places[parent] + 1)
            answered.add(parent)
        for s, r in enumerate(talk):
            quoted = sum(level > 0 and bool(line) for level, line in split(r[3]))
            parent = parents[s]
            out.append((conv, r[1], r[2], quoted, linked[s], None if parent is None else talk[parent][1], talk[heads[s]][1], places[s]))
    return sorted(map(str, out))


def check(spark, rows):
    talk = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)
    got = quotation.link(talk).collect()
    made = sorted(str(tuple(r[c] for c in ("conv_id", "turn", "role", "n_quoted", "n_linked", "parent_turn", "branch", "place"))) for r in got)
    assert made == by_hand(rows)


def test_the_message_quoted_last_and_longest_is_answered(spark):
    rows = [
        (1, 0, "a", "Yes.\nSee the plan\nbye"),
        (1, 1, "b", "I did"),
        (1, 2, "a", "No"),
        (1, 3, "b", "hm"),
        (1, 4, "a", "yes."),
        (1, 5, "b", "> Yes.\nok"),  # the latest one who said it
        (1, 6, "b", "> yes.\n>  see THE plan\n>\n> and more\nok"),  # two lines beat one
        (1, 7, "c", ">> I did\n> ok\n> hm\nnested"),
        (1, 8, "c", "> nothing of this\n> was said"),
    ]
    got = {r["turn"]: r["parent_turn"] for r in quotation.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[5] == 4 and got[6] == 0 and got[8] == 7
    check(spark, rows)


def talks(seed):
    rng = random.Random(seed)
    common = ["yes.", "No", "thanks", "see  you", "a", "b", "c", "d"]
    rows = []
    for conv in [None, *range(4)]:
        said = []
        for turn in range(rng.randint(1, 14)):
            lines = []
            for _ in range(rng.randint(0, 3)):
                if said and rng.random() < 0.7:
                    original = rng.choice(said)
                    at = rng.randrange(len(original))
                    mark = rng.choice(["> ", ">", ">> ", " > > "])
                    lines += [mark + x.upper() for x in original[at : at + rng.randint(1, 6)]]
                own = [rng.choice(common) for _ in range(rng.randint(0, 7))]
                said += [own] if own else []
                lines += own + [""] * rng.randint(0, 1)
            rows.append((conv, rng.choice([turn, turn, 3]), rng.choice(["user", None]), rng.choice(["\n".join(lines), "\n".join(lines), None])))
    return rows


@pytest.mark.parametrize("seed, limit", [(1, 1 << 20), (2, 1 << 20), (3, 0)])
def test_random_talks(spark, monkeypatch, seed, limit):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", limit)
    check(spark, talks(seed))


def test_one_long_branch_and_a_hot_line(spark):
    rows = [(7, i, "user", f"> yes\nyes\nline {i}" if i % 3 else f"line {i}\nyes") for i in range(150)]
    check(spark, rows)


def test_long_passages(spark):
    lines = [f"sentence number {i}" for i in range(300)]
    rows = [(1, 0, "a", "\n".join(lines)), (1, 1, "b", "x"), (1, 2, "b", "\n".join("> " + x for x in [*lines[20:219], "not said", *lines[40:50]]))]
    check(spark, rows)
    assert quotation.link(spark.createDataFrame([(1, 0, "a", "word " * 400_000)], "conv_id long, turn long, role string, text string")).first()["place"] == 0
