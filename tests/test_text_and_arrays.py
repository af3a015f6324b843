"""Hand tables for text predicates, scalars and array shaping."""

import pytest
from pyspark.sql import functions as F

from textloom.functions import arrays, text as T

EDGE = [None, "", "   ", "a", "aaa aaaa", "Let's go!", "你好，世界", "naïve_2", "x\U0001f600y"]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(EDGE)], "k int, text string")


def column(df, c):
    return [r[0] for r in df.orderBy("k").select(c).collect()]


def test_usable_keeps_white_space(edge):
    kept = edge.where(T.is_usable(edge))
    assert [r["k"] for r in kept.orderBy("k").collect()] == [2, 3, 4, 5, 6, 7, 8]


def test_coerce(spark, edge):
    assert column(edge, T.coerce_text(F.col("text")))[:3] == ["", "", "   "]
    numbers = spark.createDataFrame([(0, 7), (1, None)], "k int, n int")
    assert column(numbers, T.coerce_text(F.col("n"))) == ["7", ""]


def test_pretokens_are_unicode_aware(edge):
    assert column(edge, T.pretokens(F.col("text")))[1:] == [
        [],
        [],
        ["a"],
        ["aaa", "aaaa"],
        ["Let", "'", "s", "go", "!"],
        ["你好", "，", "世界"],
        ["naïve_2"],
        ["x", "\U0001f600", "y"],
    ]


def test_characters_are_code_points(edge):
    assert column(edge, T.characters(F.col("text")))[8] == ["x", "\U0001f600", "y"]


def test_scalars(spark):
    df = spark.createDataFrame([(0, "Red Big Box", "  a b\t\n", "./.gitignore", ".\\.x")], "k int, a string, b string, c string, d string")
    row = df.select(
        T.slug(F.col("a")), T.strip(F.col("b")), T.strip_leading_dots(F.col("c")), T.strip_leading_dots(F.col("d"))
    ).first()
    assert tuple(row) == ("red-big-box", "a b", "gitignore", "x")


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5])
def test_shapes_around_max_length(spark, n):
    ids = list(range(10, 10 + n))
    df = spark.createDataFrame([(ids,)], "ids array<int>")
    cut = arrays.truncate(F.col("ids"), 4)
    padded = arrays.pad_right(cut, 4, 1)
    got = df.select(
        cut.alias("cut"),
        padded.alias("padded"),
        arrays.attention_mask(cut, 4).alias("mask"),
        arrays.shift_labels(padded, 1).alias("labels"),
        arrays.crop_context(F.col("ids"), 2).alias("crop"),
    ).first()
    want = (ids[:4] + [1] * 4)[:4]
    assert got["cut"] == ids[:4]
    assert got["padded"] == want
    assert got["mask"] == [1] * min(n, 4) + [0] * max(4 - n, 0)
    assert got["labels"] == want[1:] + [1]
    assert got["crop"] == ids[-2:]


def test_labels_of_nothing_are_one_pad(spark):
    df = spark.createDataFrame([([],)], "ids array<int>")
    assert df.select(arrays.shift_labels(F.col("ids"), 1)).first()[0] == [1]


def test_decode_skips_specials_and_joins_without_spaces(spark):
    tokens = ["<unk>", "<pad>", "<bos>", "<eos>", "a", 'q"\\', "é"]
    df = spark.createDataFrame([([2, 4, 5, 0, 6, 3, 1],), ([],)], "ids array<int>")
    assert [r[0] for r in df.select(arrays.decode(F.col("ids"), tokens, [0, 1, 2, 3])).collect()] == ['aq"\\é', ""]
