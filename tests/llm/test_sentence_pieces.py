"""Encoding by distinct words against the library on whole texts."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.llm import sentence_pieces as S
from textloom.llm.queries import piece_vocabulary_path

PATH = piece_vocabulary_path()
SCHEMA = "doc_id long, text string, block string, ids string, number int"

EDGES = [None, "", " ", "  ", "   \n ", "a", " a", "a ", "a  b", "▁", "▁▁", "a▁b", "a ▁ b", " x", "　x y", "é é ﬁ", "你好 世界", "🙂🙂 x"]
EDGES += ["\x00a \x00", "<s> </s> <unk>", "<0x0A>", "a\r\n\tb", "x" * 5000, " " * 300 + "x" + " " * 40, "the the the", "12 345 6.7", "word " * 20_000]


def texts():
    rng = random.Random(4)
    letters = "aeiou tnsr  \n▁éß漢🙂1,."
    return EDGES + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 400))) for _ in range(200)] + EDGES


def library(text):
    processor = S._processor(PATH)
    ids = processor.encode(text or "")
    return ids, processor.decode(ids)


@pytest.mark.parametrize("block_bytes, parts", [(S.BLOCK_BYTES, 3), (700, 3), (1, 2)])
def test_equals_the_library(spark, block_bytes, parts):
    rows = [(i % 210, t, f"b{i}", "x", i) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, parts), SCHEMA)
    made = S.encode(docs, PATH, block_bytes=block_bytes)
    assert made.columns == ["doc_id", "block", "number", "ids"]
    got = made.withColumn("decoded", S.decode(F.col("ids"), PATH)).collect()
    assert len(got) == len(rows)
    for r in got:
        ids, decoded = library(rows[r["number"]][1])
        assert (r["ids"], r["decoded"]) == (ids, decoded) and r["block"] == f"b{r['number']}"


def test_no_rows(spark):
    assert S.encode(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_words_of_texts():
    words, starts = S.marked_words(pa.array(["a b", None, "", " c  ", "d▁e"]).slice(0))
    assert words.to_pylist() == [" a", " b", "  c", "  ", " d", " e"] and starts.tolist() == [0, 2, 2, 2, 4, 6]


def test_a_word_is_segmented_once_per_task_of_its_hash(spark):
    docs = spark.createDataFrame(spark.sparkContext.parallelize([(i, "same words here " * 50, "", "", 0) for i in range(40)], 8), SCHEMA)
    made = S.encode(docs, PATH, block_bytes=1)
    assert {tuple(r["ids"]) for r in made.collect()} == {tuple(library("same words here " * 50)[0])}


def test_rows_in_another_order_are_noticed():
    block = pa.table({"block": [1], "digest": [5], "n": [0], "numbers": [b""], "payload": [b""]})
    table = pa.table({"block": [1], "bucket": [0], "n": [1], "digest": [6], "lengths": [b""], "ids": [b""]})
    with pytest.raises(RuntimeError, match="not read twice alike"):
        S._assembled([], 4)(block, table)


def test_few_and_many_buckets_and_little_memory(spark, monkeypatch):
    rows = [(i, t, "b", "x", i) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 3), SCHEMA)
    for buckets in (1, 50):
        got = S.encode(docs, PATH, block_bytes=2000, buckets=buckets).collect()
        assert {r["number"]: r["ids"] for r in got} == {r[4]: library(r[1])[0] for r in rows}


def test_numbers_survive_packing():
    for values in ([], [0], [1, 2**32 - 1, 70_000]):
        assert S._unpacked(S._packed(np.array(values, np.int64)), len(values)).tolist() == values


def test_decoding_of_any_ids(spark):
    rows = [(0, None), (1, []), (2, [0, 1, 2]), (3, [3, 255, 264]), (4, [259, 264])]
    got = spark.createDataFrame(rows, "k int, ids array<int>").repartition(2).select("k", S.decode(F.col("ids"), PATH).alias("t")).collect()
    assert {r["k"]: r["t"] for r in got} == {k: None if ids is None else S._processor(PATH).decode(ids) for k, ids in rows}
