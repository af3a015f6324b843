"""Publishing by numbered pointers: several writers, a reader in between, nothing torn."""

import threading

import pytest
from pyspark.sql import functions as F

from textloom.operators.bpe import BpeModel
from textloom.plans.storage import create_once, read_lines, scratch_path
from textloom.sources import artifacts, registry


def model(n):
    return BpeModel(["<unk>", "<pad>", "<bos>", "<eos>", "a", "b", *["ab" * (i + 1) for i in range(n)]], 2, [("a", "b", n)] * n)


def test_a_file_is_created_once(spark):
    path = scratch_path(spark, "once")
    won = []
    threads = [threading.Thread(target=lambda i=i: won.append((create_once(spark, path, f"{i}\n"), i))) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    winners = [i for done, i in won if done]
    assert len(won) == 8 and len(winners) == 1 and read_lines(spark, path) == [str(winners[0])]


def test_two_writers_and_a_reader(spark):
    path = scratch_path(spark, "models")
    artifacts.save_model(spark, model(1), path)
    numbers, seen, stop = [], [], threading.Event()

    def write(sizes):
        for n in sizes:
            numbers.append((artifacts.save_model(spark, model(n), path), n))

    def read():
        while not stop.is_set():
            got = artifacts.load_model(spark, path)
            seen.append(got == model(len(got.merges)))

    writers = [threading.Thread(target=write, args=(sizes,)) for sizes in ((2, 3, 4), (5, 6, 7))]
    reader = threading.Thread(target=read)
    for t in [*writers, reader]:
        t.start()
    for t in writers:
        t.join()
    stop.set()
    reader.join()
    assert sorted(v for v, _ in numbers) == [1, 2, 3, 4, 5, 6] and seen and all(seen)
    for version, n in numbers:
        assert artifacts.load_model(spark, path, version) == model(n)
    assert [r["version"] for r in registry.versions(spark, path).orderBy("version").collect()] == list(range(7))
    assert artifacts.load_model(spark, path) == model(dict(numbers)[6])


def test_a_pointer_in_the_making_is_passed_over(spark):
    path = scratch_path(spark, "models")
    assert not artifacts.has_model(spark, path)
    with pytest.raises(ValueError):
        registry.resolve(spark, path)
    artifacts.save_model(spark, model(2), path)
    assert create_once(spark, registry._pointer(path, 1), "")  # taken, not yet written
    assert artifacts.load_model(spark, path) == model(2)
    with pytest.raises(ValueError):
        registry.resolve(spark, path, 1)
    assert artifacts.save_model(spark, model(3), path) == 2 and artifacts.load_model(spark, path) == model(3)


def test_a_failed_write_publishes_nothing(spark):
    path = scratch_path(spark, "models")

    def fail(folder):
        spark.range(3).write.parquet(f"{folder}/vocab")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        registry.publish(spark, path, fail)
    assert not artifacts.has_model(spark, path) and registry.versions(spark, path).count() == 0


def test_retraining_keeps_the_version_before(spark):
    path = scratch_path(spark, "models")
    df = spark.createDataFrame([(i, "low lower newest") for i in range(3)], "row_id long, text string")
    first = artifacts.load_or_train(spark, path, df, max_merges=3)
    again = artifacts.load_or_train(spark, path, df.withColumn("text", F.lit("zz zz")), force_retrain=True)
    assert artifacts.load_model(spark, path, 0) == first and artifacts.load_model(spark, path) == again != first
