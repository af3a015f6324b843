"""Readers, configurations, sink, tokenizer tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

from textloom.plans import storage
from textloom.plans.storage import app_dir, exists, materialise, scratch_path
from textloom.sources import artifacts, datasets, files, sinks, snapshots

TEXTS = ['plain', 'with "quotes", commas', "two\nlines", "你好，世界", "tail "]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "n long, text string")


def test_csv_with_line_breaks(spark, corpus):
    path = scratch_path(spark, "csv")
    writer = corpus.repartition(2).write.option("header", "true").option("escape", '"')
    writer.option("ignoreTrailingWhiteSpace", "false").csv(path)
    assert sorted(r["text"] for r in files.scan(spark, path, "csv").collect()) == sorted(TEXTS)


def test_other_types_are_not_read(spark, corpus):
    path = scratch_path(spark, "mixed")
    corpus.write.json(path)
    corpus.select("text").limit(1).write.mode("append").text(path)
    assert files.scan(spark, path, "json").count() == len(TEXTS)
    assert files.scan(spark, path, "txt").count() == 1
    for missing in ("csv", "parquet"):
        with pytest.raises(ValueError):
            files.scan(spark, path, missing)
    with pytest.raises(ValueError):
        files.scan(spark, path + "-none", "json")


def test_scan_is_not_recursive(spark, corpus):
    path = scratch_path(spark, "nested")
    corpus.write.json(path)
    corpus.write.json(path + "/deeper")
    assert files.scan(spark, path, "json").count() == len(TEXTS)


def test_file_order(spark):
    path = scratch_path(spark, "ordered")
    df = spark.range(1000).select(F.concat(F.lit("line "), F.lpad("id", 4, "0")).alias("value"))
    df.repartitionByRange(3, "value").sortWithinPartitions("value").write.text(path)
    got = files.scan(spark, path, "txt", keep_order=True).orderBy(*files.ORDER_COLUMNS).collect()
    assert [r["text"] for r in got] == [f"line {i:04d}" for i in range(1000)]


def test_listing_is_sorted(spark, corpus):
    path = scratch_path(spark, "listing")
    corpus.repartition(3).write.parquet(path)
    names = [r["path"] for r in files.sorted_files(spark, path, "*.parquet").collect()]
    assert names == sorted(names) and len(names) == 3


def test_snapshots(spark, corpus):
    root = scratch_path(spark, "hub")
    corpus.write.parquet(f"{root}/set/test")
    corpus.limit(2).write.parquet(f"{root}/set/train")
    assert snapshots.scan_snapshot(spark, "set", root).count() == 5
    assert snapshots.scan_snapshot(spark, "set", root, "train").count() == 2
    for bad in (("none", None), ("set", "validation")):
        with pytest.raises(ValueError):
            snapshots.scan_snapshot(spark, bad[0], root, bad[1])


def test_config_errors(spark, corpus):
    for config in (
        {"source": "ftp", "data_dir": "x"},
        {"source": "local", "data_dir": "x"},
        {"data_dir": "x"},
        {"source": "huggingface", "data_dir": "x"},
        {"source": "modelscope", "dataset_id": "x"},
    ):
        with pytest.raises(ValueError):
            datasets.dataset_from_config(spark, config)
    with pytest.raises(ValueError):
        datasets.select_config({"select": "a", "configs": {"b": {}}})
    path = scratch_path(spark, "no-text")
    corpus.select("n").write.parquet(f"{path}/set/train")
    with pytest.raises(ValueError):
        datasets.dataset_from_config(spark, {"source": "HuggingFace", "dataset_id": "set", "data_dir": path})


def test_local_config_numbers_rows_in_file_order(spark):
    path = scratch_path(spark, "jsonl")
    rows = [(i, f"text {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "n long, text string")
    df.repartitionByRange(4, "n").sortWithinPartitions("n").write.json(path)
    config = {"data_dir": path, "type": "json"}
    train, validation = datasets.dataset_from_config(spark, config)
    order = sorted(range(50), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert {r["row_id"] for r in train.collect()} == set(order[:45])
    assert all(r["row_id"] == r["n"] for r in train.union(validation).collect())
    assert datasets.dataset_from_config(spark, config, split="validation").count() == 5
    with pytest.raises(ValueError):
        datasets.dataset_from_config(spark, config, split="test")


def test_corpus_sink(spark):
    path = scratch_path(spark, "sink")
    df = spark.createDataFrame([("a",), (None,), ("",), ("  ",), ("b\nc",), ("d\n\ne",)], "text string")
    sinks.write_corpus(df, path)
    assert sorted(r["text"] for r in sinks.read_corpus(spark, path).collect()) == ["  ", "a", "b\nc", "d", "e"]


def test_load_or_train(spark):
    path = scratch_path(spark, "tokenizer")
    df = spark.createDataFrame([(i, "low lower newest widest") for i in range(5)], "row_id long, text string")
    with pytest.raises(ValueError):
        artifacts.load_or_train(spark, path)
    fitted = artifacts.load_or_train(spark, path, df, max_merges=4)
    assert artifacts.load_or_train(spark, path) == fitted
    other = df.withColumn("text", F.lit("zz zz"))
    assert artifacts.load_or_train(spark, path, other) == fitted
    assert artifacts.load_or_train(spark, path, other, force_retrain=True) != fitted


def test_load_or_train_from_config(spark):
    data, path = scratch_path(spark, "data"), scratch_path(spark, "tokenizer")
    df = spark.createDataFrame([(i, f"low lower w{i % 3}") for i in range(20)], "n long, text string")
    df.write.parquet(f"{data}/set/train")
    with pytest.raises(ValueError):
        artifacts.load_or_train_from_config(spark, path)
    config = {"source": "modelscope", "dataset_id": "set", "data_dir": data}
    fitted = artifacts.load_or_train_from_config(spark, path, config, max_merges=3)
    assert artifacts.load_or_train_from_config(spark, path) == fitted and len(fitted.merges) == 3


def test_scratch_is_below_the_shared_folder(spark):
    path = scratch_path(spark, "x")
    assert path.startswith(app_dir(spark)) and path != scratch_path(spark, "x")


def test_own_folder_only_without_the_setting(spark, monkeypatch):
    monkeypatch.setattr(storage, "named_dir", lambda _: None)
    folder = storage.shared_dir(spark)
    assert folder.startswith("file://") and storage.shared_dir(spark) == folder
    kept = materialise(spark.range(5), "kept")
    assert kept.count() == 5 and exists(spark, app_dir(spark))
    storage.clear_scratch(spark)
    assert not exists(spark, app_dir(spark))


def test_files_read_in_several_splits_keep_their_order(spark):
    path = scratch_path(spark, "splits")
    df = spark.range(20000).select(F.concat(F.lit("line "), F.lpad("id", 6, "0")).alias("value"))
    df.repartitionByRange(2, "value").sortWithinPartitions("value").write.text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        scanned = files.scan(spark, path, "txt", keep_order=True)
        assert scanned.rdd.getNumPartitions() > 4
        got = files.number_rows(scanned).where(F.concat(F.lit("line "), F.lpad("row_id", 6, "0")) != F.col("text"))
        assert got.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_hidden_files_are_listed_and_never_lost(spark, tmp_path):
    for name in ("a.py", "src/__init__.py", "src/_x.py", ".gitignore"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x" * len(name))
    got = [(r["path"], r["length"]) for r in files.sorted_files(spark, str(tmp_path)).collect()]
    assert got == [(n, len(n)) for n in sorted(["a.py", "src/__init__.py", "src/_x.py", ".gitignore"])]
    assert [r["path"] for r in files.sorted_files(spark, str(tmp_path), "_*.py").collect()] == ["src/__init__.py", "src/_x.py"]
    (tmp_path / "z.txt").write_text("z")
    (tmp_path / "_y.txt").write_text("y")
    with pytest.raises(ValueError, match="_y.txt"):
        files.scan(spark, str(tmp_path), "txt")


def test_digits_in_a_csv_text_column_stay_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("text,n\n007,1\n42,2\n")
    scanned = files.scan(spark, str(tmp_path), "csv")
    assert sorted(r["text"] for r in scanned.collect()) == ["007", "42"]
    assert dict(scanned.dtypes)["n"] == "int"


def test_numbered_in_file_order_over_many_splits(spark):
    path = scratch_path(spark, "many")
    spark.range(500).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("value")).repartitionByRange(7, "value").sortWithinPartitions("value").write.text(path)
    rows = files.number_rows(files.scan(spark, path, "txt", keep_order=True)).collect()
    assert sorted((r["row_id"], int(r["text"])) for r in rows) == [(i, i) for i in range(500)]


ODD_CSV = 'n,text\n1,"two\nlines"\n\n2,short\n3\n4,a,b,c\n5,"quote ""q"""\n,\n6,last\n'
ODD_JSON = '{"n": 1, "text": "a"}\n\n{"n": 2\n[{"n": 3, "text": "c"}, {"n": 4, "text": "d"}]\n{"text": "no n"}\n{"n": "x", "text": "e"}\n'


@pytest.mark.parametrize("filetype, content, schema", [
    ("csv", ODD_CSV, None),
    ("csv", ODD_CSV, "n int, text string"),
    ("json", ODD_JSON, None),
    ("json", ODD_JSON, "n int, text string"),
    ("txt", "a\n\n  \nb\r\nc", None),
])
def test_numbers_do_not_depend_on_the_columns_read(spark, tmp_path, filetype, content, schema):
    for name in "abc":
        (tmp_path / f"{name}.{filetype}").write_text(content)
    scanned = files.scan(spark, str(tmp_path), filetype, schema, keep_order=True)
    written, n_written = files.numbered(scanned, frozen=True)
    read, n_read = files.numbered(scanned)
    assert n_read == n_written == written.count() == read.count()
    for columns in (["row_id"], ["row_id", "text"], read.columns):
        got = sorted(map(str, read.select(*columns).collect()))
        assert got == sorted(map(str, written.select(*columns).collect()))
    assert [r[0] for r in read.select("row_id").orderBy("row_id").collect()] == list(range(n_read))


def _parquet_in_order(spark, path, rows=20_000):
    df = spark.range(rows).select("id", F.concat(F.lit("text "), "id").alias("text"))
    writer = df.repartitionByRange(3, "id").sortWithinPartitions("id").write
    writer.option("parquet.block.size", 16_384).option("parquet.page.size", 2_048).parquet(path)


def test_parquet_numbers_survive_splits_and_pushed_filters(spark):
    path = scratch_path(spark, "indexed")
    _parquet_in_order(spark, path)
    changed = {"spark.sql.files.maxPartitionBytes": "30000", "spark.sql.files.minPartitionNum": "1"}
    numbered = files.number_rows(files.scan(spark, path, "parquet", keep_order=True))
    before = {name: spark.conf.get(name, None) for name in changed}
    try:
        for name, value in changed.items():  # split otherwise than when the rows were counted
            spark.conf.set(name, value)
        assert numbered.where("row_id != id").count() == 0
        some = numbered.where("id BETWEEN 12345 AND 12350 OR id = 7").select("row_id", "text")
        assert sorted(r["row_id"] for r in some.collect()) == [7, *range(12345, 12351)]
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(id,12345)" in plan
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_rows_split_otherwise_than_counted_are_noticed(spark):
    path = scratch_path(spark, "moved")
    spark.range(20_000).select(F.col("id").cast("string").alias("value")).coalesce(1).write.text(path)
    numbered = files.number_rows(files.scan(spark, path, "txt", keep_order=True))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        with pytest.raises(Exception, match="frozen=True"):
            numbered.select(F.sum("row_id")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_numbering_writes_one_row_per_split(spark, monkeypatch):
    path = scratch_path(spark, "narrow")
    _parquet_in_order(spark, path)
    kept = []

    def noted(df, label):
        kept.append(materialise(df, label))
        return kept[-1]

    monkeypatch.setattr(files, "materialise", noted)
    train, validation = datasets.dataset_from_config(spark, {"data_dir": path, "type": "parquet"})
    assert (train.count(), validation.count()) == (18_000, 2_000)
    assert [k.count() for k in kept] == [3]


def test_readers_that_drop_rows_are_numbered_as_written(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,text\n1,a\nbad,b\n3,c\n")
    config = {"data_dir": str(tmp_path), "type": "csv", "schema": "n int, text string", "train_ratio": 1}
    train = datasets.dataset_from_config(spark, {**config, "options": {"mode": "dropMalformed"}}, split="train")
    assert sorted((r["row_id"], r["text"]) for r in train.select("row_id", "text").collect()) == [(0, "a"), (1, "c")]


def test_no_rows_at_all(spark, tmp_path):
    (tmp_path / "a.txt").write_text("")
    numbered, rows = files.numbered(files.scan(spark, str(tmp_path), "txt", keep_order=True))
    assert rows == 0 and numbered.collect() == [] and numbered.columns == ["text", "row_id"]


def test_csv_of_a_large_table_is_many_files(spark, tmp_path, monkeypatch):
    """A file with quoted line breaks is one task, so a query that writes its CSV bounds the files."""
    from textloom.queries import source_queries as S

    rows = [(i, f'text "{i}"\nmore', "en", "web", 7) for i in range(500)]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    made.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(S, "ROWS_PER_FILE", 50)
    scanned = S.scan_csv(spark, str(tmp_path))
    assert len(scanned.inputFiles()) == 10
    assert sorted(r["doc_id"] for r in scanned.collect()) == list(range(500))
    numbered = S.config_local(spark, str(tmp_path)).collect()
    assert all(r["row_id"] == r["doc_id"] for r in numbered) and len(numbered) == 400
