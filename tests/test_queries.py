"""Every registered query against its SQL on the smallest scale folder."""

import os

import pytest

from oracle import compare, connect
from textloom.queries import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


# Too long to unroll in SQL; compared with brute force in test_bpe.py and test_generation.py.
WITHOUT_SQL = {"bpe_full_merges", "generate_sampled_alias"}


def test_every_other_query_has_sql():
    assert set(QUERIES) - WITHOUT_SQL == set(SQL)


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, con, name):
    assert compare(spark, con, SF_DIR, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("partitions", [1, 3])
@pytest.mark.parametrize("name", ["split_train", "batches", "metric_window", "heldout_perplexity", "generate_batch"])
def test_partitions_do_not_matter(spark, con, name, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        assert compare(spark, con, SF_DIR, QUERIES[name], SQL[name]) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["word", "n"] and df.count() > 0
