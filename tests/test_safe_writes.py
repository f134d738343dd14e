"""Writes that must not lose, double or keep rows: clear-and-reload, moved keys, unreadable tables."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from salesmart.operators.ranking import rank_over
from salesmart.operators.upsert import upsert_table
from salesmart.session import read_existing, require_local
from tests.helpers import rows


def test_reload_leaves_no_old_partition(spark):
    path = tempfile.mkdtemp() + "/t"
    for years in ((2001, 2002), (2002,)):
        spark.createDataFrame([(1, y) for y in years], "k int, year int").write.mode("overwrite").partitionBy("year").parquet(path)
    assert rows(spark.read.parquet(path), "k", "year") == [(1, 2002)]


def test_upsert_moves_a_row_between_partitions(spark):
    path = tempfile.mkdtemp() + "/t"
    make = lambda v, y: spark.createDataFrame([(7, v, y)], "k int, v int, year int")
    assert upsert_table(spark, path, make(1, 2001), ["k"], ["v", "year"], "year") == {"inserted": 1, "updated": 0}
    assert upsert_table(spark, path, make(2, 2002), ["k"], ["v", "year"], "year") == {"inserted": 0, "updated": 1}
    assert rows(spark.read.parquet(path), "k", "v", "year") == [(7, 2, 2002)]


def test_unreadable_table_is_no_missing_table(spark):
    root = tempfile.mkdtemp()
    assert read_existing(spark, root + "/none") is None
    os.makedirs(root + "/bad")
    with open(root + "/bad/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):  # noqa: B017
        read_existing(spark, root + "/bad")


def test_cluster_needs_a_shared_folder():
    for master in ("local", "local[4]", "local[*]"):
        require_local(master)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            require_local(master)


def test_row_numbers_keep_null_and_repeated_rows(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, 1), ("a", 2)], "g string, x int")
    got = rank_over(df, ["g"], [("x", False)], out="r", method="row_number").groupBy("g").agg(
        F.sort_array(F.collect_list("r")).alias("r"))
    assert sorted((r.g or "", list(r.r)) for r in got.collect()) == [("", [1]), ("a", [1, 2, 3])]
