"""A table swap that dies half-way shows the old table or the new one, and the next writer finishes it."""

import tempfile

import pytest

from salesmart.operators import swap
from salesmart.operators.upsert import upsert_table
from tests.helpers import rows


class Died(Exception):
    pass


def dies(*_):
    raise Died


@pytest.fixture
def table(spark):
    path = tempfile.mkdtemp(prefix="salesmart-swap-") + "/t"

    def put(*data):
        return upsert_table(spark, path, spark.createDataFrame(list(data), "k int, v int, year int"), ["k"], ["v", "year"], "year",
                            touched=["year"])

    put((1, 10, 2001), (2, 20, 2002), (3, 30, 2003))
    return path, put


def content(spark, path):
    return rows(swap.read(spark, path), "k", "v", "year")


OLD = [(1, 10, 2001), (2, 20, 2002), (3, 30, 2003)]
NEW = [(1, 11, 2002), (2, 20, 2002), (3, 30, 2003), (4, 40, 2004)]
BATCH = [(1, 11, 2002), (4, 40, 2004)]


def test_before_the_commit_the_old_table_stands(spark, table, monkeypatch):
    path, put = table
    monkeypatch.setattr(swap, "commit", dies)
    with pytest.raises(Died):
        put(*BATCH)
    assert content(spark, path) == OLD == rows(spark.read.parquet(path), "k", "v", "year")
    monkeypatch.undo()
    assert put(*BATCH)["updated"] == 1
    assert content(spark, path) == NEW == rows(spark.read.parquet(path), "k", "v", "year")


@pytest.mark.parametrize("moves", [0, 1, 2, 3])
def test_after_the_commit_the_new_table_stands(spark, table, monkeypatch, moves):
    path, put = table
    move, done = swap._Folder.move, []

    def dying(self, source, target):
        if target != swap._PENDING:
            if len(done) == moves:
                raise Died
            done.append(target)
        move(self, source, target)

    monkeypatch.setattr(swap._Folder, "move", dying)
    with pytest.raises(Died):
        put(*BATCH)
    assert content(spark, path) == NEW
    monkeypatch.undo()
    put((5, 50, 2003))
    want = sorted([*NEW, (5, 50, 2003)])
    assert content(spark, path) == want == rows(spark.read.parquet(path), "k", "v", "year")
    assert swap.pending(spark, path) is None


@pytest.mark.parametrize("moves", [0, 1])
def test_tables_without_partitions(spark, monkeypatch, moves):
    path = tempfile.mkdtemp(prefix="salesmart-swap-") + "/t"
    make = lambda *v: spark.createDataFrame([(x,) for x in v], "k int").coalesce(1)
    assert swap.read(spark, path) is None
    swap.replace(make(1, 2), path)
    move, done = swap._Folder.move, []

    def dying(self, source, target):
        if target != swap._PENDING:
            if len(done) == moves:
                raise Died
            done.append(target)
        move(self, source, target)

    monkeypatch.setattr(swap._Folder, "move", dying)
    with pytest.raises(Died):
        swap.replace(make(3), path)
    assert rows(swap.read(spark, path), "k") == [(3,)]
    monkeypatch.undo()
    swap.finish(spark, path)
    assert rows(spark.read.parquet(path), "k") == [(3,)]


def test_touched_values_are_those_before_and_after(spark, table):
    _, put = table
    out = put((1, 11, 2002), (4, 40, 2004))
    assert rows(out["touched"], "year") == [(2001,), (2002,), (2004,)]


def test_other_partitions_keep_their_files(spark, table):
    import os
    path, put = table
    before = os.stat(f"{path}/year=2003").st_mtime_ns
    put((1, 12, 2001))
    assert os.stat(f"{path}/year=2003").st_mtime_ns == before


def test_partition_values_of_any_spelling(spark):
    path = tempfile.mkdtemp(prefix="salesmart-swap-") + "/t"
    put = lambda k, p: upsert_table(spark, path, spark.createDataFrame([(k, p)], "k int, p string"), ["k"], ["p"], "p")
    put(1, "a/b c=d")
    put(2, None)
    put(1, "x")
    put(2, "x")
    assert rows(spark.read.parquet(path), "k", "p") == [(1, "x"), (2, "x")]
