from pyspark.sql import Window
from pyspark.sql import functions as F

from salesmart.operators.ranking import rank_over


def _data(spark):
    rows = [("a", 1, 10.0), ("a", 2, 10.0), ("a", 3, 7.0), ("a", 4, None), ("b", 5, 3.0),
            ("b", 6, 3.0), ("b", 7, 3.0), (None, 8, 1.0), ("c", 9, 5.0)]
    return spark.createDataFrame(rows, "g string, k int, v double").repartition(3)


def test_rank_matches_window(spark):
    df = _data(spark)
    got = rank_over(df, ["g"], [("v", True)], out="r", tie_breakers=["k"])
    w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    want = df.withColumn("r", F.rank().over(w))
    assert sorted(got.select("k", "r").collect()) == sorted(want.select("k", "r").collect())


def test_row_number_global(spark):
    df = _data(spark)
    got = rank_over(df, [], [("v", True)], out="r", method="row_number", tie_breakers=["k"])
    w = Window.orderBy(F.col("v").desc_nulls_last(), F.col("k").asc())
    want = df.withColumn("r", F.row_number().over(w))
    assert sorted(got.select("k", "r").collect()) == sorted(want.select("k", "r").collect())


def test_row_number_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") % 97).alias("v"), F.col("id").alias("k")).repartition(16)
    got = rank_over(df, [], [("v", False)], out="r", method="row_number", tie_breakers=["k"])
    w = Window.orderBy("v", "k")
    want = df.withColumn("r", F.row_number().over(w))
    assert got.select("k", "r").exceptAll(want.select("k", "r")).count() == 0
    assert got.count() == 5000


def test_small_path_equals_distributed(spark):
    df = _data(spark)
    a = rank_over(df, ["g"], [("v", True)], out="r", small=True)
    b = rank_over(df, ["g"], [("v", True)], out="r")
    assert sorted(a.select("k", "r").collect()) == sorted(b.select("k", "r").collect())


def test_dimension_cache(spark):
    from salesmart.operators.resolve import DimensionCache
    calls = []

    def load():
        calls.append(1)
        return spark.range(5)

    c = DimensionCache({"d": load})
    assert c.get("d").count() == 5 and c.get("d").count() == 5
    assert len(calls) == 1
    c.invalidate("d")
    c.get("d")
    assert len(calls) == 2
    c.invalidate()
