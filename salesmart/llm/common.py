"""Helpers shared by the operators: table access, lineage cuts, fixed-size bitmaps, components."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import checkpoint_dir, materialize

#: Rows in one Arrow batch: texts can be long, and a worker holds one batch at a time.
BATCH_ROWS = 256
#: Bits of a membership bitmap. Fixed, so its broadcast does not grow with the data;
#: a full bitmap only filters less, it never loses a row.
BITMAP_BITS = 1 << 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder known, Arrow batches small enough for long texts."""
    checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def save(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back; the shuffle files that fed it are dropped."""
    return materialize(df, name)


def discard(*saved: DataFrame) -> None:
    """Delete tables made by :func:`save` that nothing reads any more."""
    for df in saved:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _slot(col, bits: int):
    """Bit position of a key: its hash, cut to the bitmap's size."""
    return F.xxhash64(col).bitwiseAND(F.lit(bits - 1))


def bitmap_of(df: DataFrame, col: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """Membership bitmap of a column's values, at most ``bits / 64`` rows reach the driver."""
    words = (df.select(_slot(F.col(col), bits).alias("s"))
             .select(F.shiftrightunsigned("s", 6).alias("w"), F.expr("shiftleft(1L, cast(s & 63 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    out = np.zeros(bits // 64, dtype=np.int64)
    for batch in words.toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out


def maybe_in(df: DataFrame, col: str, bitmap: np.ndarray) -> DataFrame:
    """Rows whose key may be in the bitmap: a filter before a shuffle, exact joins follow."""
    shared = df.sparkSession.sparkContext.broadcast(bitmap)
    bits = bitmap.size * 64

    @F.pandas_udf("boolean")
    def hit(slot: pd.Series) -> pd.Series:
        s = slot.to_numpy()
        return pd.Series((shared.value[s >> 6] >> (s & 63)) & 1 == 1)

    return df.where(hit(_slot(F.col(col), bits)))


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """(a, b) links -> (node, comp): comp is the smallest node reachable.

    Alternating large-star and small-star rounds (Kiveris et al.): every round is joins and
    grouped minima, written to the shared folder; nothing is collected but a row count.
    """
    cur = save(edges.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u"))
               .where("u <> v").distinct(), f"{name}-cc")
    while True:
        both = cur.select("u", "v").unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        new = save(small, f"{name}-cc")
        star = new.agg(F.countDistinct("u").alias("k"), F.count("*").alias("n")).first()
        roots = new.select("v").distinct().join(new.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
        if star["k"] == star["n"] and roots.isEmpty():
            return new.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
                new.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
        cur = new
