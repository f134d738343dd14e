"""Ingest invariants: upsert twice = once, stream in two batches = one batch load."""

import os
import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from salesmart.operators.matching import derive_mapping
from salesmart.plans import load_jobs as lj
from salesmart.sources import grid
from salesmart.sources.tables import Source
from salesmart.streaming.ingest import change_feed_stream, distributor_stream
from tests.conftest import SF_SMALL

AS_OF = datetime(2024, 1, 1)
MIN_DATE = "1992-01-01"
FIRST_WM = "1992-01-01 00:00:00"   # the test data predates the default first watermark


@pytest.fixture(scope="module")
def landed(spark):
    src = Source(spark, SF_SMALL)
    g = grid.derive_grids(src).repartition("file")
    root = tempfile.mkdtemp(prefix="salesmart-landing-")
    early = g.filter(F.substring("file", 8, 4) <= "1997")
    late = g.filter(F.substring("file", 8, 4) > "1997")
    early.write.partitionBy("distributor").parquet(f"{root}/drop1")
    late.write.partitionBy("distributor").parquet(f"{root}/drop2")
    return src, root


def _fact(spark, wh):
    return spark.read.parquet(wh.fact)


def test_batch_load_is_idempotent(spark, landed):
    src, root = landed
    wh = lj.Warehouse(tempfile.mkdtemp(prefix="salesmart-wh-"))
    g = spark.read.parquet(f"{root}/drop1").unionByName(spark.read.parquet(f"{root}/drop2"))
    dims, mapping = lj.default_dimensions(src), derive_mapping(src)
    first = lj.load_distributor_batch(spark, g, mapping, dims, wh, AS_OF, min_date=MIN_DATE)
    n = _fact(spark, wh).count()
    assert first["inserted"] == n and first["updated"] == 0 and n > 0
    before = sorted(_fact(spark, wh).drop("load_timestamp", "unresolved_keys").collect())
    second = lj.load_distributor_batch(spark, g, mapping, dims, wh, AS_OF, min_date=MIN_DATE)
    assert second["inserted"] == 0 and second["updated"] == n
    after = sorted(_fact(spark, wh).drop("load_timestamp", "unresolved_keys").collect())
    assert after == before
    # every parsed line is accounted for: loaded, rejected, or an older duplicate
    parsed = grid.read_all_profiles(g).count()
    assert lj.rejected_rows(spark, wh).count() == first.rejected + second.rejected and second.rejected == first.rejected
    assert first.read == parsed == n + first.rejected + first.duplicates and first.duplicates >= 0
    status = spark.read.parquet(wh.path("etl_run_log"))
    assert status.filter("status = 'SUCCESS'").count() == 2


def test_stream_equals_batch(spark, landed):
    src, root = landed
    dims, mapping = lj.default_dimensions(src), derive_mapping(src)
    batch_wh = lj.Warehouse(tempfile.mkdtemp(prefix="salesmart-wh-"))
    g = spark.read.parquet(f"{root}/drop1").unionByName(spark.read.parquet(f"{root}/drop2"))
    lj.load_distributor_batch(spark, g, mapping, dims, batch_wh, AS_OF, min_date=MIN_DATE)

    stream_wh = lj.Warehouse(tempfile.mkdtemp(prefix="salesmart-wh-"))
    landing = tempfile.mkdtemp(prefix="salesmart-stream-")
    os.rmdir(landing)
    # two drops land one after the other
    spark.read.parquet(f"{root}/drop1").write.parquet(landing)
    ckpt = tempfile.mkdtemp(prefix="salesmart-sckpt-")
    q = distributor_stream(spark, landing, mapping, dims, stream_wh, ckpt, AS_OF, min_date=MIN_DATE)
    q.awaitTermination()
    spark.read.parquet(f"{root}/drop2").write.mode("append").parquet(landing)
    q = distributor_stream(spark, landing, mapping, dims, stream_wh, ckpt, AS_OF, min_date=MIN_DATE)
    q.awaitTermination()
    a = _fact(spark, batch_wh).drop("load_timestamp")
    b = _fact(spark, stream_wh).drop("load_timestamp")
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0


def test_change_feed_watermark(spark):
    src = Source(spark, SF_SMALL)
    wh = lj.Warehouse(tempfile.mkdtemp(prefix="salesmart-wh-"))
    feed = lj.change_feed(src)
    first = lj.run_erp_incremental(spark, src, wh, AS_OF, min_date=MIN_DATE, initial_watermark=FIRST_WM)
    assert first["inserted"] > 0
    again = lj.run_erp_incremental(spark, src, wh, AS_OF, min_date=MIN_DATE, initial_watermark=FIRST_WM)
    assert again["inserted"] == 0 and again["updated"] == 0      # nothing newer than the watermark
    wm = spark.read.parquet(wh.path("watermarks")).first().last_value
    assert wm == feed.agg(F.max("changed_at")).first()[0]

    # streamed in two drops: same table as the batch
    landing = tempfile.mkdtemp(prefix="salesmart-cf-")
    os.rmdir(landing)
    feed.filter(F.year("sale_date") <= 1997).write.parquet(landing)
    swh = lj.Warehouse(tempfile.mkdtemp(prefix="salesmart-wh-"))
    ckpt = tempfile.mkdtemp(prefix="salesmart-sckpt-")
    dims = lj.default_dimensions(src)
    change_feed_stream(spark, landing, dims, swh, ckpt, AS_OF, min_date=MIN_DATE).awaitTermination()
    feed.filter(F.year("sale_date") > 1997).write.mode("append").parquet(landing)
    change_feed_stream(spark, landing, dims, swh, ckpt, AS_OF, min_date=MIN_DATE).awaitTermination()
    a = spark.read.parquet(wh.fact).drop("load_timestamp")
    b = spark.read.parquet(swh.fact).drop("load_timestamp")
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
