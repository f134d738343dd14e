"""Structured Streaming entry points (I-1 ... I-5).

Both feeds are file streams over a landing folder; each micro-batch is handed
to the batch job of ``plans.load_jobs`` through ``foreachBatch``. The stream
checkpoint records which files were processed (the extraction high-water mark
of the warehouse); the fact upsert is idempotent, so a micro-batch that is
re-run after a failure leaves the same table. ``trigger(availableNow=True)``
gives the scheduled "process what has landed, then stop" cadence.
"""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from salesmart.operators.resolve import Dimensions
from salesmart.plans.load_jobs import Refresh, Warehouse, load_change_feed_batch, load_distributor_batch


def _run_id(kind: str, checkpoint: str, batch_id: int) -> str:
    """The same for every try of a micro-batch: streams are told apart by their checkpoint folder."""
    return f"{kind}-{hashlib.sha256(checkpoint.encode()).hexdigest()[:12]}-{batch_id}"


GRID_STREAM_SCHEMA = "file string, sheet string, row_num bigint, cells array<string>, distributor string"


def distributor_stream(spark: SparkSession, landing_dir: str, mapping: DataFrame, dims: Dimensions,
                       wh: Warehouse, checkpoint: str, as_of: datetime, max_files: int = 1000,
                       min_date: str | None = None, available_now: bool = True,
                       refresh: Refresh | None = None) -> StreamingQuery:
    """Landed workbook grids -> fact table, one micro-batch per group of files (I-2)."""
    src = (spark.readStream.schema(GRID_STREAM_SCHEMA).option("maxFilesPerTrigger", max_files)
           .parquet(landing_dir))
    kw = {"min_date": min_date} if min_date else {}

    def run(batch: DataFrame, batch_id: int) -> None:
        load_distributor_batch(spark, batch, mapping, dims, wh, as_of, run_id=_run_id("workbooks", checkpoint, batch_id),
                               refresh=refresh, **kw)

    w = src.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    return w.start()


CHANGE_FEED_SCHEMA = ("invoice_number string, invoice_line int, sale_date date, sap_product_id bigint, "
                      "client_id string, client_name string, salesperson_key int, quantity double, "
                      "unit_price double, gross_amount double, discount_pct double, discount_amount double, "
                      "net_amount double, cost_amount double, city_name string, zone_code string, "
                      "changed_at timestamp")


def change_feed_stream(spark: SparkSession, landing_dir: str, dims: Dimensions, wh: Warehouse, checkpoint: str,
                       as_of: datetime, max_files: int = 1000, min_date: str | None = None,
                       available_now: bool = True, refresh: Refresh | None = None) -> StreamingQuery:
    """ERP change-feed drops -> fact table every 15 minutes (I-1)."""
    src = (spark.readStream.schema(CHANGE_FEED_SCHEMA).option("maxFilesPerTrigger", max_files)
           .parquet(landing_dir))
    kw = {"min_date": min_date} if min_date else {}

    def run(batch: DataFrame, batch_id: int) -> None:
        load_change_feed_batch(spark, batch, dims, wh, as_of, run_id=_run_id("changes", checkpoint, batch_id),
                               refresh=refresh, **kw)

    w = src.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="15 minutes")
    return w.start()
