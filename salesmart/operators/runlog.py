"""Side tables of the load jobs: run log (B-7), rejects (B-12), unmapped codes (B-5) and file ledger (B-10).

Every row belongs to a run, and a run's rows are one folder that a retry of the same run replaces
(:func:`put`): a batch that is run twice leaves each of these tables as after one run. What has to be added up
over runs is added up when it is read.

A run writes a RUNNING event when it starts and a SUCCESS / FAILED event when it ends; the current state of a
run is its latest event (``max_by``), so no row is ever updated in place and concurrent runs never conflict.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.swap import part_name
from salesmart.session import read_existing

RUN_SCHEMA = ("run_id string, pipeline_name string, source_system string, status string, event_at timestamp, "
              "records_read bigint, records_loaded bigint, records_rejected bigint, watermark_to timestamp, "
              "error_message string")
MAX_ERROR = 2000


def put(df: DataFrame, path: str, run_id: str, partition_by: Sequence[str] = ()) -> None:
    """The run's rows of a side table, in place of those of an earlier try."""
    folder = f"{path.rstrip('/')}/{part_name(df.sparkSession, 'batch', run_id)}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(folder)


def _event(spark: SparkSession, path: str, row: tuple) -> None:
    event = spark.createDataFrame([row], RUN_SCHEMA).coalesce(1)
    folder = f"{path.rstrip('/')}/{part_name(spark, 'batch', row[0])}/event={row[3]}"
    event.write.mode("overwrite").parquet(folder)


def start_run(spark, path: str, run_id: str, pipeline: str, source: str, at: datetime) -> None:
    _event(spark, path, (run_id, pipeline, source, "RUNNING", at, 0, 0, 0, None, None))


def complete_run(spark, path: str, run_id: str, pipeline: str, source: str, at: datetime, read: int = 0,
                 loaded: int = 0, rejected: int = 0, watermark_to: datetime | None = None,
                 status: str = "SUCCESS") -> None:
    _event(spark, path, (run_id, pipeline, source, status, at, read, loaded, rejected, watermark_to, None))


def fail_run(spark, path: str, run_id: str, pipeline: str, source: str, at: datetime, error: str) -> None:
    _event(spark, path, (run_id, pipeline, source, "FAILED", at, 0, 0, 0, None, error[:MAX_ERROR]))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All events of all runs; empty before the first."""
    log = read_existing(spark, path)
    columns = [c.split()[0] for c in RUN_SCHEMA.split(", ")]
    return spark.createDataFrame([], RUN_SCHEMA) if log is None else log.select(*columns)


def run_status(log: DataFrame) -> DataFrame:
    """One row per run: started_at, finished_at, duration and the latest state."""
    latest = F.max_by(F.struct("status", "records_read", "records_loaded", "records_rejected", "watermark_to",
                               "error_message"), "event_at")
    g = log.groupBy("run_id", "pipeline_name", "source_system").agg(
        F.min("event_at").alias("started_at"),
        F.max(F.when(F.col("status") != "RUNNING", F.col("event_at"))).alias("finished_at"),
        latest.alias("_l"))
    return g.select("run_id", "pipeline_name", "source_system", "started_at", "finished_at",
                    (F.unix_timestamp("finished_at") - F.unix_timestamp("started_at")).alias("duration_sec"),
                    "_l.*")


LEDGER_SCHEMA = "source_file string, distributor_code string, outcome string, reason string, rows bigint, at timestamp"


def file_ledger(status: DataFrame, parsed: DataFrame, at: datetime) -> DataFrame:
    """processed / rejected outcome per landed file (B-10), from each file's status and its parsed rows.

    A file is rejected for the reason its status names, or if it has no usable row.
    """
    per_file = parsed.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))
    j = status.join(per_file, status.file == per_file.source_file, "left")
    rows = F.coalesce("rows", F.lit(0)).cast("bigint")
    reason = F.coalesce(F.col("reason"), F.when(rows == 0, F.lit("no valid rows")))
    return j.select(F.col("file").alias("source_file"), "distributor_code",
                    F.when(reason.isNull(), F.lit("processed")).otherwise(F.lit("rejected")).alias("outcome"),
                    reason.alias("reason"), rows.alias("rows"), F.lit(at).cast("timestamp").alias("at"))
