"""Interactive validation queue (K-17, J-6): suggested corrections with a decision log.

Queue entries are the cleansing/mapping results that were not exact: city
spellings resolved with confidence below 1 and product codes mapped by
similarity. Each entry has a stable id (hash of type, distributor, raw
value). Reviewers' decisions are appended to a log; an entry's status is its
latest decision, PENDIENTE when it has none, whatever its confidence. The
confidence only gives the band in which the entry is shown.

The log is merged on read with a table of latest states: :func:`compact`
moves decisions there, so that reading does not grow with the log.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators import cleanse as cl
from salesmart.operators import swap
from salesmart.operators.matching import derive_mapping, map_product_codes
from salesmart.operators.runlog import put
from salesmart.plans.ingest import AS_OF
from salesmart.session import checkpoint_dir, materialize
from salesmart.sources import grid
from salesmart.sources.tables import Source

# FIXED VALUES: entry types, statuses, and confidence from which an entry is shown as high or medium.
CITY, PRODUCT = "CIUDAD", "PRODUCTO"
PENDING, APPROVED, REJECTED = "PENDIENTE", "APROBADO", "RECHAZADO"
HIGH, MEDIUM = 90.0, 75.0
DECISION_SCHEMA = "queue_id bigint, decision string, decided_at timestamp, decided_by string"
DECISION_COLUMNS = [c.split()[0] for c in DECISION_SCHEMA.split(", ")]
#: Derivation rule of the reviewers' decisions of the test data: of three entries, by id, one each is approved and rejected.
REVIEWER = "revisor"


def queue_id(*parts: str) -> Column:
    """Sixty bits of a hash of the entry's type, distributor and raw value."""
    text = F.concat_ws("|", *[F.coalesce(F.col(p), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def band(confidence: Column) -> Column:
    return F.when(confidence >= HIGH, "ALTA").when(confidence >= MEDIUM, "MEDIA").otherwise("BAJA")


def build_queue(src: Source) -> DataFrame:
    # distinct values first (a hash aggregate with map-side combine): what is cleansed and sorted is then a small part
    spelled = (grid.parsed_feed(src, AS_OF).select("distributor_code", "city_name_raw", "source_file", "extracted_at").distinct()
               .groupBy("distributor_code", "city_name_raw")
               .agg(F.min("source_file").alias("source_file"), F.min("extracted_at").alias("created_at")))
    c = (cl.clean_city(spelled, "city_name_raw").filter(F.col("city_match_confidence") < 1.0)
         .select(F.lit(CITY).alias("entry_type"), F.col("city_name_raw").alias("raw_value"),
                 F.col("city_name_clean").alias("suggested_value"), F.col("city_match_confidence").alias("conf"),
                 "distributor_code", "source_file", "created_at"))
    # a line's mapping follows from its distributor, code and description: each of these is mapped once, with its first
    # sighting, and the wide lines are neither joined nor written for the queue
    coded = materialize(grid.parsed_feed(src, AS_OF).groupBy("distributor_code", "dist_product_code", "product_name_raw")
                        .agg(F.min("source_file").alias("source_file"), F.min("extracted_at").alias("extracted_at")),
                        "feed-codes", compression="zstd")
    p = (map_product_codes(coded, derive_mapping(src)).filter(~F.col("mapping_exact"))
         .groupBy("distributor_code", "product_name_raw")
         .agg(F.first("sap_product_name").alias("suggested_value"),
              F.first("mapping_confidence").alias("conf"),
              F.min("source_file").alias("source_file"), F.min("extracted_at").alias("created_at"))
         .select(F.lit(PRODUCT).alias("entry_type"), F.col("product_name_raw").alias("raw_value"),
                 "suggested_value", "conf", "distributor_code", "source_file", "created_at"))
    q = c.unionByName(p)
    return q.select(queue_id("entry_type", "distributor_code", "raw_value").alias("queue_id"), "entry_type",
                    "raw_value", "suggested_value", F.round(F.col("conf") * 100, 1).alias("confidence_pct"),
                    F.col("distributor_code").alias("source_distributor"), "source_file", "created_at")


def reviewed(queue: DataFrame, at: datetime) -> DataFrame:
    """The reviewers' decisions of the test data (a fixed rule on the id; the confidence plays no part)."""
    turn = F.pmod("queue_id", F.lit(3))
    d = F.when(turn == 0, APPROVED).when(turn == 1, REJECTED)
    return (queue.select("queue_id", d.alias("decision"), F.lit(at).cast("timestamp").alias("decided_at"),
                         F.lit(REVIEWER).alias("decided_by")).filter(F.col("decision").isNotNull()))


def apply_decision(spark: SparkSession, log_path: str, queue_id: int, decision: str, at: datetime, by: str) -> None:
    """Append one reviewer decision (approve / reject) to the decision log."""
    if decision not in (APPROVED, REJECTED):
        raise ValueError(decision)
    put(spark.createDataFrame([(queue_id, decision, at, by)], DECISION_SCHEMA).coalesce(1), f"{log_path}/log", uuid.uuid4().hex)


def latest(decisions: DataFrame) -> DataFrame:
    """The last decision on each entry."""
    last = F.max_by(F.struct("decision", "decided_at", "decided_by"), F.struct("decided_at", "decision", "decided_by"))
    return decisions.groupBy("queue_id").agg(last.alias("d")).select("queue_id", "d.*")


def decisions(spark: SparkSession, log_path: str) -> DataFrame:
    """Latest decisions: the table of states merged with the log."""
    frames = [df.select(*DECISION_COLUMNS) for df in (swap.read(spark, f"{log_path}/states"), swap.read(spark, f"{log_path}/log"))
              if df is not None]
    out = spark.createDataFrame([], DECISION_SCHEMA)
    for df in frames:
        out = out.unionByName(df)
    return latest(out)


def compact(spark: SparkSession, log_path: str) -> None:
    """Move the log's decisions into the table of states; those that come meanwhile stay in the log.

    If it dies between its two steps the decisions stand in both, which changes no state.
    """
    log = swap.read(spark, f"{log_path}/log")
    if log is None:
        return
    files = log.inputFiles()
    swap.replace(materialize(decisions(spark, log_path), "decision-states"), f"{log_path}/states")
    for folder in {f.rpartition("/")[0] for f in files}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def with_status(queue: DataFrame, decided: DataFrame) -> DataFrame:
    d = latest(decided).select("queue_id", F.struct("decision", "decided_at", "decided_by").alias("_d"))
    j = queue.join(d, "queue_id", "left")
    return j.select(*queue.columns, F.coalesce(F.col("_d.decision"), F.lit(PENDING)).alias("status"),
                    F.col("_d.decided_at").alias("resolved_at"), F.col("_d.decided_by").alias("resolved_by"))


def decision_log(spark: SparkSession) -> str:
    """Where the reviewers' decisions are kept, unless the caller names another folder."""
    return spark.conf.get("salesmart.validation.decisions", f"{checkpoint_dir(spark).rstrip('/')}/validation-decisions")


_QUEUES: dict[tuple[str, str, str], DataFrame] = {}


def _queue_state(src: Source) -> DataFrame:
    """The validation queue (written once per version of the source's files) with today's statuses."""
    key = src.state_key()
    if key not in _QUEUES:
        _QUEUES[key] = materialize(build_queue(src), "validation-queue")
    q = _QUEUES[key]
    log = decisions(src.spark, decision_log(src.spark))
    return with_status(q, reviewed(q, AS_OF).unionByName(log))


def validation_status_counts(src: Source) -> DataFrame:
    return _queue_state(src).groupBy("status").agg(F.count(F.lit(1)).alias("entries"))


def validation_approval_rate(src: Source) -> DataFrame:
    s = _queue_state(src).filter(F.col("status") != PENDING)
    return s.agg(F.round(F.count_if(F.col("status") == APPROVED) * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0)), 1)
                 .alias("approval_rate_pct"), F.count(F.lit(1)).alias("resolved"))


def validation_pending(src: Source) -> DataFrame:
    return (_queue_state(src).filter(F.col("status") == PENDING)
            .select("queue_id", "entry_type", "raw_value", "suggested_value", "confidence_pct",
                    band(F.col("confidence_pct")).alias("confidence_band"), "source_distributor", "source_file", "created_at")
            .orderBy(F.desc("confidence_pct"), F.asc("queue_id")))


def validation_history(src: Source) -> DataFrame:
    return (_queue_state(src).filter(F.col("status") != PENDING)
            .select("entry_type", "raw_value", "suggested_value", "confidence_pct", "source_distributor", "status",
                    "resolved_at", "resolved_by")
            .orderBy(F.desc("resolved_at"), F.asc("raw_value")))


def validation_by_distributor(src: Source) -> DataFrame:
    return _queue_state(src).groupBy("source_distributor", "status").agg(F.count(F.lit(1)).alias("entries"))
