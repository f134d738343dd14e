"""SparkSession construction and cluster-facing settings."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale; each one is only applied when the cluster
# (or the caller) has not already chosen a value.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # dimension tables of the star schema are broadcast by size (AQE re-plans
    # with runtime sizes); fact-sized sides never exceed this.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "salesmart") -> SparkSession:
    """Return the active session, or build a local one for tests/bench.

    On a cluster the session already exists (spark-submit); we only fill in
    settings that are unset.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        spark = active
    else:
        builder = SparkSession.builder.appName(app_name)
        builder = builder.master(master or os.environ.get("SALESMART_MASTER", "local[8]"))
        builder = builder.config("spark.driver.memory", os.environ.get("SALESMART_DRIVER_MEM", "16g"))
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        for k, v in DEFAULTS.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    conf = spark.conf
    for k, v in DEFAULTS.items():
        if conf.get(k, None) is None:
            conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def require_local(master: str) -> None:
    """Raise unless the master is a single local JVM (``local``, ``local[n]``, ``local[*]``)."""
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"master {master!r}: set spark.checkpoint.dir to a folder that all executors share")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder for lineage cuts.

    Uses ``spark.checkpoint.dir`` from the session (the cluster names a shared
    folder there). Only when it is unset on a local master, as in tests, a
    fresh local folder is created and set; a cluster without the setting is an
    error, as executors and the driver share no local folder.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        require_local(sc.master)
        current = tempfile.mkdtemp(prefix="salesmart-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def read_existing(spark: SparkSession, path: str):
    """The parquet table at ``path``, or None if no such folder exists; every other failure is raised."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return None
    return spark.read.parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that nothing refers to any more.

    They are dropped when the driver's garbage collector finds their plans gone; a driver with memory to spare may not
    collect for a whole query, and its executors' disks hold the shuffles of all steps meanwhile.
    """
    gc.collect()
    spark._jvm.System.gc()


def materialize(df, name: str, partition_by: list[str] | None = None, compression: str | None = None):
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (an executor loss re-reads files instead of recomputing
    the plan) and lets later scans prune by ``partition_by``. The shuffle files that fed it are dropped.
    """
    return materialize_parts([df], name, partition_by, compression)


def materialize_parts(parts, name: str, partition_by: list[str] | None = None, compression: str | None = None):
    """One table as of :func:`materialize` from several frames of the same columns, written one after the other.

    The shuffle files of a part are dropped before the next part is planned, so a table whose rows fall into parts
    that need nothing of each other takes the disk of one part at a time.
    """
    import uuid

    path = None
    for df in parts:
        spark = df.sparkSession
        path = path or f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
        w = df.write.mode("append")
        if compression:
            w = w.option("compression", compression)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        schema, cols = df.schema, df.columns
        del df, w
        release_shuffles(spark)
    # read back with the known schema: an empty result has no files to infer it from
    return spark.read.schema(schema).parquet(path).select(*cols)
