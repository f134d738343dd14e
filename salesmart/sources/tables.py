"""Access to the raw source tables (one parquet dataset per table)."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

SOURCE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


@dataclass
class Source:
    """Lazily opened parquet tables under one directory.

    Reads are lazy: Catalyst prunes columns and pushes filters into each scan,
    so opening a table costs nothing until a plan uses it.
    """

    spark: SparkSession
    root: str
    # read the star from the loaded (denormalised, year-partitioned) fact table
    use_loaded_fact: bool = True
    _cache: dict = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.root.rstrip('/')}/{name}.parquet")
        return self._cache[name]

    def version(self) -> str:
        """Fingerprint of the files under ``root`` (names, sizes, times): it moves when data lands."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        files, found = fs.listFiles(path, True), []
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
        return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()

    def state_key(self) -> tuple[str, str, str]:
        """Key for what is derived from the source once: application, folder, version of its files."""
        return self.spark.sparkContext.applicationId, self.root, self.version()

    def __getattr__(self, name: str) -> DataFrame:
        if name in SOURCE_TABLES:
            return self.table(name)
        raise AttributeError(name)
