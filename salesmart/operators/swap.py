"""Replacing parts of a parquet table in one step (B-2, B-8, B-13).

New files are written beside the table, in a hidden folder. Then one small file, ``_pending.json``, appears by a
rename: from that moment the table has the new parts, whatever happens next. Then the parts are moved
into place, and the file goes. Readers that come through :func:`read` see the old table before the rename and
the new one after it, also if the writer died in between; the next writer finishes the move first.
Once the move is done the folder is an ordinary parquet table, for any reader.

One writer at a time: a second one cannot create the pending file while one is there.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

_PENDING = "_pending.json"


class _Folder:
    """The few file-system calls that a swap needs, of whatever store the table is in."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self._path(name))

    def names(self, name: str = "") -> list[str]:
        """What stands in a folder, without hidden files."""
        if not self.exists(name):
            return []
        found = [s.getPath().getName() for s in self.fs.listStatus(self._path(name))]
        return sorted(f for f in found if "=" in f or not f.startswith(("_", ".")))

    def parts(self, depth: int, name: str = "") -> list[str]:
        """Partition folders ``depth`` levels down; with no levels, the files."""
        below = [f"{name}/{f}" if name else f for f in self.names(name)]
        return below if depth <= 1 else [p for f in below for p in self.parts(depth - 1, f)]

    def move(self, source: str, target: str) -> None:
        self.fs.mkdirs(self._path(target).getParent())
        if not self.fs.rename(self._path(source), self._path(target)):
            raise OSError(f"{self.root}: cannot move {source} to {target}")

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self._path(name), False)
        out.write(text.encode())
        out.close()

    def text(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def part_name(spark: SparkSession, column: str, value) -> str:
    """Folder of a partition value, as Spark names it."""
    if value is None:
        return f"{column}=__HIVE_DEFAULT_PARTITION__"
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{column}={escape(str(value))}"


def stage(df: DataFrame, path: str, partition_by: list[str]) -> str:
    """Write ``df`` beside the table; returns the name of the hidden folder."""
    name = f"_staged/{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(f"{path.rstrip('/')}/{name}")
    return name


def commit(spark: SparkSession, path: str, staged: str, partition_by: list[str], gone: list[str]) -> None:
    """The staged parts replace the table's, and the parts in ``gone`` end; without partitions, all files do."""
    folder = _Folder(spark, path)
    depth = len(partition_by)
    new = folder.parts(depth, staged)
    new = [p.removeprefix(f"{staged}/") for p in new]
    old = sorted(set(gone) - set(new)) if depth else [f for f in folder.names() if f not in new]
    hidden = f"{staged}.json"
    folder.write(hidden, json.dumps({"staged": staged, "depth": depth, "new": new, "old": old}))
    folder.move(hidden, _PENDING)


def pending(spark: SparkSession, path: str) -> dict | None:
    folder = _Folder(spark, path)
    return json.loads(folder.text(_PENDING)) if folder.exists(_PENDING) else None


def finish(spark: SparkSession, path: str) -> None:
    """Move committed parts into place; does what is left to do, however often it is called."""
    state = pending(spark, path)
    if state is None:
        return
    folder, staged = _Folder(spark, path), state["staged"]
    away = f"_old/{staged.rpartition('/')[2]}"
    for part in state["new"]:
        if folder.exists(f"{staged}/{part}"):
            if folder.exists(part):
                folder.move(part, f"{away}/{part}")
            folder.move(f"{staged}/{part}", part)
    for part in state["old"]:
        if folder.exists(part):
            folder.move(part, f"{away}/{part}")
    folder.delete(_PENDING)
    folder.delete(staged)
    folder.delete(away)


def replace(df: DataFrame, path: str, partition_by: list[str] = (), gone: list[str] = ()) -> None:
    """Replace the parts that ``df`` has, and end those in ``gone`` (all other parts stay untouched)."""
    spark, partition_by = df.sparkSession, list(partition_by)
    finish(spark, path)
    commit(spark, path, stage(df, path, partition_by), partition_by, list(gone))
    finish(spark, path)


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as last committed, or None if there is none."""
    folder = _Folder(spark, path)
    state = pending(spark, path) if folder.exists() else None
    if state is None:
        return spark.read.parquet(path) if folder.names() else None
    staged, depth = state["staged"], state["depth"]
    waiting = [p for p in state["new"] if folder.exists(f"{staged}/{p}")]
    placed = [p for p in folder.parts(depth) if p not in {*waiting, *state["old"]}]
    frames = [spark.read.option("basePath", base).parquet(*[f"{base}/{p}" for p in parts])
              for base, parts in ((folder.root, placed), (f"{folder.root}/{staged}", waiting)) if parts]
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other)
    return out
