"""Raw workbook rows staged as named JSON payloads, and what of them is not loaded yet (B-1, C-16).

A payload maps the sheet's header texts to the row's cells; header, title and empty rows are no data and are
not staged. Staging a batch again replaces it. Which rows are processed follows from the file ledger that the load
job writes, by an anti-join: nothing in the staging table is ever updated.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.runlog import put
from salesmart.session import materialize, read_existing
from salesmart.sources.grid import layout


def _names(header: Column) -> Column:
    """Header texts as keys: nameless columns by their place, repeated names with it."""
    def name(h: Column, i: Column) -> Column:
        place = (i + 1).cast("string")
        named = F.coalesce(F.nullif(F.trim(h), F.lit("")), F.concat(F.lit("column "), place))
        return F.when(F.array_position(header, h) < i + 1, F.concat(named, F.lit(" "), place)).otherwise(named)

    return F.transform(header, name)


def payloads(grid: DataFrame, at: datetime) -> DataFrame:
    """distributor_id, file_name, sheet, row_num, raw_data (JSON by header text), extracted_at: the data rows."""
    code, in_sheet, header_row = layout()
    g = grid.withColumns({"code": code, "header_row": header_row}).where(in_sheet)
    # a table of known size: the data rows are shuffled only if it is too large to send
    header = materialize(g.where("row_num = header_row").select("file", "sheet", F.col("cells").alias("header")), "staging-headers")
    data = g.where(F.col("row_num") > F.col("header_row")).where(F.exists("cells", lambda c: c.isNotNull()))
    values = F.transform("header", lambda _, i: F.get(F.col("cells"), i))
    return data.join(header, ["file", "sheet"]).select(
        F.col("code").alias("distributor_id"), F.col("file").alias("file_name"), "sheet", "row_num",
        F.to_json(F.map_from_arrays(_names(F.col("header")), values)).alias("raw_data"),
        F.lit(at).cast("timestamp").alias("extracted_at"))


def stage(grid: DataFrame, path: str, run_id: str, at: datetime) -> None:
    put(payloads(grid, at), path, run_id)


def unprocessed(staged: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Staged rows of files that no load has processed; a file staged in two batches counts once."""
    rows = staged.drop("batch")
    if ledger is not None:   # before the copies of a row are looked for: these are then the open rows only
        done = ledger.where("outcome = 'processed'").select(F.col("source_file").alias("file_name")).distinct()
        rows = rows.join(materialize(done, "staging-done"), "file_name", "left_anti")
    return rows.dropDuplicates(["file_name", "sheet", "row_num"])


def waiting(spark: SparkSession, staging_path: str, ledger_path: str) -> DataFrame | None:
    staged = read_existing(spark, staging_path)
    return None if staged is None else unprocessed(staged, read_existing(spark, ledger_path))
