"""Ingest-side queries over the distributor workbooks derived from the tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.sources import grid
from salesmart.sources.tables import Source

AS_OF = datetime(2024, 1, 1)
FEED_COLUMNS = ["source_file", "sheet", "row_num", "sale_date", "invoice_number", "dist_product_code",
                "product_name_raw", "quantity", "unit_price", "discount_pct", "net_amount", "gross_amount",
                "discount_amount", "client_name_raw", "city_name_raw", "zone_code_raw", "margin_pct_raw",
                "distributor_code"]


def feed_parsed_rows(src: Source) -> DataFrame:
    """All six layouts parsed from the raw grid (A-6, A-7, C-1 ... C-10, H-1)."""
    return grid.read_all_profiles(grid.land_grid(src), AS_OF).select(*FEED_COLUMNS)


def landing_files(src: Source) -> DataFrame:
    """Workbook files found in the landing listing, with their distributor (A-8)."""
    files = grid.land_grid(src).select(F.col("file").alias("path")).distinct()
    return grid.discover_files(files).select("file_name", "distributor_code")
