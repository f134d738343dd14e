"""Source extracts (A-1 ... A-5, A-11, A-13).

* A-1  delimited files read with an explicit schema (no inference pass);
* A-2  change-feed rows after a watermark (a pushed filter on the scan);
* A-3  historical half-open date range; A-4 the previous calendar month;
* A-5  master-data scans with their filters and canonical names;
* A-11 literal seed rows joined to a dimension (broadcast);
* A-13 parameterised SQL: ``spark.sql`` with bound arguments, never string
  formatting of values.

Paging (LIMIT/OFFSET, keyset) has no equivalent here: a scan is split into
partitions by the reader.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import checkpoint_dir
from salesmart.sources import star
from salesmart.sources.reference_data import salespeople_df
from salesmart.sources.tables import Source

SALES_CSV_SCHEMA = ("invoice_number bigint, invoice_line int, full_date date, product_id bigint, client_id bigint, "
                    "zone_code string, distributor_code string, quantity double, unit_price double, "
                    "net_amount double, source_system string")


def read_delimited(spark: SparkSession, path: str, schema: str, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Header CSV with a fixed schema and typed date column (A-1)."""
    return spark.read.schema(schema).option("header", True).option("dateFormat", date_format).csv(path)


def sales_csv_roundtrip(src: Source) -> DataFrame:
    """The sales extract written as a header CSV and read back with its schema (A-1, B-11)."""
    f = star.sales(src)
    out = f.select(F.col("invoice_number"), "invoice_line", F.col("sale_date").alias("full_date"),
                   F.col("product_key").alias("product_id"), F.col("client_key").alias("client_id"), "zone_code",
                   "distributor_code", "quantity", "unit_price", "net_amount", "source_system")
    import uuid
    path = f"{checkpoint_dir(src.spark).rstrip('/')}/tables/sales-csv-{uuid.uuid4().hex[:12]}"
    out.write.option("header", True).csv(path)
    return read_delimited(src.spark, path, SALES_CSV_SCHEMA)


def changed_after(df: DataFrame, ts_col: str, watermark) -> DataFrame:
    """Rows strictly after the watermark (A-2)."""
    return df.filter(F.col(ts_col) > (watermark if not isinstance(watermark, (str, date)) else F.lit(watermark)))


def date_range(df: DataFrame, date_col: str, start, end) -> DataFrame:
    """Half-open [start, end) range (A-3)."""
    return df.filter((F.col(date_col) >= F.lit(start)) & (F.col(date_col) < F.lit(end)))


def previous_month(df: DataFrame, date_col: str, as_of: date) -> DataFrame:
    """The calendar month before ``as_of`` (A-4)."""
    this = F.trunc(F.lit(as_of), "month")
    return df.filter((F.col(date_col) >= F.add_months(this, -1)) & (F.col(date_col) < this))


ERP_LAST_LOADED = "2000-12-31 18:00:00"
HISTORY_FROM, HISTORY_TO = date(1995, 1, 1), date(1998, 1, 1)
DELTA_AS_OF = date(2001, 6, 15)


def _order_headers(src: Source) -> DataFrame:
    o = src.orders
    return o.select(o.o_orderkey.alias("invoice_number"), o.o_custkey.alias("client_id"),
                    F.to_date(o.o_orderdate).alias("sale_date"), o.o_totalprice.alias("total"),
                    (o.o_orderdate + F.expr("INTERVAL 18 HOURS")).alias("changed_at"))


def erp_changes_since(src: Source) -> DataFrame:
    """Order headers changed after the last loaded watermark (A-2)."""
    return changed_after(_order_headers(src), "changed_at", F.lit(ERP_LAST_LOADED).cast("timestamp"))


def historical_extract(src: Source) -> DataFrame:
    """Orders in the historical window [1995-01-01, 1998-01-01) (A-3)."""
    return date_range(_order_headers(src), "sale_date", HISTORY_FROM, HISTORY_TO)


def previous_month_extract(src: Source) -> DataFrame:
    """Orders of the month before the run date (A-4)."""
    return previous_month(_order_headers(src), "sale_date", DELTA_AS_OF)


def master_clients(src: Source) -> DataFrame:
    """Client master: customers with a positive balance count as active (A-5)."""
    c = src.customer
    return c.filter(c.c_acctbal > 0).select(
        c.c_custkey.cast("string").alias("client_id"), c.c_name.alias("client_name"),
        c.c_mktsegment.alias("client_type"), c.c_nationkey.alias("city_key"), c.c_acctbal.alias("credit_balance"))


def master_products(src: Source) -> DataFrame:
    """Product master with canonical names (A-5)."""
    return star.products(src).select("product_key", F.col("product_key").cast("string").alias("product_id"),
                                     "product_name", "category", "rx_otc_flag", "lab_name")


def seed_salespeople(src: Source) -> DataFrame:
    """Literal salesperson seed joined to the zone dimension by key (A-11)."""
    sp = salespeople_df(src.spark)
    z = star.zones(src)
    return sp.join(z, sp.sp_zone_key == z.zone_key).select(
        "salesperson_key", "salesperson_id", "full_name", "zone_code", "zone_name",
        F.col("commission_rate").cast("double").alias("commission_rate"),
        F.col("monthly_target").cast("double").alias("monthly_target"))


def sql_zone_year_sales(src: Source, digits: int = 0) -> DataFrame:
    """Parameterised SQL over a DataFrame (A-13): values are bound, not formatted in."""
    f = star.sales(src, product=False)
    return src.spark.sql(
        "SELECT zone_name, year, CAST(ROUND(SUM(net_amount), :digits) AS DOUBLE) AS net, "
        "COUNT(DISTINCT invoice_number) AS invoices FROM {f} GROUP BY zone_name, year",
        args={"digits": digits}, f=f)
