"""Filter options, load summaries, batch quality counters, mart refresh (E-18, E-20, E-21, C-23, B-8, I-5)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from salesmart.operators.commission import fact_commission
from salesmart.plans import marts, screens
from salesmart.plans.cleansing_queries import mapped_feed
from salesmart.plans.filters import Filters
from salesmart.sources import star
from salesmart.sources.tables import Source

LAST_12M_AS_OF = date(2001, 8, 2)


def filter_options(src: Source) -> DataFrame:
    """Values offered by the global filters (E-18): years, zones, categories, distributor types."""
    f = star.sales(src)
    parts = [f.select(F.lit("year").alias("option"), F.col("year").cast("string").alias("value")),
             star.zones(src).select(F.lit("zone").alias("option"), F.col("zone_name").alias("value")),
             star.products(src).select(F.lit("category").alias("option"), F.col("category").alias("value")),
             f.select(F.lit("distributor_type").alias("option"), F.col("distributor_type").alias("value"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def load_summary_by_year(src: Source) -> DataFrame:
    """Rows, invoices and net per year and zone as loaded (E-21)."""
    f = star.sales(src, product=False, include_deleted=True)
    return f.groupBy("year", "zone_name").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("invoice_number").alias("invoices"),
        F.sum("net_amount").cast("double").alias("net"), F.count_if("is_deleted").alias("deleted_rows"))


def home_kpis_last_12m(src: Source) -> DataFrame:
    """Home KPIs with the dashboard's default "last 12 months" filter (C-23)."""
    return screens.home_kpis(src, Filters(last_n_months=12, as_of=LAST_12M_AS_OF))


def quality_counters(df: DataFrame, name: str = "batch_quality") -> tuple[DataFrame, Observation]:
    """Per-batch data-quality counters collected while the batch flows through (E-20)."""
    obs = Observation(name)
    cols = df.columns
    metrics = [F.count(F.lit(1)).alias("rows")]
    if "quantity" in cols:
        metrics.append(F.count_if(F.col("quantity") <= 0).alias("invalid_quantity"))
    if "unit_price" in cols:
        metrics.append(F.count_if(F.col("unit_price") <= 0).alias("invalid_price"))
    if "net_amount" in cols:
        metrics.append(F.count_if(F.col("net_amount") < 0).alias("negative_net"))
    if "sale_date" in cols:
        metrics.append(F.count_if(F.col("sale_date").isNull()).alias("invalid_dates"))
    if "sap_product_id" in cols:
        metrics.append(F.count_if(F.col("sap_product_id").isNotNull()).alias("mapped"))
    return df.observe(obs, *metrics), obs


def feed_quality_counters(src: Source) -> DataFrame:
    """Quality counters and mapped share of every parsed workbook line, per distributor (E-20)."""
    return mapped_feed(src).groupBy("distributor_code").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("quantity") <= 0).alias("invalid_quantity"),
        F.count_if(F.col("unit_price") <= 0).alias("invalid_price"),
        F.count_if(F.col("net_amount").isNull()).alias("invalid_amounts"),
        F.count_if(F.col("sale_date").isNull()).alias("invalid_dates"),
        F.round(F.count("sap_product_id") * 100 / F.count(F.lit(1)), 1).alias("mapped_pct"))


# FIXED VALUES: a selection in each of the dashboard's global filters.
SELECTED = Filters(years=(1995, 1996, 1997), zones=("ASIA", "EUROPE"), categories=("PROMO", "ECONOMY"))
PERIOD = Filters(date_from=date(1996, 3, 15), date_to=date(1997, 2, 14), client_types=("BUILDING", "MACHINERY"),
                 distributor_types=("EXTERNO",))


def home_kpis_selected(src: Source) -> DataFrame:
    """Home KPIs of some years, zones and categories (C-14)."""
    return screens.home_kpis(src, SELECTED)


def home_category_selected(src: Source) -> DataFrame:
    """Category totals of some years, zones and categories (C-14)."""
    return screens.home_category_totals(src, SELECTED)


def zone_monthly_period(src: Source) -> DataFrame:
    """Monthly zone figures of a date range, some client types and one distributor type (C-24)."""
    return screens.zone_monthly(src, PERIOD)


def client_type_mix_period(src: Source) -> DataFrame:
    """Client mix of a date range, some client types and one distributor type (C-24)."""
    return screens.client_type_mix(src, PERIOD)


def commission_list_selected(src: Source) -> DataFrame:
    """Commissions of some years, taken from YYYY-MM, and zones (C-15)."""
    return screens.commission_list(src, SELECTED)


def refresh_marts(src: Source, root: str) -> dict[str, str]:
    """Write the materialised marts in dependency order (B-8); year-over-year reads the written monthly mart."""
    spark = src.spark
    out = {}
    mz_path = f"{root.rstrip('/')}/mv_sales_monthly_zone"
    marts.monthly_zone(src).write.mode("overwrite").partitionBy("year").parquet(mz_path)
    out["mv_sales_monthly_zone"] = mz_path
    mz = spark.read.parquet(mz_path)
    for name, df in [("mv_sales_yoy", marts.sales_yoy(src, mz)), ("mv_top_clients", marts.top_clients(src)),
                     ("mv_product_margin", marts.product_margin(src))]:
        p = f"{root.rstrip('/')}/{name}"
        df.write.mode("overwrite").partitionBy("year").parquet(p)
        out[name] = p
    from salesmart.operators.commission import commission_monthly
    p = f"{root.rstrip('/')}/mv_commission_monthly"
    commission_monthly(src).write.mode("overwrite").partitionBy("year").parquet(p)
    out["mv_commission_monthly"] = p
    return out


def refresh_commissions(src: Source, path: str, months: list[str]) -> None:
    """Recompute commissions of the given ``YYYY-MM`` months only (I-5): dynamic partition overwrite."""
    fc = fact_commission(src).filter(F.col("year_month").isin(months))
    (fc.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("year_month").parquet(path))
