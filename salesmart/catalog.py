"""Registry of the queries exposed to the driver: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesmart.plans import marts
from salesmart.sources.tables import Source

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn: Callable[[Source], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir, _fn=fn: _fn(Source(spark, sf_dir))
        return fn
    return deco


register("mart_monthly_zone")(marts.monthly_zone)
register("mart_sales_yoy")(marts.sales_yoy)
register("mart_top_clients")(marts.top_clients)
register("mart_product_margin")(marts.product_margin)
register("mart_sales_by_city")(marts.sales_by_city)
register("mart_sales_by_category")(marts.sales_by_category)
register("mart_avg_ticket")(marts.avg_ticket)
register("mart_distributor_vs_internal")(marts.distributor_vs_internal)
register("client_year_ranking")(marts.client_year_ranking)

from salesmart.operators import commission  # noqa: E402

register("mart_commission_monthly")(commission.commission_monthly)

from salesmart.plans import screens  # noqa: E402

SCREENS = [
    "home_kpis",
    "home_zone_trend",
    "home_zone_share",
    "home_top_products",
    "home_category_totals",
    "map_city_sales",
    "map_top_cities",
    "map_zone_rollup",
    "zone_monthly",
    "zone_totals",
    "zone_yearly",
    "zone_month_pivot",
    "client_ranking",
    "client_type_mix",
    "client_top20",
    "product_ranking",
    "product_rx_otc",
    "product_top15",
    "commission_list",
    "commission_summary",
    "commission_last_month",
    "evolution_monthly",
    "evolution_totals",
    "yoy_by_month",
    "yoy_latest_totals",
    "lab_monthly",
    "lab_totals",
    "lab_top6_trend",
    "dist_monthly",
    "dist_type_trend",
    "dist_kpis",
    "margin_by_product",
    "margin_top15",
    "margin_extremes",
    "margin_heatmap",
    "ticket_detail",
    "ticket_overall",
    "ticket_by_type",
    "ticket_by_zone",
    "ticket_by_month",
    "category_detail",
    "category_tree",
    "category_rx_otc",
    "category_top5_trend",
    "seller_monthly",
    "seller_ranking",
    "seller_top6_trend",
    "target_overview",
    "target_bands",
    "target_trend",
]
for _n in SCREENS:
    register(_n)(getattr(screens, _n))

from salesmart.plans import ingest  # noqa: E402

register("feed_parsed_rows")(ingest.feed_parsed_rows)
register("landing_files")(ingest.landing_files)

from salesmart.plans import reports  # noqa: E402

REPORTS = [
    "budget_vs_actual_month", "budget_vs_actual_zone", "budget_vs_actual_category",
    "etl_latest_day", "etl_success_summary", "etl_daily_status", "etl_by_system", "etl_records_per_day",
    "etl_latest_runs", "sales_calendar",
    "pareto_products", "month_over_month", "ytd_sales", "ticket_quartiles", "lab_top_product",
    "distributor_contribution", "category_waterfall", "achievement_by_zone", "seller_month_heatmap",
    "category_zone_margin_heatmap", "top_clients_by_ticket",
]
for _n in REPORTS:
    register(_n)(getattr(reports, _n))

from salesmart.plans import cleansing_queries as cq  # noqa: E402

CLEANSING = [
    "clean_text_documents", "title_case_documents", "client_names_clean", "tax_ids_clean", "zone_codes_clean",
    "dedup_order_lines", "date_validation", "numeric_validation", "city_cleansing", "product_code_mapping",
    "unmapped_products", "product_name_cleansing",
]
for _n in CLEANSING:
    register(_n)(getattr(cq, _n))

from salesmart.plans import governance, validation  # noqa: E402

for _n in ["quality_log", "referential_integrity", "open_issues", "secure_zone_sales", "national_zone_sales",
           "staging_payloads", "fact_upsert_merge", "resolved_feed_facts"]:
    register(_n)(getattr(governance, _n))
for _n in ["validation_status_counts", "validation_approval_rate", "validation_pending", "validation_history",
           "validation_by_distributor"]:
    register(_n)(getattr(validation, _n))

from salesmart.plans import admin  # noqa: E402
from salesmart.sources import extracts  # noqa: E402

for _n in ["sales_csv_roundtrip", "erp_changes_since", "historical_extract", "previous_month_extract",
           "master_clients", "master_products", "seed_salespeople", "sql_zone_year_sales"]:
    register(_n)(getattr(extracts, _n))
for _n in ["filter_options", "load_summary_by_year", "home_kpis_last_12m", "feed_quality_counters", "home_kpis_selected",
           "home_category_selected", "zone_monthly_period", "client_type_mix_period", "commission_list_selected"]:
    register(_n)(getattr(admin, _n))
