"""Oracle SQL for extracts, filter options, summaries."""

from __future__ import annotations

from salesmart.oracle_screens import S, TICKET0
from salesmart.oracle_sql import ORACLE, money, rdiv, with_sales
from salesmart.plans.admin import LAST_12M_AS_OF, PERIOD, SELECTED
from salesmart.sources.extracts import DELTA_AS_OF, ERP_LAST_LOADED, HISTORY_FROM, HISTORY_TO

ORACLE["sales_csv_roundtrip"] = S("""
SELECT invoice_number, invoice_line, sale_date AS full_date, product_key AS product_id, client_key AS client_id,
       zone_code, distributor_code, CAST(quantity AS DOUBLE) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(net_amount AS DOUBLE) AS net_amount, source_system FROM sales""")

HDR = """WITH h AS (
  SELECT o_orderkey AS invoice_number, o_custkey AS client_id, CAST(o_orderdate AS DATE) AS sale_date,
         o_totalprice AS total, o_orderdate + INTERVAL 18 HOUR AS changed_at FROM orders)
"""
ORACLE["erp_changes_since"] = HDR + f"SELECT * FROM h WHERE changed_at > TIMESTAMP '{ERP_LAST_LOADED}'"
ORACLE["historical_extract"] = HDR + (f"SELECT * FROM h WHERE sale_date >= DATE '{HISTORY_FROM}' "
                                      f"AND sale_date < DATE '{HISTORY_TO}'")
ORACLE["previous_month_extract"] = HDR + (
    f"SELECT * FROM h WHERE sale_date >= date_trunc('month', DATE '{DELTA_AS_OF}') - INTERVAL 1 MONTH "
    f"AND sale_date < date_trunc('month', DATE '{DELTA_AS_OF}')")
ORACLE["master_clients"] = """
SELECT CAST(c_custkey AS VARCHAR) AS client_id, c_name AS client_name, c_mktsegment AS client_type,
       c_nationkey AS city_key, c_acctbal AS credit_balance FROM customer WHERE c_acctbal > 0"""
ORACLE["master_products"] = """
SELECT p_partkey AS product_key, CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
       p_type AS category, CASE WHEN p_size <= 25 THEN 'RX' ELSE 'OTC' END AS rx_otc_flag, p_brand AS lab_name
FROM part"""
ORACLE["seed_salespeople"] = with_sales("""
SELECT sp.salesperson_key, sp.salesperson_id, sp.full_name, z.zone_code, z.zone_name,
       CAST(sp.commission_rate AS DOUBLE) AS commission_rate, CAST(sp.monthly_target AS DOUBLE) AS monthly_target
FROM sp JOIN zones z ON z.zone_key = sp.sp_zone_key""")
ORACLE["sql_zone_year_sales"] = S(f"""
SELECT zone_name, year, {money('SUM(net_amount)', 0)} AS net, COUNT(DISTINCT invoice_number) AS invoices
FROM sales GROUP BY zone_name, year""")
ORACLE["filter_options"] = with_sales("""
SELECT DISTINCT option, value FROM (
  SELECT 'year' AS option, CAST(year AS VARCHAR) AS value FROM sales
  UNION ALL SELECT 'zone', zone_name FROM zones
  UNION ALL SELECT 'category', category FROM prod
  UNION ALL SELECT 'distributor_type', distributor_type FROM sales)""")
ORACLE["load_summary_by_year"] = with_sales("""
SELECT year, zone_name, COUNT(*) AS rows, COUNT(DISTINCT invoice_number) AS invoices,
       CAST(SUM(net_amount) AS DOUBLE) AS net, COUNT(*) FILTER (WHERE is_deleted) AS deleted_rows
FROM sales GROUP BY year, zone_name""", include_deleted=True)
ORACLE["home_kpis_last_12m"] = S(f"""
SELECT {money('SUM(net_amount)', 0)} AS total_net,
       {rdiv('SUM(CAST(margin_pct * 1000 AS HUGEINT))', 'COUNT(margin_pct) * 1000', 2)} AS avg_margin,
       COUNT(DISTINCT invoice_number) AS invoices, COUNT(DISTINCT client_key) AS clients, {TICKET0}
FROM sales WHERE sale_date >= DATE '{LAST_12M_AS_OF}' - INTERVAL 12 MONTH""")


def _in(column: str, values: tuple) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


_SELECTED = " AND ".join([_in("year", SELECTED.years), _in("zone_name", SELECTED.zones), _in("category", SELECTED.categories)])
_PERIOD = " AND ".join([f"sale_date BETWEEN DATE '{PERIOD.date_from}' AND DATE '{PERIOD.date_to}'",
                        _in("client_type", PERIOD.client_types), "distributor_type = 'EXTERNO'"])
for _name, _of, _cond in (("home_kpis_selected", "home_kpis", _SELECTED), ("home_category_selected", "home_category_totals", _SELECTED),
                          ("zone_monthly_period", "zone_monthly", _PERIOD), ("client_type_mix_period", "client_type_mix", _PERIOD)):
    ORACLE[_name] = ORACLE[_of].replace("FROM sales", f"FROM sales WHERE {_cond}")
ORACLE["commission_list_selected"] = f"""
SELECT * FROM ({ORACLE['commission_list']})
WHERE {_in("CAST(split_part(year_month, '-', 1) AS INTEGER)", SELECTED.years)} AND {_in("zone_name", SELECTED.zones)}"""
