"""Oracle SQL for budget, load monitor, calendar and the defined reports."""

from __future__ import annotations

from salesmart.oracle_screens import C, S, mean_dec
from salesmart.oracle_sql import ORACLE, cents, rdiv
from salesmart.plans.reports import QUARTILES, SYSTEMS
from salesmart.sources.reference_data import DAY_NAMES_ES, HOLIDAYS, MONTH_NAMES_ES


def _list(xs) -> str:
    return "[" + ", ".join("'" + x + "'" for x in xs) + "]"


# ----------------------------------------------------------------------------- K-16
BUDGET = """, bud AS (
  SELECT year + 1 AS year, month_num,
         CAST(year + 1 AS VARCHAR) || '-' || lpad(CAST(month_num AS VARCHAR), 2, '0') AS year_month,
         zone_key, salesperson_key, category, ROUND(SUM(net_amount) * 1.05, 2) AS budget_amount
  FROM sales GROUP BY year, month_num, zone_key, salesperson_key, category),
budz AS (SELECT b.*, z.zone_name FROM bud b JOIN zones z USING (zone_key))
"""


def bva(key: str) -> str:
    ach = ("COALESCE(" + rdiv("CAST(COALESCE(a.actual, 0) AS HUGEINT) * 100", "CAST(b.budget AS HUGEINT)", 1)
           + ", 0)")
    return BUDGET + f""", bg AS (SELECT {key}, ROUND(SUM(budget_amount), 0) AS budget FROM budz GROUP BY {key}),
ac AS (SELECT {key}, ROUND(SUM(net_amount), 0) AS actual FROM sales GROUP BY {key}),
res AS (
SELECT b.{key}, CAST(b.budget AS DOUBLE) AS budget, CAST(COALESCE(a.actual, 0) AS DOUBLE) AS actual,
       {ach} AS achievement_pct, CAST(ROUND(COALESCE(a.actual, 0) - b.budget, 0) AS DOUBLE) AS variance
FROM bg b LEFT JOIN ac a USING ({key}))
"""


ORACLE["budget_vs_actual_month"] = S(bva("year_month") + "SELECT * FROM res")
ORACLE["budget_vs_actual_category"] = S(bva("category") + "SELECT * FROM res")
ORACLE["budget_vs_actual_zone"] = S(bva("zone_name") + """SELECT *, CASE WHEN achievement_pct >= 100 THEN 'green'
  WHEN achievement_pct >= 85 THEN 'amber' ELSE 'red' END AS band FROM res""")

# ----------------------------------------------------------------------------- K-18
RUNS = f"""WITH runs AS (
  SELECT event_id AS run_id,
         CASE WHEN CAST(user_id % 8 AS INTEGER) < 2 THEN 'INCREMENTAL' ELSE 'FILE' END AS run_type,
         {_list(SYSTEMS)}[CAST(user_id % 8 AS INTEGER) + 1] AS source_system,
         ts AS started_at,
         CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'signup' THEN 'WARNING' ELSE 'SUCCESS' END
           AS status,
         CAST(floor(value * 100) AS BIGINT) AS records_read,
         CASE WHEN event_type = 'error' THEN CAST(0 AS BIGINT) ELSE CAST(floor(value * 100) AS BIGINT) END
           AS records_loaded,
         CAST(ts AS DATE) AS run_date
  FROM events)
"""
ORACLE["etl_latest_day"] = RUNS + """
SELECT MAX(run_date) AS run_date, COUNT(*) AS runs, CAST(SUM(records_loaded) AS BIGINT) AS records_loaded,
       COUNT(*) FILTER (WHERE status = 'ERROR') AS errors
FROM runs WHERE run_date = (SELECT MAX(run_date) FROM runs)"""
ORACLE["etl_success_summary"] = RUNS + f"""
SELECT {rdiv("COUNT(*) FILTER (WHERE status = 'SUCCESS') * 100", "COUNT(*)", 3)} AS success_rate_pct,
       COUNT(*) FILTER (WHERE status = 'ERROR') AS error_count FROM runs"""
ORACLE["etl_daily_status"] = RUNS + """
SELECT run_date, COUNT(*) FILTER (WHERE status = 'SUCCESS') AS SUCCESS,
       COUNT(*) FILTER (WHERE status = 'WARNING') AS WARNING, COUNT(*) FILTER (WHERE status = 'ERROR') AS ERROR
FROM runs GROUP BY run_date"""
ORACLE["etl_by_system"] = RUNS + "SELECT source_system, status, COUNT(*) AS runs FROM runs GROUP BY source_system, status"
ORACLE["etl_records_per_day"] = RUNS + """
SELECT run_date, CAST(SUM(records_loaded) AS BIGINT) AS records_loaded FROM runs GROUP BY run_date"""
ORACLE["etl_latest_runs"] = RUNS + "SELECT * FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 30"

# ----------------------------------------------------------------------------- A-12
HOL = "(VALUES " + ", ".join(f"('{m}', '{n}')" for m, n in HOLIDAYS) + ") AS h(mm_dd, holiday_name)"
ORACLE["sales_calendar"] = f"""
WITH spine AS (
  SELECT CAST(d AS DATE) AS full_date
  FROM (SELECT generate_series(CAST(MIN(o_orderdate) AS DATE), CAST(MAX(o_orderdate) AS DATE), INTERVAL 1 DAY) AS s
        FROM orders) t, unnest(t.s) AS u(d))
SELECT CAST(year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS INTEGER) AS date_key, full_date,
       CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
       CAST(month(full_date) AS INTEGER) AS month_num, {_list(MONTH_NAMES_ES)}[month(full_date)] AS month_name,
       substr({_list(MONTH_NAMES_ES)}[month(full_date)], 1, 3) AS month_name_short,
       CAST(weekofyear(full_date) AS INTEGER) AS week_num, CAST(day(full_date) AS INTEGER) AS day_of_month,
       CAST(isodow(full_date) AS INTEGER) AS day_of_week, {_list(DAY_NAMES_ES)}[isodow(full_date)] AS day_name,
       isodow(full_date) >= 6 AS is_weekend, CAST(year(full_date) AS INTEGER) AS fiscal_year,
       CAST(quarter(full_date) AS INTEGER) AS fiscal_quarter, strftime(full_date, '%Y-%m') AS year_month,
       h.holiday_name IS NOT NULL AS is_holiday, h.holiday_name
FROM spine LEFT JOIN {HOL} ON h.mm_dd = strftime(full_date, '%m-%d')"""

# ----------------------------------------------------------------------------- K-20
ORACLE["pareto_products"] = S(f""", g AS (
  SELECT product_key, product_name, SUM(net_amount) AS n FROM sales GROUP BY product_key, product_name),
r AS (SELECT *, SUM(n) OVER (ORDER BY n DESC, product_key ROWS UNBOUNDED PRECEDING) AS cum,
             SUM(n) OVER () AS total FROM g),
p AS (SELECT *, {rdiv(cents('cum') + ' * 100', cents('total'), 2)} AS pct FROM r)
SELECT product_key, product_name, CAST(n AS DOUBLE) AS net, CAST(cum AS DOUBLE) AS cumulative_net,
       pct AS cumulative_pct, CASE WHEN pct <= 80 THEN 'A' WHEN pct <= 95 THEN 'B' ELSE 'C' END AS abc_class
FROM p""")
ORACLE["month_over_month"] = S(f""", m AS (SELECT year_month, SUM(net_amount) AS n FROM sales GROUP BY year_month),
l AS (SELECT *, LAG(n, 1) OVER (ORDER BY year_month) AS p FROM m)
SELECT year_month, CAST(n AS DOUBLE) AS net, CAST(p AS DOUBLE) AS prev_net,
       CASE WHEN p > 0 THEN {rdiv(cents('n - p') + ' * 100', cents('p'), 2)} END AS change_pct FROM l""")
ORACLE["ytd_sales"] = S(""", m AS (SELECT year, month_num, SUM(net_amount) AS n FROM sales GROUP BY year, month_num)
SELECT year, month_num, CAST(n AS DOUBLE) AS net,
       CAST(SUM(n) OVER (PARTITION BY year ORDER BY month_num ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS ytd_net
FROM m""")
_Q = ", ".join(f"MAX(CASE WHEN pos = GREATEST(1, CAST(ceil(cnt * {q}) AS INTEGER)) THEN CAST(ticket AS DOUBLE) END)"
               f" AS {name}" for name, q in QUARTILES)
ORACLE["ticket_quartiles"] = S(f""", inv AS (
  SELECT client_type, invoice_number, SUM(net_amount) AS ticket FROM sales GROUP BY client_type, invoice_number),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY client_type ORDER BY ticket, invoice_number) AS pos,
             COUNT(*) OVER (PARTITION BY client_type) AS cnt FROM inv)
SELECT client_type, {_Q} FROM r GROUP BY client_type""")
ORACLE["lab_top_product"] = S(""", p AS (
  SELECT lab_name, product_key, product_name, SUM(net_amount) AS n FROM sales GROUP BY lab_name, product_key, product_name),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lab_name ORDER BY n DESC, product_key) AS rn,
             SUM(n) OVER (PARTITION BY lab_name) AS t FROM p)
SELECT lab_name, CAST(t AS DOUBLE) AS net, product_name AS top_product FROM r WHERE rn = 1""")
ORACLE["distributor_contribution"] = S(f""", g AS (
  SELECT distributor_name, SUM(net_amount) AS n FROM sales GROUP BY distributor_name)
SELECT distributor_name, CAST(n AS DOUBLE) AS net,
       {rdiv(cents('n') + ' * 100', cents('SUM(n) OVER ()'), 2)} AS share_pct FROM g""")
ORACLE["category_waterfall"] = S(""", g AS (SELECT category, SUM(net_amount) AS n FROM sales GROUP BY category)
SELECT category, CAST(n AS DOUBLE) AS net,
       CAST(SUM(n) OVER (ORDER BY n DESC, category ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_net FROM g""")
ORACLE["achievement_by_zone"] = C(""", fz AS (SELECT f.*, z.zone_name FROM fcm f JOIN zones z USING (zone_key))
SELECT zone_name, year_month,
       COALESCE(CASE WHEN SUM(target_amount) > 0 THEN """
                                  + rdiv(cents("SUM(sales_amount)") + " * 100", cents("SUM(target_amount)"), 3)
                                  + """ END, 0) AS achievement_pct
FROM fz GROUP BY zone_name, year_month""")
ORACLE["seller_month_heatmap"] = C("SELECT full_name, year, " + ", ".join(
    f"first(CAST(achievement_pct AS DOUBLE)) FILTER (WHERE month_num = {i}) AS month_{i}" for i in range(1, 13)) + """
FROM fcm GROUP BY full_name, year""")
ORACLE["category_zone_margin_heatmap"] = S(f"""
SELECT category, zone_name, {mean_dec('margin_pct', 3, 3)} AS margin_pct FROM sales GROUP BY category, zone_name""")
ORACLE["top_clients_by_ticket"] = S(f""", g AS (
  SELECT client_key, client_name, SUM(net_amount) AS n, COUNT(DISTINCT invoice_number) AS invoices
  FROM sales GROUP BY client_key, client_name),
t AS (SELECT *, {rdiv(cents('n'), 'invoices * 100', 2)} AS avg_ticket FROM g)
SELECT client_key, client_name, invoices, CAST(ROUND(n, 2) AS DOUBLE) AS net, avg_ticket
FROM t ORDER BY avg_ticket DESC, client_key LIMIT 20""")
