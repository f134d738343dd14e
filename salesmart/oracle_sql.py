"""Reference SQL (DuckDB dialect) for the correctness check of every query.

The views ``region nation customer supplier part orders lineitem events ...``
are registered by the checker. ``SALES`` is the same star mapping as
``salesmart.sources.star.sales`` written as a CTE.

Exact agreement with Spark: money is DECIMAL; every ROUND of a ratio is done
with integer arithmetic (half away from zero, like NUMERIC rounding), so no
floating-point summation order can change a digit. ``rdiv(n, d, s)`` is
ROUND(n / d, s) for exact integers n, d, as DOUBLE.
"""

from __future__ import annotations

MONTHS = "['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre'," \
         "'Octubre','Noviembre','Diciembre']"


def rdiv(n: str, d: str, s: int) -> str:
    """ROUND(n/d, s) for exact integer expressions n, d; NULL when d = 0."""
    m = 10 ** s
    return (f"(CASE WHEN ({d}) = 0 OR ({d}) IS NULL OR ({n}) IS NULL THEN NULL ELSE "
            f"CAST(sign(({n})) * sign(({d})) * ((2 * abs(CAST(({n}) AS HUGEINT)) * {m} + abs(({d}))) "
            f"// (2 * abs(CAST(({d}) AS HUGEINT)))) AS DOUBLE) / {m} END)")


def cents(expr: str) -> str:
    """Exact integer cents of a DECIMAL(,2) expression."""
    return f"CAST(({expr}) * 100 AS HUGEINT)"


def mean3(col: str) -> str:
    """ROUND(AVG(col), 3) for a DECIMAL(,3) column."""
    return rdiv(f"SUM(CAST({col} * 1000 AS HUGEINT))", f"COUNT({col}) * 1000", 3)


def mean4(col: str) -> str:
    return rdiv(f"SUM(CAST({col} * 10000 AS HUGEINT))", f"COUNT({col}) * 10000", 4)


def per(sum_expr: str, den: str, s: int) -> str:
    """ROUND(SUM(money) / den, s)."""
    return rdiv(cents(sum_expr), f"({den}) * 100", s)


def money(expr: str, s: int = 2) -> str:
    return f"CAST(ROUND({expr}, {s}) AS DOUBLE)"


# Star fact (soft-deleted lines excluded unless the query selects them).
def sales_cte(include_deleted: bool = False) -> str:
    where = "" if include_deleted else "WHERE COALESCE(l_returnflag <> 'R', TRUE)"
    return f"""
li AS (
  SELECT l_orderkey AS invoice_number, l_linenumber AS invoice_line, l_partkey AS product_key,
         l_suppkey AS supplier_key, CAST((l_suppkey % 7) + 1 AS INTEGER) AS distributor_key,
         CAST(l_quantity AS DECIMAL(12,3)) AS quantity,
         CAST(l_extendedprice AS DECIMAL(15,2)) AS gross_amount,
         CAST(l_discount AS DECIMAL(5,2)) AS disc,
         COALESCE(l_returnflag = 'R', FALSE) AS is_deleted
  FROM lineitem {where}),
hdr AS (
  SELECT o_orderkey AS invoice_number, o_custkey AS client_key, CAST(o_orderdate AS DATE) AS sale_date
  FROM orders),
zones AS (
  SELECT r_regionkey + 1 AS zone_key, upper(substr(r_name, 1, 3)) AS zone_code, r_name AS zone_name FROM region),
cities AS (
  SELECT n_nationkey AS city_key, n_name AS city_name, n_regionkey + 1 AS zone_key,
         17.5 + CAST(n_nationkey AS DOUBLE) / 10 AS latitude, -71.5 + CAST(n_regionkey AS DOUBLE) / 2 AS longitude
  FROM nation),
dist AS (
  SELECT * FROM (VALUES (1, 'INT', 'Ventas Internas', 'INTERNO'),
    (2, 'DIST_A', 'Distribuidora Ramos S.R.L.', 'EXTERNO'), (3, 'DIST_B', 'MediFar Dominicana S.A.', 'EXTERNO'),
    (4, 'DIST_C', 'Farmacorp S.A.', 'EXTERNO'), (5, 'DIST_D', 'AlphaFarma Group S.R.L.', 'EXTERNO'),
    (6, 'DIST_E', 'BioPharma Distribution S.A.', 'EXTERNO'), (7, 'DIST_F', 'MedDist Nacional S.R.L.', 'EXTERNO'))
    AS t(distributor_key, distributor_code, distributor_name, distributor_type)),
sp AS (
  SELECT * FROM (VALUES (1, 'SP-001', 'Carlos Batista Pérez', 1, 0.040, 850000),
    (2, 'SP-002', 'María González Sánchez', 1, 0.038, 820000), (3, 'SP-003', 'José Rodríguez Mejía', 1, 0.042, 900000),
    (4, 'SP-004', 'Ana Martínez Ortiz', 1, 0.035, 750000), (5, 'SP-005', 'Luis Fernández Taveras', 2, 0.040, 800000),
    (6, 'SP-006', 'Carmen Valdez Peralta', 2, 0.038, 780000), (7, 'SP-007', 'Roberto Jiménez Cruz', 2, 0.045, 950000),
    (8, 'SP-008', 'Patricia Almonte Rivas', 2, 0.035, 720000), (9, 'SP-009', 'Miguel Ángel Rosario', 3, 0.040, 820000),
    (10, 'SP-010', 'Sandra Corporán Díaz', 3, 0.038, 780000), (11, 'SP-011', 'Ramón Féliz Cepeda', 3, 0.036, 760000),
    (12, 'SP-012', 'Yolanda Tejeda Núñez', 4, 0.038, 760000), (13, 'SP-013', 'Eduardo Pichardo Reyes', 4, 0.035, 720000),
    (14, 'SP-014', 'Cecilia Marte Herrera', 4, 0.033, 700000), (15, 'SP-015', 'Francisco Castillo López', 5, 0.040, 800000))
    AS t(salesperson_key, salesperson_id, full_name, sp_zone_key, commission_rate, monthly_target)),
prod AS (
  SELECT p_partkey AS product_key, p_name AS product_name, p_type AS category,
         'SIZE_' || lpad(CAST(CAST(trunc(p_size / 10) AS INTEGER) AS VARCHAR), 2, '0') AS subcategory,
         CASE WHEN p_size <= 25 THEN 'RX' ELSE 'OTC' END AS rx_otc_flag,
         CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) AS laboratory_key, p_brand AS lab_name,
         CAST(p_retailprice AS DECIMAL(12,4)) AS list_price
  FROM part),
base AS (
  SELECT li.*, h.client_key, h.sale_date,
         CAST(year(h.sale_date) * 10000 + month(h.sale_date) * 100 + day(h.sale_date) AS INTEGER) AS date_key,
         CAST(year(h.sale_date) AS INTEGER) AS year, CAST(month(h.sale_date) AS INTEGER) AS month_num,
         {MONTHS}[month(h.sale_date)] AS month_name, strftime(h.sale_date, '%Y-%m') AS year_month,
         CAST((h.client_key % 15) + 1 AS INTEGER) AS salesperson_key,
         c.c_name AS client_name, c.c_mktsegment AS client_type, c.c_nationkey AS city_key,
         ci.city_name, z.zone_key, z.zone_code, z.zone_name,
         d.distributor_code, d.distributor_name, d.distributor_type,
         p.product_name, p.category, p.subcategory, p.rx_otc_flag, p.laboratory_key, p.lab_name, p.list_price,
         li.disc * 100 AS discount_pct, ROUND(li.gross_amount * li.disc, 2) AS discount_amount,
         li.gross_amount - ROUND(li.gross_amount * li.disc, 2) AS net_amount,
         ROUND(li.quantity * p.list_price * 0.60, 2) AS cost_amount
  FROM li JOIN hdr h USING (invoice_number)
  JOIN customer c ON c.c_custkey = h.client_key
  JOIN cities ci ON ci.city_key = c.c_nationkey
  JOIN zones z ON z.zone_key = ci.zone_key
  JOIN dist d ON d.distributor_key = li.distributor_key
  JOIN prod p ON p.product_key = li.product_key),
sales AS (
  SELECT *, net_amount - cost_amount AS margin_amount,
         CAST({rdiv(cents('net_amount - cost_amount') + ' * 100', cents('net_amount'), 3)} AS DECIMAL(12,3)) AS margin_pct,
         CAST({rdiv(cents('gross_amount') + ' * 10', 'CAST(quantity * 1000 AS HUGEINT)', 4)} AS DECIMAL(16,4)) AS unit_price,
         CASE WHEN distributor_code = 'INT' THEN 'SAP_HANA' ELSE distributor_code END AS source_system,
         CAST(invoice_number AS VARCHAR) || '-' || CAST(invoice_line AS VARCHAR) AS source_record_id
  FROM base)
"""


def with_sales(body: str, include_deleted: bool = False) -> str:
    return "WITH " + sales_cte(include_deleted) + body


MONTHLY_ZONE_BODY = f"""
SELECT year_month, year, month_num, month_name, zone_code, zone_name,
       distributor_code, distributor_name, distributor_type,
       COUNT(DISTINCT invoice_number) AS invoice_count,
       COUNT(*) AS line_count,
       CAST(SUM(quantity) AS DOUBLE) AS total_quantity,
       {money('SUM(gross_amount)')} AS total_gross,
       {money('SUM(discount_amount)')} AS total_discount,
       {money('SUM(net_amount)')} AS total_net,
       {money('SUM(cost_amount)')} AS total_cost,
       {money('SUM(margin_amount)')} AS total_margin,
       {mean3('margin_pct')} AS avg_margin_pct,
       COUNT(DISTINCT client_key) AS active_clients,
       {per('SUM(net_amount)', 'COUNT(DISTINCT client_key)', 2)} AS avg_ticket
FROM sales
GROUP BY year_month, year, month_num, month_name, zone_code, zone_name,
         distributor_code, distributor_name, distributor_type
"""


def _q(body: str, include_deleted: bool = False) -> str:
    return with_sales(body, include_deleted)


ORACLE: dict[str, str] = {}

ORACLE["mart_monthly_zone"] = _q(MONTHLY_ZONE_BODY)

ORACLE["mart_sales_yoy"] = _q(f""", mz AS ({MONTHLY_ZONE_BODY})
SELECT cur.year_month, cur.year, cur.month_num, cur.zone_code, cur.zone_name, cur.distributor_code,
       cur.total_net AS current_sales, prev.total_net AS prior_year_sales,
       {money('CAST(cur.total_net AS DECIMAL(20,2)) - COALESCE(CAST(prev.total_net AS DECIMAL(20,2)), 0)')} AS yoy_variance,
       CASE WHEN COALESCE(prev.total_net, 0) > 0 THEN
         {rdiv(cents('CAST(cur.total_net AS DECIMAL(20,2)) - CAST(prev.total_net AS DECIMAL(20,2))') + ' * 100',
               cents('CAST(prev.total_net AS DECIMAL(20,2))'), 2)} END AS yoy_growth_pct,
       cur.active_clients, cur.avg_ticket, cur.avg_margin_pct
FROM mz cur LEFT JOIN mz prev
  ON prev.year = cur.year - 1 AND prev.month_num = cur.month_num
 AND prev.zone_code = cur.zone_code AND prev.distributor_code = cur.distributor_code
""")

ORACLE["mart_top_clients"] = _q(f"""
SELECT s.client_key, client_name, client_type, zone_name, city_name, sp.full_name AS salesperson, year, year_month,
       COUNT(DISTINCT invoice_number) AS invoice_count,
       CAST(SUM(quantity) AS DOUBLE) AS total_quantity,
       {money('SUM(net_amount)')} AS total_net,
       {money('SUM(margin_amount)')} AS total_margin,
       {mean3('margin_pct')} AS avg_margin_pct,
       {per('SUM(net_amount)', 'COUNT(DISTINCT invoice_number)', 2)} AS avg_ticket,
       CAST(RANK() OVER (PARTITION BY year ORDER BY SUM(net_amount) DESC) AS INTEGER) AS rank_by_year
FROM sales s JOIN sp USING (salesperson_key)
GROUP BY s.client_key, client_name, client_type, zone_name, city_name, sp.full_name, year, year_month
""")

ORACLE["mart_product_margin"] = _q(f"""
SELECT product_key, product_name, category, subcategory, rx_otc_flag, lab_name, year, year_month, zone_name,
       CAST(SUM(quantity) AS DOUBLE) AS total_quantity,
       {money('SUM(net_amount)')} AS total_net,
       {money('SUM(cost_amount)')} AS total_cost,
       {money('SUM(margin_amount)')} AS total_margin,
       {mean3('margin_pct')} AS avg_margin_pct,
       {mean4('unit_price')} AS avg_unit_price,
       CAST(RANK() OVER (PARTITION BY year, zone_name ORDER BY SUM(net_amount) DESC) AS INTEGER) AS rank_in_zone_year
FROM sales
GROUP BY product_key, product_name, category, subcategory, rx_otc_flag, lab_name, year, year_month, zone_name
""")

ORACLE["mart_sales_by_city"] = _q(f"""
SELECT s.city_name, c.latitude, c.longitude, zone_name, year, year_month,
       COUNT(DISTINCT invoice_number) AS invoice_count,
       {money('SUM(net_amount)')} AS total_net,
       COUNT(DISTINCT client_key) AS active_clients
FROM sales s JOIN cities c ON c.city_key = s.city_key
GROUP BY s.city_name, c.latitude, c.longitude, zone_name, year, year_month
""")

ORACLE["mart_sales_by_category"] = _q(f"""
SELECT category, subcategory, rx_otc_flag, zone_name, year, year_month,
       CAST(SUM(quantity) AS DOUBLE) AS total_quantity,
       {money('SUM(net_amount)')} AS total_net,
       {money('SUM(margin_amount)')} AS total_margin,
       {mean3('margin_pct')} AS avg_margin_pct
FROM sales
GROUP BY category, subcategory, rx_otc_flag, zone_name, year, year_month
""")

ORACLE["mart_avg_ticket"] = _q(f"""
SELECT client_type, zone_name, year, year_month,
       COUNT(DISTINCT invoice_number) AS invoice_count,
       COUNT(DISTINCT client_key) AS client_count,
       {money('SUM(net_amount)')} AS total_net,
       {per('SUM(net_amount)', 'COUNT(DISTINCT invoice_number)', 2)} AS avg_ticket
FROM sales
GROUP BY client_type, zone_name, year, year_month
""")

ORACLE["mart_distributor_vs_internal"] = _q(f"""
SELECT distributor_type, distributor_name, zone_name, year, year_month,
       COUNT(DISTINCT invoice_number) AS invoice_count,
       CAST(SUM(quantity) AS DOUBLE) AS total_quantity,
       {money('SUM(net_amount)')} AS total_net,
       {money('SUM(margin_amount)')} AS total_margin,
       {mean3('margin_pct')} AS avg_margin_pct,
       COUNT(DISTINCT client_key) AS active_clients
FROM sales
GROUP BY distributor_type, distributor_name, zone_name, year, year_month
""")

COMMISSION_CTE = """,
months AS (
  SELECT CAST(m AS DATE) AS month_start
  FROM (SELECT generate_series(date_trunc('month', MIN(sale_date)), date_trunc('month', MAX(sale_date)),
                               INTERVAL 1 MONTH) AS ms FROM sales) t, unnest(t.ms) AS u(m)),
msales AS (
  SELECT salesperson_key, date_trunc('month', sale_date) AS month_start, SUM(net_amount) AS s
  FROM sales GROUP BY 1, 2),
fc AS (
  SELECT m.month_start, sp.salesperson_key, sp.salesperson_id, sp.full_name, sp.sp_zone_key AS zone_key,
         COALESCE(ms.s, 0) AS sales_amount, CAST(sp.monthly_target AS DECIMAL(15,2)) AS target_amount,
         CAST(sp.commission_rate AS DECIMAL(5,3)) AS commission_rate
  FROM sp, months m
  LEFT JOIN msales ms ON ms.salesperson_key = sp.salesperson_key AND ms.month_start = m.month_start),
fcm AS (
  SELECT *, strftime(month_start, '%Y-%m') AS year_month, CAST(year(month_start) AS INTEGER) AS year,
         CAST(month(month_start) AS INTEGER) AS month_num,
         CASE WHEN target_amount > 0 THEN ROUND(sales_amount * 100 / target_amount, 3) ELSE 0 END AS achievement_pct,
         ROUND(sales_amount * commission_rate, 2) AS commission_amount,
         CASE WHEN target_amount > 0 AND sales_amount >= target_amount
              THEN ROUND(sales_amount * commission_rate * 0.10, 2) ELSE 0 END AS bonus_amount,
         ROUND(sales_amount * commission_rate + CASE WHEN target_amount > 0 AND sales_amount >= target_amount
              THEN sales_amount * commission_rate * 0.10 ELSE 0 END, 2) AS total_payout
  FROM fc)
"""

ORACLE["mart_commission_monthly"] = with_sales(COMMISSION_CTE + """
SELECT year_month, year, month_num, salesperson_id, full_name AS salesperson_name, z.zone_name,
       CAST(sales_amount AS DOUBLE) AS sales_amount, CAST(target_amount AS DOUBLE) AS target_amount,
       CAST(achievement_pct AS DOUBLE) AS achievement_pct,
       CAST(commission_rate * 100 AS DOUBLE) AS commission_rate_pct,
       CAST(commission_amount AS DOUBLE) AS commission_amount, CAST(bonus_amount AS DOUBLE) AS bonus_amount,
       CAST(total_payout AS DOUBLE) AS total_payout, FALSE AS paid_flag,
       CAST(RANK() OVER (PARTITION BY year_month ORDER BY sales_amount DESC) AS INTEGER) AS rank_in_month
FROM fcm JOIN zones z USING (zone_key)
""")

ORACLE["client_year_ranking"] = _q(f"""
SELECT client_key, client_name, year, COUNT(DISTINCT invoice_number) AS invoice_count,
       {money('SUM(net_amount)')} AS total_net,
       CAST(RANK() OVER (PARTITION BY year ORDER BY SUM(net_amount) DESC) AS INTEGER) AS rank_in_year
FROM sales GROUP BY client_key, client_name, year
""")
