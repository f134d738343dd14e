"""Oracle SQL for the analytic screens (see ``oracle_sql`` for conventions)."""

from __future__ import annotations

from salesmart.oracle_sql import COMMISSION_CTE, ORACLE, cents, money, per, rdiv, with_sales


def mean_dec(col: str, unit: int, s: int) -> str:
    """ROUND(AVG(col), s) for a column with ``unit`` decimals."""
    m = 10 ** unit
    return rdiv(f"SUM(CAST({col} * {m} AS HUGEINT))", f"COUNT({col}) * {m}", s)


NET0 = money("SUM(net_amount)", 0) + " AS net"
MARGIN2 = mean_dec("margin_pct", 3, 2) + " AS margin_pct"
INV = "COUNT(DISTINCT invoice_number) AS invoices"
CLI = "COUNT(DISTINCT client_key) AS clients"
TICKET0 = per("SUM(net_amount)", "COUNT(DISTINCT invoice_number)", 0) + " AS avg_ticket"


def sum_rounded(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(38,2))) AS DOUBLE)"


def mean_of(c: str, s: int = 4) -> str:
    return rdiv(f"SUM({cents(f'CAST({c} AS DECIMAL(38,2))')})", f"COUNT({c}) * 100", s)


def share(c: str) -> str:
    return rdiv(f"{cents(f'CAST({c} AS DECIMAL(38,2))')} * 100",
                cents(f"SUM(CAST({c} AS DECIMAL(38,2))) OVER ()"), 2)


def S(body: str) -> str:
    return with_sales(body)


def C(body: str) -> str:
    return with_sales(COMMISSION_CTE + body)


# K-1
ORACLE["home_kpis"] = S(f"""
SELECT {money('SUM(net_amount)', 0)} AS total_net, {mean_dec('margin_pct', 3, 2)} AS avg_margin,
       COUNT(DISTINCT invoice_number) AS invoices, COUNT(DISTINCT client_key) AS clients, {TICKET0}
FROM sales""")
ORACLE["home_zone_trend"] = S(f"SELECT year_month, zone_name, {NET0} FROM sales GROUP BY year_month, zone_name")
ORACLE["home_zone_share"] = S(f"""
SELECT zone_name, {NET0},
       {rdiv(cents('SUM(net_amount)') + ' * 100', cents('SUM(SUM(net_amount)) OVER ()'), 2)} AS share_pct
FROM sales GROUP BY zone_name""")
ORACLE["home_top_products"] = S(f"""
SELECT product_name, {NET0} FROM sales GROUP BY product_name ORDER BY net DESC, product_name LIMIT 10""")
ORACLE["home_category_totals"] = S(f"SELECT category, {NET0} FROM sales GROUP BY category")

# K-2
CITY = f""", city AS (
SELECT s.city_name, c.latitude, c.longitude, zone_name, {money('SUM(net_amount)', 0)} AS net_amount,
       {INV}, {CLI}
FROM sales s JOIN cities c ON c.city_key = s.city_key
WHERE c.latitude IS NOT NULL
GROUP BY s.city_name, c.latitude, c.longitude, zone_name)
"""
ORACLE["map_city_sales"] = S(CITY + "SELECT * FROM city")
ORACLE["map_top_cities"] = S(CITY + """SELECT city_name, net_amount, zone_name FROM city
ORDER BY net_amount DESC, city_name, zone_name LIMIT 10""")
ORACLE["map_zone_rollup"] = S(CITY + f"SELECT zone_name, {sum_rounded('net_amount')} AS net_amount FROM city GROUP BY zone_name")

# K-3
ZM = f""", zm AS (
SELECT year_month, year, month_num, zone_name, {NET0}, {INV}, {CLI}, {MARGIN2}
FROM sales GROUP BY year_month, year, month_num, zone_name)
"""
ORACLE["zone_monthly"] = S(ZM + "SELECT * FROM zm")
ORACLE["zone_totals"] = S(ZM + f"""SELECT zone_name, {sum_rounded('net')} AS net, CAST(SUM(clients) AS BIGINT) AS clients
FROM zm GROUP BY zone_name""")
ORACLE["zone_yearly"] = S(ZM + f"SELECT year, zone_name, {sum_rounded('net')} AS net FROM zm GROUP BY year, zone_name")
ORACLE["zone_month_pivot"] = S(ZM + "SELECT zone_name, year, " + ", ".join(
    f"COALESCE(SUM(net) FILTER (WHERE month_num = {i}), 0) AS month_{i}" for i in range(1, 13)) + """
FROM zm GROUP BY zone_name, year""")

# K-4
CR = f""", cr AS (
SELECT client_name, client_type, zone_name, city_name, {NET0}, {INV}, {TICKET0}, {MARGIN2}
FROM sales GROUP BY client_name, client_type, zone_name, city_name),
crr AS (SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY net DESC, client_name, client_type, zone_name, city_name)
                   AS INTEGER) AS rank FROM cr)
"""
ORACLE["client_ranking"] = S(CR + "SELECT * FROM crr")
ORACLE["client_type_mix"] = S(CR + f"SELECT client_type, {sum_rounded('net')} AS net FROM crr GROUP BY client_type")
ORACLE["client_top20"] = S(CR + "SELECT * FROM crr WHERE rank <= 20")

# K-5
PR = f""", pr AS (
SELECT product_name, category, rx_otc_flag, lab_name, {NET0}, CAST(SUM(quantity) AS DOUBLE) AS qty, {MARGIN2},
       {mean_dec('unit_price', 4, 2)} AS avg_price
FROM sales GROUP BY product_name, category, rx_otc_flag, lab_name),
prr AS (SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY net DESC, product_name, category, rx_otc_flag, lab_name)
                   AS INTEGER) AS rank FROM pr)
"""
ORACLE["product_ranking"] = S(PR + "SELECT * FROM prr")
ORACLE["product_rx_otc"] = S(PR + f"SELECT rx_otc_flag, {sum_rounded('net')} AS net FROM prr GROUP BY rx_otc_flag")
ORACLE["product_top15"] = S(PR + "SELECT * FROM prr WHERE rank <= 15")

# K-6
CL = """, cl AS (
SELECT year_month, full_name, z.zone_name, CAST(sales_amount AS DOUBLE) AS sales_amount,
       CAST(target_amount AS DOUBLE) AS target_amount, CAST(achievement_pct AS DOUBLE) AS achievement_pct,
       CAST(commission_rate * 100 AS DOUBLE) AS comm_rate_pct, CAST(commission_amount AS DOUBLE) AS commission_amount,
       CAST(bonus_amount AS DOUBLE) AS bonus_amount, CAST(total_payout AS DOUBLE) AS total_payout
FROM fcm JOIN zones z USING (zone_key))
"""
ORACLE["commission_list"] = C(CL + "SELECT * FROM cl")
ORACLE["commission_summary"] = C(CL + f"""
SELECT {sum_rounded('total_payout')} AS total_payout,
       {rdiv('SUM(CAST(achievement_pct * 1000 AS HUGEINT))', 'COUNT(achievement_pct) * 1000', 3)} AS avg_achievement_pct,
       (SELECT full_name FROM cl GROUP BY full_name
        ORDER BY SUM(CAST(sales_amount AS DECIMAL(38,2))) DESC, full_name DESC LIMIT 1) AS top_salesperson
FROM cl""")
BAND = "CASE WHEN achievement_pct < 80 THEN 'red' WHEN achievement_pct < 100 THEN 'amber' ELSE 'green' END AS band"
ORACLE["commission_last_month"] = C(CL + f"""
SELECT year_month, full_name, sales_amount, achievement_pct, total_payout, {BAND}
FROM cl WHERE year_month = (SELECT MAX(year_month) FROM cl)""")

# K-7
EV = f""", ev AS (
SELECT year_month, year, month_num, zone_name, {NET0}, {INV}, {TICKET0}, {MARGIN2}
FROM sales GROUP BY year_month, year, month_num, zone_name)
"""
ORACLE["evolution_monthly"] = S(EV + "SELECT * FROM ev")
ORACLE["evolution_totals"] = S(EV + f"""SELECT year_month, {sum_rounded('net')} AS net,
       CAST(SUM(invoices) AS BIGINT) AS invoices, {mean_of('avg_ticket', 4)} AS avg_ticket
FROM ev GROUP BY year_month""")

# K-8
YB = f""", yb AS (
SELECT year, month_num, month_name, ROUND(SUM(net_amount), 0) AS net FROM sales GROUP BY year, month_num, month_name),
yy AS (
SELECT cur.year, cur.month_num, cur.month_name, CAST(cur.net AS DOUBLE) AS current_sales,
       CAST(prev.net AS DOUBLE) AS prior_year_sales,
       CAST(ROUND(cur.net - COALESCE(prev.net, 0), 0) AS DOUBLE) AS variance,
       CASE WHEN COALESCE(prev.net, 0) > 0 THEN {rdiv('CAST((cur.net - prev.net) * 100 AS HUGEINT)', 'CAST(prev.net AS HUGEINT)', 2)} END AS growth_pct
FROM yb cur LEFT JOIN yb prev ON prev.year = cur.year - 1 AND prev.month_num = cur.month_num)
"""
ORACLE["yoy_by_month"] = S(YB + "SELECT * FROM yy")
ORACLE["yoy_latest_totals"] = S(YB + f"""
SELECT MAX(year) AS latest_year, {sum_rounded('current_sales')} AS current_total,
       {sum_rounded('prior_year_sales')} AS prior_total,
       {rdiv("CAST(SUM(current_sales) - SUM(prior_year_sales) AS HUGEINT) * 100", "CAST(SUM(prior_year_sales) AS HUGEINT)", 2)} AS growth_pct
FROM yy WHERE year = (SELECT MAX(year) FROM yy)""")

# K-9
LM = f""", lm AS (
SELECT lab_name, year_month, year, {NET0}, CAST(SUM(quantity) AS DOUBLE) AS qty, {MARGIN2}
FROM sales GROUP BY lab_name, year_month, year)
"""
ORACLE["lab_monthly"] = S(LM + "SELECT * FROM lm")
ORACLE["lab_totals"] = S(LM + f""", lt AS (SELECT lab_name, {sum_rounded('net')} AS net, {mean_of('margin_pct')} AS margin_pct
FROM lm GROUP BY lab_name)
SELECT *, {share('net')} AS share_pct FROM lt""")


def top_trend(cte: str, src: str, member: str, n: int) -> str:
    return cte + f""", top AS (
SELECT {member} FROM {src} GROUP BY {member}
ORDER BY SUM(CAST(net AS DECIMAL(38,2))) DESC, {member} LIMIT {n})
SELECT year_month, {member}, {sum_rounded('net')} AS net FROM {src} WHERE {member} IN (SELECT {member} FROM top)
GROUP BY year_month, {member}"""


ORACLE["lab_top6_trend"] = S(top_trend(LM, "lm", "lab_name", 6))

# K-10
DM = f""", dm AS (
SELECT distributor_name, distributor_type, year_month, year, {NET0}, {INV}, {CLI}, {MARGIN2}
FROM sales GROUP BY distributor_name, distributor_type, year_month, year)
"""
ORACLE["dist_monthly"] = S(DM + "SELECT * FROM dm")
ORACLE["dist_type_trend"] = S(DM + f"""SELECT distributor_type, year_month, {sum_rounded('net')} AS net
FROM dm GROUP BY distributor_type, year_month""")
ORACLE["dist_kpis"] = S(DM + f""", dk AS (
SELECT distributor_name, distributor_type, {sum_rounded('net')} AS net, CAST(SUM(invoices) AS BIGINT) AS invoices,
       CAST(SUM(clients) AS BIGINT) AS clients, {mean_of('margin_pct')} AS margin_pct
FROM dm GROUP BY distributor_name, distributor_type)
SELECT *, {share('net')} AS share_pct FROM dk""")

# K-11
MP = f""", mp AS (
SELECT product_name, category, lab_name, {NET0}, {money('SUM(cost_amount)', 0)} AS cost_total,
       {money('SUM(margin_amount)', 0)} AS margin_total, {MARGIN2}, {mean_dec('unit_price', 4, 2)} AS avg_price
FROM sales GROUP BY product_name, category, lab_name)
"""
ORACLE["margin_by_product"] = S(MP + "SELECT * FROM mp")
ORACLE["margin_top15"] = S(MP + "SELECT * FROM mp ORDER BY margin_pct DESC, product_name, category, lab_name LIMIT 15")
ORACLE["margin_extremes"] = S(MP + f""", ex AS (
(SELECT 'highest' AS extreme, product_name, margin_pct FROM mp
 ORDER BY margin_pct DESC, product_name, category, lab_name LIMIT 1)
UNION ALL
(SELECT 'lowest' AS extreme, product_name, margin_pct FROM mp
 ORDER BY margin_pct ASC, product_name DESC, category DESC, lab_name DESC LIMIT 1))
SELECT ex.*, (SELECT {mean_of('margin_pct')} FROM mp) AS mean_margin_pct FROM ex""")
ORACLE["margin_heatmap"] = S(MP + f"""
SELECT category, lab_name, {mean_of('margin_pct')} AS margin_pct FROM mp GROUP BY category, lab_name""")

# K-12
TD = f""", td AS (
SELECT client_type, zone_name, year_month, {INV}, {CLI}, {NET0}, {TICKET0}
FROM sales GROUP BY client_type, zone_name, year_month)
"""
WT = "COALESCE(" + rdiv("CAST(SUM(net) AS HUGEINT)", "SUM(invoices)", 4) + ", 0) AS avg_ticket"
ORACLE["ticket_detail"] = S(TD + "SELECT * FROM td")
ORACLE["ticket_overall"] = S(TD + f"SELECT {WT} FROM td")
ORACLE["ticket_by_type"] = S(TD + f"SELECT client_type, {WT} FROM td GROUP BY client_type")
ORACLE["ticket_by_zone"] = S(TD + f"SELECT zone_name, {WT} FROM td GROUP BY zone_name")
ORACLE["ticket_by_month"] = S(TD + f"SELECT year_month, {WT} FROM td GROUP BY year_month")

# K-13
CD = f""", cd AS (
SELECT category, subcategory, rx_otc_flag, zone_name, year_month, {NET0}, CAST(SUM(quantity) AS DOUBLE) AS qty, {MARGIN2}
FROM sales GROUP BY category, subcategory, rx_otc_flag, zone_name, year_month)
"""
ORACLE["category_detail"] = S(CD + "SELECT * FROM cd")
ORACLE["category_tree"] = S(CD + f"SELECT category, subcategory, {sum_rounded('net')} AS net FROM cd GROUP BY category, subcategory")
ORACLE["category_rx_otc"] = S(CD + f"SELECT rx_otc_flag, {sum_rounded('net')} AS net FROM cd GROUP BY rx_otc_flag")
ORACLE["category_top5_trend"] = S(top_trend(CD, "cd", "category", 5))

# K-14
SM = f""", sm AS (
SELECT sp.full_name, zone_name, year_month, year, {NET0}, {INV}, {CLI}, {MARGIN2}
FROM sales JOIN sp USING (salesperson_key) GROUP BY sp.full_name, zone_name, year_month, year)
"""
ORACLE["seller_monthly"] = S(SM + "SELECT * FROM sm")
ORACLE["seller_ranking"] = S(SM + f""", sr AS (
SELECT full_name, zone_name, {sum_rounded('net')} AS net, CAST(SUM(invoices) AS BIGINT) AS invoices,
       CAST(SUM(clients) AS BIGINT) AS clients FROM sm GROUP BY full_name, zone_name)
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY net DESC, full_name, zone_name) AS INTEGER) AS rank FROM sr""")
ORACLE["seller_top6_trend"] = S(top_trend(SM, "sm", "full_name", 6))

# K-15
ACH = ("COALESCE(CASE WHEN SUM(CAST(target_amount AS DECIMAL(38,2))) > 0 THEN "
       + rdiv(cents("SUM(CAST(sales_amount AS DECIMAL(38,2)))") + " * 100",
              cents("SUM(CAST(target_amount AS DECIMAL(38,2)))"), 3) + " END, 0)")
ORACLE["target_overview"] = C(CL + f"""
SELECT MAX(year_month) AS year_month, {ACH} AS overall_achievement_pct,
       COUNT(*) FILTER (WHERE achievement_pct >= 100) AS above_target,
       COUNT(*) FILTER (WHERE achievement_pct < 100) AS below_target
FROM cl WHERE year_month = (SELECT MAX(year_month) FROM cl)""")
ORACLE["target_bands"] = C(CL + f"""
SELECT year_month, full_name, achievement_pct, {BAND}
FROM cl WHERE year_month = (SELECT MAX(year_month) FROM cl)""")
ORACLE["target_trend"] = C(CL + f"""
SELECT year_month, {ACH} AS achievement_pct, COUNT(*) FILTER (WHERE achievement_pct >= 100) AS above_target
FROM cl GROUP BY year_month""")
