"""Budget vs actual (K-16), load monitor (K-18), calendar (A-12) and the
dashboard-defined reports (K-20: Pareto, month over month, year to date,
ticket quartiles, lab top product, contributions, heatmaps, achievement by
zone, top clients by ticket).

Windows here are either over a bounded, already aggregated frame (months,
zones, salespeople) or go through the distributed helpers in
``operators.ranking`` when the frame grows with the data (products,
invoices).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.measures import mean, money
from salesmart.operators.commission import fact_commission
from salesmart.operators.ranking import rank_over, running_total
from salesmart.plans.filters import ALL, Filters
from salesmart.plans.screens import facts, month_grid
from salesmart.sources import star
from salesmart.sources.calendar import calendar
from salesmart.sources.tables import Source

# Budget rule: each month's budget is the same month of the previous year plus 5 %.
BUDGET_GROWTH = "1.05"


def ym(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


# --------------------------------------------------------------------------- K-16 budget

def fact_budget(src: Source) -> DataFrame:
    """Budget per month x zone x salesperson x category, derived from the prior year's sales."""
    f = star.sales(src)
    prior = f.groupBy("year", "month_num", "zone_key", "salesperson_key", "category").agg(
        F.sum("net_amount").alias("_s"))
    return prior.select(
        (F.col("year") + 1).alias("year"), "month_num", ym(F.col("year") + 1, F.col("month_num")).alias("year_month"),
        "zone_key", "salesperson_key", "category",
        F.round(F.col("_s") * F.lit(BUDGET_GROWTH).cast("decimal(3,2)"), 2).alias("budget_amount"))


def _bva(budget: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    j = budget.join(actual, key, "left")
    b, a = F.col("budget"), F.coalesce(F.col("actual"), F.lit(0))
    return j.select(key, b.cast("double").alias("budget"), a.cast("double").alias("actual"),
                    F.coalesce(F.round(F.try_divide(a * 100, F.nullif(b, F.lit(0))), 1), F.lit(0))
                    .cast("double").alias("achievement_pct"),
                    F.round(a - b, 0).cast("double").alias("variance"))


def _budget(src: Source, flt: Filters) -> DataFrame:
    b = fact_budget(src).join(star.zones(src), "zone_key")
    if flt.years:
        b = b.filter(F.col("year").isin(list(flt.years)))
    if flt.zones:
        b = b.filter(F.col("zone_name").isin(list(flt.zones)))
    if flt.categories:
        b = b.filter(F.col("category").isin(list(flt.categories)))
    return b


def budget_vs_actual_month(src: Source, flt: Filters = ALL) -> DataFrame:
    bgt = _budget(src, flt).groupBy("year_month").agg(F.round(F.sum("budget_amount"), 0).alias("budget"))
    act = facts(src, flt).groupBy("year_month").agg(F.round(F.sum("net_amount"), 0).alias("actual"))
    return _bva(bgt, act, "year_month")


def budget_vs_actual_zone(src: Source, flt: Filters = ALL) -> DataFrame:
    bgt = _budget(src, flt).groupBy("zone_name").agg(F.round(F.sum("budget_amount"), 0).alias("budget"))
    act = facts(src, flt).groupBy("zone_name").agg(F.round(F.sum("net_amount"), 0).alias("actual"))
    return _bva(bgt, act, "zone_name").withColumn("band", F.when(F.col("achievement_pct") >= 100, "green")
                                                  .when(F.col("achievement_pct") >= 85, "amber").otherwise("red"))


def budget_vs_actual_category(src: Source, flt: Filters = ALL) -> DataFrame:
    bgt = _budget(src, flt).groupBy("category").agg(F.round(F.sum("budget_amount"), 0).alias("budget"))
    act = facts(src, flt, product=True).groupBy("category").agg(F.round(F.sum("net_amount"), 0).alias("actual"))
    return _bva(bgt, act, "category")


# --------------------------------------------------------------------------- K-18 load monitor

# FIXED VALUES: the eight source systems of the run log, by number 0..7.
SYSTEMS = ["SAP_HANA", "SQL_SERVER", "DIST_A", "DIST_B", "DIST_C", "DIST_D", "DIST_E", "DIST_F"]


def run_log(src: Source) -> DataFrame:
    """The load run log as recorded in the event stream (one event = one run)."""
    e = src.events
    status = F.when(e.event_type == "error", "ERROR").when(e.event_type == "signup", "WARNING").otherwise("SUCCESS")
    sysno = F.pmod(e.user_id, F.lit(len(SYSTEMS))).cast("int")
    read = F.floor(e.value * 100).cast("bigint")
    return e.select(
        e.event_id.alias("run_id"),
        F.when(sysno < 2, "INCREMENTAL").otherwise("FILE").alias("run_type"),
        F.element_at(F.array(*[F.lit(s) for s in SYSTEMS]), sysno + 1).alias("source_system"),
        e.ts.alias("started_at"), status.alias("status"), read.alias("records_read"),
        F.when(status == "ERROR", F.lit(0).cast("bigint")).otherwise(read).alias("records_loaded"),
        F.to_date(e.ts).alias("run_date"))


def etl_latest_day(src: Source) -> DataFrame:
    r = run_log(src)
    last = r.select(F.max("run_date")).scalar()
    return r.filter(F.col("run_date") == last).agg(
        F.max("run_date").alias("run_date"), F.count(F.lit(1)).alias("runs"),
        F.sum("records_loaded").alias("records_loaded"), F.count_if(F.col("status") == "ERROR").alias("errors"))


def etl_success_summary(src: Source) -> DataFrame:
    r = run_log(src)
    return r.agg(F.round(F.count_if(F.col("status") == "SUCCESS").cast("decimal(20,0)") * 100 / F.count(F.lit(1)), 3)
                 .cast("double").alias("success_rate_pct"),
                 F.count_if(F.col("status") == "ERROR").alias("error_count"))


def etl_daily_status(src: Source) -> DataFrame:
    """run date x status counts, missing 0 (E-14)."""
    return (run_log(src).groupBy("run_date").pivot("status", ["SUCCESS", "WARNING", "ERROR"])
            .agg(F.count(F.lit(1))).fillna(0))


def etl_by_system(src: Source) -> DataFrame:
    return run_log(src).groupBy("source_system", "status").agg(F.count(F.lit(1)).alias("runs"))


def etl_records_per_day(src: Source) -> DataFrame:
    return run_log(src).groupBy("run_date").agg(F.sum("records_loaded").alias("records_loaded"))


def etl_latest_runs(src: Source, n: int = 30) -> DataFrame:
    return run_log(src).orderBy(F.desc("started_at"), F.desc("run_id")).limit(n)


# --------------------------------------------------------------------------- A-12 calendar

def sales_calendar(src: Source) -> DataFrame:
    """Calendar over the span of the order dates (bounds are scalar subqueries)."""
    o = src.orders
    lo = o.select(F.to_date(F.min("o_orderdate"))).scalar()
    hi = o.select(F.to_date(F.max("o_orderdate"))).scalar()
    return calendar(src.spark, lo, hi)


# --------------------------------------------------------------------------- K-20 defined reports

def pareto_products(src: Source, flt: Filters = ALL) -> DataFrame:
    """Products by net sales with cumulative share and ABC class (G-7)."""
    g = facts(src, flt, product=True).groupBy("product_key", "product_name").agg(F.sum("net_amount").alias("_net"))
    total = g.select(F.sum("_net")).scalar()
    r = running_total(g, "_net", [("_net", True)], out="_cum", tie_breakers=["product_key"])
    pct = F.round(F.try_divide(F.col("_cum") * 100, total), 2)
    return r.select("product_key", "product_name", F.col("_net").cast("double").alias("net"),
                    F.col("_cum").cast("double").alias("cumulative_net"), pct.cast("double").alias("cumulative_pct"),
                    F.when(pct <= 80, "A").when(pct <= 95, "B").otherwise("C").alias("abc_class"))


def month_over_month(src: Source, flt: Filters = ALL) -> DataFrame:
    """Monthly net with the previous month (G-8); the window runs over one row per month."""
    m = facts(src, flt).groupBy("year_month").agg(F.sum("net_amount").alias("_n"))
    w = Window.orderBy("year_month")
    prev = F.lag("_n", 1).over(w)
    return m.select("year_month", F.col("_n").cast("double").alias("net"), prev.cast("double").alias("prev_net"),
                    F.when(prev > 0, F.round((F.col("_n") - prev) * 100 / prev, 2)).cast("double")
                    .alias("change_pct"))


def ytd_sales(src: Source, flt: Filters = ALL) -> DataFrame:
    """Year-to-date running total by month (G-9); each window partition is one year (12 rows)."""
    m = facts(src, flt).groupBy("year", "month_num").agg(F.sum("net_amount").alias("_n"))
    w = Window.partitionBy("year").orderBy("month_num").rowsBetween(Window.unboundedPreceding, 0)
    return m.select("year", "month_num", F.col("_n").cast("double").alias("net"),
                    F.sum("_n").over(w).cast("double").alias("ytd_net"))


QUARTILES = (("q0", 0.0), ("q1", 0.25), ("q2", 0.5), ("q3", 0.75), ("q4", 1.0))


def ticket_quartiles(src: Source, flt: Filters = ALL) -> DataFrame:
    """Invoice ticket distribution per client type (E-22): exact nearest-rank quartiles.

    Position of quantile q in a group of n sorted tickets: max(1, ceil(q * n)).
    Ranks come from the distributed ``rank_over`` (no group is sorted in one
    task); the quartile rows are then picked with a join on position.
    """
    inv = facts(src, flt).groupBy("client_type", "invoice_number").agg(F.sum("net_amount").alias("ticket"))
    ranked = rank_over(inv, ["client_type"], [("ticket", False)], out="_pos", method="row_number",
                       tie_breakers=["invoice_number"])
    n = inv.groupBy("client_type").agg(F.count(F.lit(1)).alias("_n"))
    want = n.select("client_type", F.explode(F.array(*[
        F.struct(F.lit(name).alias("q"), F.greatest(F.lit(1), F.ceil(F.col("_n") * F.lit(q))).cast("int")
                 .alias("_pos")) for name, q in QUARTILES])).alias("_w")).select("client_type", "_w.*")
    picked = ranked.join(want, ["client_type", "_pos"])
    return (picked.groupBy("client_type").pivot("q", [q for q, _ in QUARTILES])
            .agg(F.first(F.col("ticket").cast("double"))))


def lab_top_product(src: Source, flt: Filters = ALL) -> DataFrame:
    """Per laboratory: net sales and its best-selling product (E-23)."""
    p = facts(src, flt, product=True).groupBy("lab_name", "product_key", "product_name").agg(
        F.sum("net_amount").alias("_n"))
    best = F.max_by(F.struct("product_name", "product_key"), F.struct("_n", F.negative("product_key")))
    return p.groupBy("lab_name").agg(F.sum("_n").cast("double").alias("net"),
                                     best["product_name"].alias("top_product"))


def distributor_contribution(src: Source, flt: Filters = ALL) -> DataFrame:
    """Share of each distributor in total net sales (E-24)."""
    g = facts(src, flt).groupBy("distributor_name").agg(F.sum("net_amount").alias("_n"))
    total = g.select(F.sum("_n")).scalar()
    return g.select("distributor_name", F.col("_n").cast("double").alias("net"),
                    F.round(F.try_divide(F.col("_n") * 100, total), 2).cast("double").alias("share_pct"))


def category_waterfall(src: Source, flt: Filters = ALL) -> DataFrame:
    """Category totals in descending order with the running total (E-24 waterfall)."""
    g = facts(src, flt, product=True).groupBy("category").agg(F.sum("net_amount").alias("_n"))
    w = Window.orderBy(F.desc("_n"), F.asc("category")).rowsBetween(Window.unboundedPreceding, 0)
    return g.select("category", F.col("_n").cast("double").alias("net"),
                    F.sum("_n").over(w).cast("double").alias("running_net"))


def achievement_by_zone(src: Source) -> DataFrame:
    """Target achievement per salesperson zone and month."""
    fc = fact_commission(src).join(star.zones(src), "zone_key")
    s, t = F.sum("sales_amount"), F.sum("target_amount")
    return fc.groupBy("zone_name", "year_month").agg(
        F.coalesce(F.when(t > 0, F.round(s * 100 / t, 3)), F.lit(0)).cast("double").alias("achievement_pct"))


def seller_month_heatmap(src: Source) -> DataFrame:
    """Salesperson x month achievement grid, a row per salesperson and year (E-25)."""
    return month_grid(fact_commission(src), ["full_name", "year"], F.first(F.col("achievement_pct").cast("double")))


def category_zone_margin_heatmap(src: Source, flt: Filters = ALL) -> DataFrame:
    """Category x zone mean margin, a row per cell (E-25)."""
    f = facts(src, flt, product=True)
    return f.groupBy("category", "zone_name").agg(mean("margin_pct", 3).alias("margin_pct"))


def top_clients_by_ticket(src: Source, flt: Filters = ALL, n: int = 20) -> DataFrame:
    """Top clients by average ticket (F-6)."""
    g = facts(src, flt).groupBy("client_key", "client_name").agg(
        F.sum("net_amount").alias("_n"), F.count_distinct("invoice_number").alias("invoices"))
    t = F.round(F.col("_n") / F.col("invoices"), 2)
    return (g.select("client_key", "client_name", "invoices", money(F.col("_n")).alias("net"),
                     t.cast("double").alias("avg_ticket"), t.alias("_t"))
            .orderBy(F.desc("_t"), F.asc("client_key")).limit(n).drop("_t"))
