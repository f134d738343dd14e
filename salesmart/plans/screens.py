"""The analytic screens (K-1 ... K-18) as parameterised DataFrame plans.

Each screen's SQL becomes one grouped aggregate over the filtered fact; the
second-level pandas steps of a dashboard (re-aggregation, pivots, top-N,
shares) become further DataFrame operations in the same plan.

Conventions kept from the screens: money columns are ROUND(SUM(net), 0),
margins ROUND(AVG(margin_pct), 2); re-aggregations of those rounded monthly
figures are done as the screens do them (sum of rounded values, mean of
monthly means).

Scale notes:
* top-N is ``orderBy(...).limit(n)`` -> TakeOrderedAndProject (per-task
  top-N, then a merge of n x tasks rows); always with a full tie-break;
* "restrict to the top-N members" (D-15) is a left-semi join against the
  top-N frame - nothing is collected;
* shares divide by the total as a scalar subquery (a distributed
  aggregate broadcast as one value), never a window over one partition;
* sequential ranking over all rows uses ``rank_over`` (distributed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.dates import year_month
from salesmart.functions.measures import mean, money, ratio
from salesmart.operators.commission import fact_commission
from salesmart.operators.ranking import rank_over
from salesmart.plans.filters import ALL, Filters
from salesmart.sources import star
from salesmart.sources.tables import Source


# --------------------------------------------------------------------------- helpers

def facts(src: Source, flt: Filters = ALL, *, product: bool = False, seller: bool = False) -> DataFrame:
    f = star.sales(src, client=True, product=product or flt.needs_product)
    if seller:
        f = f.join(star.salespeople(src).select("salesperson_key", "full_name"), "salesperson_key")
    return flt.apply(f)


def net0() -> Column:
    return money(F.sum("net_amount"), 0).alias("net")


def margin2() -> Column:
    return mean("margin_pct", 2).alias("margin_pct")


def top_n(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def dec(c: str) -> Column:
    """A rounded DOUBLE figure back to an exact decimal for re-aggregation."""
    return F.col(c).cast("decimal(38,2)")


def sum_rounded(c: str) -> Column:
    return F.sum(dec(c)).cast("double")


def with_share(df: DataFrame, c: str, out: str = "share_pct", scale: int = 2) -> DataFrame:
    """Add the percentage of the column's total; the total is a scalar subquery (a distributed
    aggregate), not a window over one partition."""
    total = df.select(F.sum(dec(c))).scalar()
    return df.withColumn(out, F.round(F.try_divide(dec(c) * 100, total), scale).cast("double"))


def mean_of(c: str, scale: int = 4) -> Column:
    """Mean of a rounded figure (mean of monthly means), exact then rounded."""
    return F.round(F.try_divide(F.sum(dec(c)), F.count(c)), scale).cast("double")


def band(c: Column, low: int, high: int) -> Column:
    """Traffic-light band (J-6): red below ``low``, amber below ``high``, green otherwise."""
    return F.when(c < low, "red").when(c < high, "amber").otherwise("green")


# --------------------------------------------------------------------------- K-1 home

def home_kpis(src: Source, flt: Filters = ALL) -> DataFrame:
    f = facts(src, flt, product=True)
    return f.agg(
        money(F.sum("net_amount"), 0).alias("total_net"),
        mean("margin_pct", 2).alias("avg_margin"),
        F.count_distinct("invoice_number").alias("invoices"),
        F.count_distinct("client_key").alias("clients"),
        ratio(F.sum("net_amount"), F.count_distinct("invoice_number"), 0).alias("avg_ticket"))


def home_zone_trend(src: Source, flt: Filters = ALL) -> DataFrame:
    return facts(src, flt).groupBy("year_month", "zone_name").agg(net0())


def home_zone_share(src: Source, flt: Filters = ALL) -> DataFrame:
    g = facts(src, flt).groupBy("zone_name").agg(F.sum("net_amount").alias("_net"))
    total = g.select(F.sum("_net")).scalar()
    return g.select("zone_name", money(F.col("_net"), 0).alias("net"),
                    F.round(F.try_divide(F.col("_net") * 100, total), 2).cast("double").alias("share_pct"))


def home_top_products(src: Source, flt: Filters = ALL, n: int = 10) -> DataFrame:
    g = facts(src, flt, product=True).groupBy("product_name").agg(net0())
    return top_n(g, n, [F.desc("net"), F.asc("product_name")])


def home_category_totals(src: Source, flt: Filters = ALL) -> DataFrame:
    return facts(src, flt, product=True).groupBy("category").agg(net0())


# --------------------------------------------------------------------------- K-2 map

def map_city_sales(src: Source, flt: Filters = ALL) -> DataFrame:
    f = facts(src, flt).join(star.cities(src).select("city_key", "latitude", "longitude"), "city_key")
    f = f.filter(F.col("latitude").isNotNull())
    return f.groupBy("city_name", "latitude", "longitude", "zone_name").agg(
        money(F.sum("net_amount"), 0).alias("net_amount"),
        F.count_distinct("invoice_number").alias("invoices"),
        F.count_distinct("client_key").alias("clients"))


def map_top_cities(src: Source, flt: Filters = ALL, n: int = 10) -> DataFrame:
    return top_n(map_city_sales(src, flt).select("city_name", "net_amount", "zone_name"), n,
                 [F.desc("net_amount"), F.asc("city_name"), F.asc("zone_name")])


def map_zone_rollup(src: Source, flt: Filters = ALL) -> DataFrame:
    return map_city_sales(src, flt).groupBy("zone_name").agg(sum_rounded("net_amount").alias("net_amount"))


# --------------------------------------------------------------------------- K-3 zones

def zone_monthly(src: Source, flt: Filters = ALL) -> DataFrame:
    return _zone_monthly(src, flt)


def month_grid(df: DataFrame, keys: list[str], cell: Column) -> DataFrame:
    """One row per ``keys``, a column for each of the twelve months."""
    grid = df.groupBy(*keys).pivot("month_num", list(range(1, 13))).agg(cell)
    return grid.select(*keys, *[F.col(str(i)).alias(f"month_{i}") for i in range(1, 13)])


def _zone_monthly(src: Source, flt: Filters) -> DataFrame:
    f = facts(src, flt, product=True)
    return f.groupBy("year_month", "year", "month_num", "zone_name").agg(
        net0(), F.count_distinct("invoice_number").alias("invoices"),
        F.count_distinct("client_key").alias("clients"), margin2())


def zone_totals(src: Source, flt: Filters = ALL) -> DataFrame:
    """Per-zone tiles: sums of the monthly figures (clients summed as the screen does)."""
    return _zone_monthly(src, flt).groupBy("zone_name").agg(
        sum_rounded("net").alias("net"), F.sum("clients").alias("clients"))


def zone_yearly(src: Source, flt: Filters = ALL) -> DataFrame:
    return _zone_monthly(src, flt).groupBy("year", "zone_name").agg(sum_rounded("net").alias("net"))


def zone_month_pivot(src: Source, flt: Filters = ALL) -> DataFrame:
    """Zone x month grid of net sales, a row per zone and year, missing cells 0 (E-12)."""
    m = _zone_monthly(src, flt)
    return month_grid(m, ["zone_name", "year"], F.sum("net")).fillna(0)


# --------------------------------------------------------------------------- K-4 clients

CLIENT_KEYS = ["client_name", "client_type", "zone_name", "city_name"]


def _client_totals(src: Source, flt: Filters) -> DataFrame:
    return facts(src, flt, product=True).groupBy(*CLIENT_KEYS).agg(
        net0(), F.count_distinct("invoice_number").alias("invoices"),
        ratio(F.sum("net_amount"), F.count_distinct("invoice_number"), 0).alias("avg_ticket"), margin2())


def _top(totals: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The n largest by net, numbered: a top-n per task, and a window over these n rows only."""
    order = [F.desc("net"), *keys]
    return totals.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def client_ranking(src: Source, flt: Filters = ALL) -> DataFrame:
    return rank_over(_client_totals(src, flt), [], [("net", True)], out="rank", method="row_number",
                     tie_breakers=CLIENT_KEYS)


def client_type_mix(src: Source, flt: Filters = ALL) -> DataFrame:
    return _client_totals(src, flt).groupBy("client_type").agg(sum_rounded("net").alias("net"))


def client_top20(src: Source, flt: Filters = ALL) -> DataFrame:
    return _top(_client_totals(src, flt), CLIENT_KEYS, 20)


# --------------------------------------------------------------------------- K-5 products

PRODUCT_KEYS = ["product_name", "category", "rx_otc_flag", "lab_name"]


def _product_totals(src: Source, flt: Filters) -> DataFrame:
    return facts(src, flt, product=True).groupBy(*PRODUCT_KEYS).agg(
        net0(), F.sum("quantity").cast("double").alias("qty"), margin2(),
        mean("unit_price", 2).alias("avg_price"))


def product_ranking(src: Source, flt: Filters = ALL) -> DataFrame:
    return rank_over(_product_totals(src, flt), [], [("net", True)], out="rank", method="row_number",
                     tie_breakers=PRODUCT_KEYS)


def product_rx_otc(src: Source, flt: Filters = ALL) -> DataFrame:
    return _product_totals(src, flt).groupBy("rx_otc_flag").agg(sum_rounded("net").alias("net"))


def product_top15(src: Source, flt: Filters = ALL) -> DataFrame:
    return _top(_product_totals(src, flt), PRODUCT_KEYS, 15)


# --------------------------------------------------------------------------- K-6 commissions

def commission_list(src: Source, flt: Filters = ALL) -> DataFrame:
    fc = fact_commission(src).join(star.zones(src), "zone_key")
    if flt.years:
        fc = fc.filter(F.split_part(F.col("year_month"), F.lit("-"), F.lit(1)).cast("int").isin(list(flt.years)))
    if flt.zones:
        fc = fc.filter(F.col("zone_name").isin(list(flt.zones)))
    return fc.select(
        "year_month", "full_name", "zone_name",
        F.col("sales_amount").cast("double").alias("sales_amount"),
        F.col("target_amount").cast("double").alias("target_amount"),
        F.col("achievement_pct").cast("double").alias("achievement_pct"),
        (F.col("commission_rate") * 100).cast("double").alias("comm_rate_pct"),
        F.col("commission_amount").cast("double").alias("commission_amount"),
        F.col("bonus_amount").cast("double").alias("bonus_amount"),
        F.col("total_payout").cast("double").alias("total_payout"))


def commission_summary(src: Source, flt: Filters = ALL) -> DataFrame:
    """Total paid, top seller (by summed sales) and mean achievement (E-17)."""
    c = commission_list(src, flt)
    per_seller = c.groupBy("full_name").agg(F.sum(dec("sales_amount")).alias("_s"))
    top = per_seller.select(F.max_by("full_name", F.struct("_s", "full_name")))
    tot = c.agg(F.sum(dec("total_payout")).cast("double").alias("total_payout"),
                F.round(F.try_divide(F.sum(F.col("achievement_pct").cast("decimal(20,3)")),
                                     F.count("achievement_pct")), 3).cast("double").alias("avg_achievement_pct"))
    return tot.select("*", top.scalar().alias("top_salesperson"))


def commission_last_month(src: Source, flt: Filters = ALL) -> DataFrame:
    """Rows of the latest month (G-10) with the achievement band."""
    c = commission_list(src, flt)
    last = c.select(F.max("year_month")).scalar()
    lm = c.filter(F.col("year_month") == last)
    return lm.select("year_month", "full_name", "sales_amount", "achievement_pct", "total_payout",
                     band(F.col("achievement_pct"), 80, 100).alias("band"))


# --------------------------------------------------------------------------- K-7 evolution

def evolution_monthly(src: Source, flt: Filters = ALL) -> DataFrame:
    return facts(src, flt, product=True).groupBy("year_month", "year", "month_num", "zone_name").agg(
        net0(), F.count_distinct("invoice_number").alias("invoices"),
        ratio(F.sum("net_amount"), F.count_distinct("invoice_number"), 0).alias("avg_ticket"), margin2())


def evolution_totals(src: Source, flt: Filters = ALL) -> DataFrame:
    return evolution_monthly(src, flt).groupBy("year_month").agg(
        sum_rounded("net").alias("net"), F.sum("invoices").alias("invoices"),
        mean_of("avg_ticket", 4).alias("avg_ticket"))


# --------------------------------------------------------------------------- K-8 year over year

def yoy_by_month(src: Source, flt: Filters = ALL) -> DataFrame:
    base = facts(src, flt).groupBy("year", "month_num", "month_name").agg(
        F.round(F.sum("net_amount"), 0).alias("net"))
    prev = base.select((F.col("year") + 1).alias("year"), "month_num", F.col("net").alias("prev_net"))
    j = base.join(prev, ["year", "month_num"], "left")
    cur, pv = F.col("net"), F.col("prev_net")
    return j.select(
        "year", "month_num", "month_name",
        cur.cast("double").alias("current_sales"),
        pv.cast("double").alias("prior_year_sales"),
        F.round(cur - F.coalesce(pv, F.lit(0)), 0).cast("double").alias("variance"),
        F.when(F.coalesce(pv, F.lit(0)) > 0, F.round((cur - pv) * 100 / pv, 2)).cast("double").alias("growth_pct"))


def yoy_latest_totals(src: Source, flt: Filters = ALL) -> DataFrame:
    y = yoy_by_month(src, flt)
    latest = y.select(F.max("year")).scalar()
    ly = y.filter(F.col("year") == latest)
    cur, prev = F.sum(dec("current_sales")), F.sum(dec("prior_year_sales"))
    return ly.agg(F.max("year").alias("latest_year"), cur.cast("double").alias("current_total"),
                  prev.cast("double").alias("prior_total"),
                  F.round(F.try_divide((cur - prev) * 100, F.nullif(prev, F.lit(0))), 2)
                  .cast("double").alias("growth_pct"))


# --------------------------------------------------------------------------- K-9 laboratories

def lab_monthly(src: Source, flt: Filters = ALL) -> DataFrame:
    return facts(src, flt, product=True).groupBy("lab_name", "year_month", "year").agg(
        net0(), F.sum("quantity").cast("double").alias("qty"), margin2())


def lab_totals(src: Source, flt: Filters = ALL) -> DataFrame:
    g = lab_monthly(src, flt).groupBy("lab_name").agg(
        sum_rounded("net").alias("net"), mean_of("margin_pct", 4).alias("margin_pct"))
    return with_share(g, "net")


def _top_members_trend(monthly: DataFrame, member: str, n: int) -> DataFrame:
    """Monthly net of the n members with the largest total (D-15, semi-join)."""
    totals = monthly.groupBy(member).agg(F.sum(dec("net")).alias("_t"))
    top = totals.orderBy(F.desc("_t"), F.asc(member)).limit(n).select(member)
    return (monthly.join(top, member, "left_semi")
            .groupBy("year_month", member).agg(sum_rounded("net").alias("net")))


def lab_top6_trend(src: Source, flt: Filters = ALL) -> DataFrame:
    return _top_members_trend(lab_monthly(src, flt), "lab_name", 6)


# --------------------------------------------------------------------------- K-10 distributors

def dist_monthly(src: Source, flt: Filters = ALL) -> DataFrame:
    # grouped by the keys that determine the others: counting distinct values shuffles a row for each of them
    g = facts(src, flt, product=True).groupBy("distributor_key", "year", "month_num").agg(
        net0(), F.count_distinct("invoice_number").alias("invoices"),
        F.count_distinct("client_key").alias("clients"), margin2())
    return g.select(star.of_distributor(2).alias("distributor_name"), star.of_distributor(3).alias("distributor_type"),
                    year_month(F.make_date("year", "month_num", F.lit(1))).alias("year_month"), "year", *g.columns[3:])


def dist_type_trend(src: Source, flt: Filters = ALL) -> DataFrame:
    return dist_monthly(src, flt).groupBy("distributor_type", "year_month").agg(sum_rounded("net").alias("net"))


def dist_kpis(src: Source, flt: Filters = ALL) -> DataFrame:
    g = dist_monthly(src, flt).groupBy("distributor_name", "distributor_type").agg(
        sum_rounded("net").alias("net"), F.sum("invoices").alias("invoices"),
        F.sum("clients").alias("clients"), mean_of("margin_pct", 4).alias("margin_pct"))
    return with_share(g, "net")


# --------------------------------------------------------------------------- K-11 margins

def margin_by_product(src: Source, flt: Filters = ALL) -> DataFrame:
    return facts(src, flt, product=True).groupBy("product_name", "category", "lab_name").agg(
        net0(), money(F.sum("cost_amount"), 0).alias("cost_total"),
        money(F.sum("margin_amount"), 0).alias("margin_total"), margin2(),
        mean("unit_price", 2).alias("avg_price"))


def margin_top15(src: Source, flt: Filters = ALL) -> DataFrame:
    return top_n(margin_by_product(src, flt), 15,
                 [F.desc("margin_pct"), F.asc("product_name"), F.asc("category"), F.asc("lab_name")])


def margin_extremes(src: Source, flt: Filters = ALL) -> DataFrame:
    """Highest and lowest margin product (F-4) plus the overall mean of margins."""
    m = margin_by_product(src, flt)
    hi = top_n(m, 1, [F.desc("margin_pct"), F.asc("product_name"), F.asc("category"), F.asc("lab_name")]) \
        .select(F.lit("highest").alias("extreme"), "product_name", "margin_pct")
    lo = top_n(m, 1, [F.asc("margin_pct"), F.desc("product_name"), F.desc("category"), F.desc("lab_name")]) \
        .select(F.lit("lowest").alias("extreme"), "product_name", "margin_pct")
    avg = m.select(mean_of("margin_pct", 4))
    return hi.unionByName(lo).select("*", avg.scalar().alias("mean_margin_pct"))


def margin_heatmap(src: Source, flt: Filters = ALL) -> DataFrame:
    """Category x laboratory mean margin, a row per cell: laboratories grow with the data (E-13)."""
    m = margin_by_product(src, flt)
    return m.groupBy("category", "lab_name").agg(mean_of("margin_pct", 4).alias("margin_pct"))


# --------------------------------------------------------------------------- K-12 ticket

def ticket_detail(src: Source, flt: Filters = ALL) -> DataFrame:
    return facts(src, flt).groupBy("client_type", "zone_name", "year_month").agg(
        F.count_distinct("invoice_number").alias("invoices"),
        F.count_distinct("client_key").alias("clients"), net0(),
        ratio(F.sum("net_amount"), F.count_distinct("invoice_number"), 0).alias("avg_ticket"))


def _weighted_ticket(df: DataFrame, *keys: str) -> DataFrame:
    """Sum(net) / Sum(invoices) re-aggregation (E-11), 0 when no invoices."""
    t = F.round(F.try_divide(F.sum(dec("net")), F.nullif(F.sum("invoices"), F.lit(0))), 4)
    return df.groupBy(*keys).agg(F.coalesce(t, F.lit(0)).cast("double").alias("avg_ticket"))


def ticket_overall(src: Source, flt: Filters = ALL) -> DataFrame:
    return _weighted_ticket(ticket_detail(src, flt))


def ticket_by_type(src: Source, flt: Filters = ALL) -> DataFrame:
    return _weighted_ticket(ticket_detail(src, flt), "client_type")


def ticket_by_zone(src: Source, flt: Filters = ALL) -> DataFrame:
    return _weighted_ticket(ticket_detail(src, flt), "zone_name")


def ticket_by_month(src: Source, flt: Filters = ALL) -> DataFrame:
    return _weighted_ticket(ticket_detail(src, flt), "year_month")


# --------------------------------------------------------------------------- K-13 categories

def category_detail(src: Source, flt: Filters = ALL) -> DataFrame:
    return facts(src, flt, product=True).groupBy(
        "category", "subcategory", "rx_otc_flag", "zone_name", "year_month").agg(
        net0(), F.sum("quantity").cast("double").alias("qty"), margin2())


def category_tree(src: Source, flt: Filters = ALL) -> DataFrame:
    return category_detail(src, flt).groupBy("category", "subcategory").agg(sum_rounded("net").alias("net"))


def category_rx_otc(src: Source, flt: Filters = ALL) -> DataFrame:
    return category_detail(src, flt).groupBy("rx_otc_flag").agg(sum_rounded("net").alias("net"))


def category_top5_trend(src: Source, flt: Filters = ALL) -> DataFrame:
    return _top_members_trend(category_detail(src, flt), "category", 5)


# --------------------------------------------------------------------------- K-14 salespeople

def seller_monthly(src: Source, flt: Filters = ALL) -> DataFrame:
    return facts(src, flt, product=True, seller=True).groupBy("full_name", "zone_name", "year_month", "year").agg(
        net0(), F.count_distinct("invoice_number").alias("invoices"),
        F.count_distinct("client_key").alias("clients"), margin2())


def seller_ranking(src: Source, flt: Filters = ALL) -> DataFrame:
    g = seller_monthly(src, flt).groupBy("full_name", "zone_name").agg(
        sum_rounded("net").alias("net"), F.sum("invoices").alias("invoices"), F.sum("clients").alias("clients"))
    return rank_over(g, [], [("net", True)], out="rank", method="row_number",
                     tie_breakers=["full_name", "zone_name"])


def seller_top6_trend(src: Source, flt: Filters = ALL) -> DataFrame:
    return _top_members_trend(seller_monthly(src, flt), "full_name", 6)


# --------------------------------------------------------------------------- K-15 targets

def target_overview(src: Source, flt: Filters = ALL) -> DataFrame:
    """Latest month: overall achievement and counts above / below target."""
    c = commission_list(src, flt)
    last = c.select(F.max("year_month")).scalar()
    lm = c.filter(F.col("year_month") == last)
    s, t = F.sum(dec("sales_amount")), F.sum(dec("target_amount"))
    return lm.agg(
        F.max("year_month").alias("year_month"),
        F.coalesce(F.when(t > 0, F.round(s * 100 / t, 3)), F.lit(0)).cast("double").alias("overall_achievement_pct"),
        F.count_if(F.col("achievement_pct") >= 100).alias("above_target"),
        F.count_if(F.col("achievement_pct") < 100).alias("below_target"))


def target_bands(src: Source, flt: Filters = ALL) -> DataFrame:
    return commission_last_month(src, flt).select("year_month", "full_name", "achievement_pct", "band")


def target_trend(src: Source, flt: Filters = ALL) -> DataFrame:
    c = commission_list(src, flt)
    s, t = F.sum(dec("sales_amount")), F.sum(dec("target_amount"))
    return c.groupBy("year_month").agg(
        F.coalesce(F.when(t > 0, F.round(s * 100 / t, 3)), F.lit(0)).cast("double").alias("achievement_pct"),
        F.count_if(F.col("achievement_pct") >= 100).alias("above_target"))
