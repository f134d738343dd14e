"""The warehouse marts (materialised and plain views) as DataFrame plans.

Each function takes the ``Source`` and returns the mart. ``refresh_marts``
writes them in dependency order (year-over-year reads monthly_zone).

Scale notes:
* every mart is one grouped aggregate over the fact (partial aggregation on
  the map side, final on the reduce side; exact COUNT DISTINCT is Catalyst's
  Expand rewrite);
* the yearly rankings do not use a year-wide window (one task per year):
  see ``operators.ranking.rank_over``;
* year-over-year is a join of the (small) monthly mart with itself on the
  shifted year; the mart is computed once and its exchange reused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.dates import month_name_es, year_month
from salesmart.functions.measures import mean, money, ratio, total
from salesmart.operators.ranking import rank_over
from salesmart.sources import star
from salesmart.sources.reference_data import DISTRIBUTORS
from salesmart.sources.tables import Source


def monthly_zone(src: Source, f: DataFrame | None = None) -> DataFrame:
    """Monthly sales by zone and distributor (E-1), of all sales or of the given rows."""
    f = star.sales(src) if f is None else f
    keys = ["year_month", "year", "month_num", "month_name", "zone_code", "zone_name",
            "distributor_code", "distributor_name", "distributor_type"]
    # grouped by the keys that determine the others; counting distinct values shuffles a row for each of them
    g = f.groupBy("year", "month_num", "zone_code", "zone_name", "distributor_code").agg(
        F.count_distinct("invoice_number").alias("invoice_count"),
        F.count(F.lit(1)).alias("line_count"),
        F.sum("quantity").cast("double").alias("total_quantity"),
        total("gross_amount").alias("total_gross"),
        total("discount_amount").alias("total_discount"),
        total("net_amount").alias("total_net"),
        total("cost_amount").alias("total_cost"),
        total("margin_amount").alias("total_margin"),
        mean("margin_pct", 3).alias("avg_margin_pct"),
        F.count_distinct("client_key").alias("active_clients"),
        # average ticket per distinct CLIENT in this mart
        ratio(F.sum("net_amount"), F.count_distinct("client_key"), 2).alias("avg_ticket"),
    )
    sellers = {d[1]: d for d in DISTRIBUTORS}

    def seller(n: int) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for code, d in sellers.items() for x in (code, d[n])]), F.col("distributor_code"))

    g = g.withColumns({"month_name": month_name_es(F.col("month_num")),
                       "year_month": year_month(F.make_date("year", "month_num", F.lit(1))),
                       "distributor_name": seller(2), "distributor_type": seller(3)})
    return g.select(*keys, *[c for c in g.columns if c not in keys])


def sales_yoy(src: Source, monthly: DataFrame | None = None) -> DataFrame:
    """Year-over-year by month, zone and distributor (D-12).

    The prior-year side is matched on (year - 1, month, zone, distributor);
    distributor_code is part of the output so rows are unique.
    """
    m = monthly if monthly is not None else monthly_zone(src)
    cur = m.select("year_month", "year", "month_num", "zone_code", "zone_name", "distributor_code",
                   F.col("total_net").alias("current_sales"), "active_clients", "avg_ticket",
                   "avg_margin_pct")
    prev = m.select((F.col("year") + 1).alias("year"), "month_num", "zone_code", "distributor_code",
                    F.col("total_net").alias("prior_year_sales"))
    j = cur.join(prev, ["year", "month_num", "zone_code", "distributor_code"], "left")
    cur_d = F.col("current_sales").cast("decimal(20,2)")
    prev_d = F.col("prior_year_sales").cast("decimal(20,2)")
    return j.select(
        "year_month", "year", "month_num", "zone_code", "zone_name", "distributor_code",
        "current_sales", "prior_year_sales",
        money(cur_d - F.coalesce(prev_d, F.lit(0)), 2).alias("yoy_variance"),
        F.when(F.coalesce(prev_d, F.lit(0)) > 0,
               F.round((cur_d - prev_d) * 100 / prev_d, 2)).cast("double").alias("yoy_growth_pct"),
        "active_clients", "avg_ticket", "avg_margin_pct",
    )


def top_clients(src: Source, f: DataFrame | None = None) -> DataFrame:
    """Client x month mart with the rank of each client-month inside its year (E-2, G-1).

    The rank is over client-*month* groups, as in the warehouse view.
    """
    f = star.sales(src) if f is None else f
    sp = star.salespeople(src).select("salesperson_key", F.col("full_name").alias("salesperson"))
    f = f.join(sp, "salesperson_key")
    keys = ["client_key", "client_name", "client_type", "zone_name", "city_name", "salesperson",
            "year", "year_month"]
    g = f.groupBy(*keys).agg(
        F.count_distinct("invoice_number").alias("invoice_count"),
        F.sum("quantity").alias("_qty"),
        F.sum("net_amount").alias("_net"),
        F.sum("margin_amount").alias("_margin"),
        mean("margin_pct", 3).alias("avg_margin_pct"),
        ratio(F.sum("net_amount"), F.count_distinct("invoice_number"), 2).alias("avg_ticket"),
    )
    g = rank_over(g, ["year"], [("_net", True)], out="rank_by_year", tie_breakers=["client_key", "year_month"])
    return g.select(
        *keys, "invoice_count",
        F.col("_qty").cast("double").alias("total_quantity"),
        money(F.col("_net")).alias("total_net"),
        money(F.col("_margin")).alias("total_margin"),
        "avg_margin_pct", "avg_ticket", "rank_by_year")


def product_margin(src: Source, f: DataFrame | None = None) -> DataFrame:
    """Product x lab x month x zone margins, ranked inside (year, zone) (E-3, G-2)."""
    f = star.sales(src) if f is None else f
    keys = ["product_key", "product_name", "category", "subcategory", "rx_otc_flag", "lab_name",
            "year", "year_month", "zone_name"]
    g = f.groupBy(*keys).agg(
        F.sum("quantity").alias("_qty"),
        F.sum("net_amount").alias("_net"),
        F.sum("cost_amount").alias("_cost"),
        F.sum("margin_amount").alias("_margin"),
        mean("margin_pct", 3).alias("avg_margin_pct"),
        mean("unit_price", 4).alias("avg_unit_price"),
    )
    g = rank_over(g, ["year", "zone_name"], [("_net", True)], out="rank_in_zone_year",
                  tie_breakers=["product_key", "year_month"])
    return g.select(
        *keys,
        F.col("_qty").cast("double").alias("total_quantity"),
        money(F.col("_net")).alias("total_net"),
        money(F.col("_cost")).alias("total_cost"),
        money(F.col("_margin")).alias("total_margin"),
        "avg_margin_pct", "avg_unit_price", "rank_in_zone_year")


def sales_by_city(src: Source) -> DataFrame:
    """City x month sales with coordinates (E-4)."""
    f = star.sales(src, product=False)
    geo = star.cities(src).select("city_key", "latitude", "longitude")
    f = f.join(geo, "city_key")
    return f.groupBy("city_name", "latitude", "longitude", "zone_name", "year", "year_month").agg(
        F.count_distinct("invoice_number").alias("invoice_count"),
        total("net_amount").alias("total_net"),
        F.count_distinct("client_key").alias("active_clients"))


def sales_by_category(src: Source) -> DataFrame:
    """Category / subcategory / RX-OTC sales (E-5)."""
    f = star.sales(src)
    return f.groupBy("category", "subcategory", "rx_otc_flag", "zone_name", "year", "year_month").agg(
        F.sum("quantity").cast("double").alias("total_quantity"),
        total("net_amount").alias("total_net"),
        total("margin_amount").alias("total_margin"),
        mean("margin_pct", 3).alias("avg_margin_pct"))


def avg_ticket(src: Source) -> DataFrame:
    """Average ticket per client type (E-6): net / distinct INVOICES."""
    f = star.sales(src, product=False)
    return f.groupBy("client_type", "zone_name", "year", "year_month").agg(
        F.count_distinct("invoice_number").alias("invoice_count"),
        F.count_distinct("client_key").alias("client_count"),
        total("net_amount").alias("total_net"),
        ratio(F.sum("net_amount"), F.count_distinct("invoice_number"), 2).alias("avg_ticket"))


def distributor_vs_internal(src: Source) -> DataFrame:
    """Distributor vs internal sales (E-7)."""
    f = star.sales(src)
    # grouped by the keys that determine the others, as in monthly_zone
    g = f.groupBy("distributor_key", "zone_name", "year", "month_num").agg(
        F.count_distinct("invoice_number").alias("invoice_count"),
        F.sum("quantity").cast("double").alias("total_quantity"),
        total("net_amount").alias("total_net"),
        total("margin_amount").alias("total_margin"),
        mean("margin_pct", 3).alias("avg_margin_pct"),
        F.count_distinct("client_key").alias("active_clients"))
    return g.select(star.of_distributor(3).alias("distributor_type"), star.of_distributor(2).alias("distributor_name"), "zone_name", "year",
                    year_month(F.make_date("year", "month_num", F.lit(1))).alias("year_month"), *g.columns[4:])


def client_year_ranking(src: Source) -> DataFrame:
    """Clients ranked inside each year by their yearly net sales (the client-year rank, Q11)."""
    f = star.sales(src, product=False)
    g = f.groupBy("client_key", "client_name", "year").agg(
        F.sum("net_amount").alias("_net"), F.count_distinct("invoice_number").alias("invoice_count"))
    g = rank_over(g, ["year"], [("_net", True)], out="rank_in_year", tie_breakers=["client_key"])
    return g.select("client_key", "client_name", "year", "invoice_count",
                    money(F.col("_net")).alias("total_net"), "rank_in_year")
