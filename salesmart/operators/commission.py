"""Monthly commissions per salesperson (E-8) and the commission mart (G-3).

For every active salesperson and every month between the first and the last
sale, sales are the month's non-deleted net amount (0 when none - people
with no sales are kept). Then:

* achievement = round(sales / target * 100, 3), 0 when target <= 0;
* commission  = round(sales * rate, 2);
* bonus       = round(sales * rate * 0.10, 2) when target > 0 and sales >= target;
* payout      = round(sales * rate + unrounded bonus, 2).

The salesperson x month grid is generated per salesperson with
``explode(sequence(first month, last month))`` where the bounds are a scalar
subquery over the fact; the monthly sales are one grouped aggregate joined
to it. No cross join, nothing collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.dates import year_month
from salesmart.operators.ranking import rank_over
from salesmart.sources import star
from salesmart.sources.reference_data import BONUS_SHARE
from salesmart.sources.tables import Source


def fact_commission(src: Source, facts: DataFrame | None = None, months: DataFrame | None = None) -> DataFrame:
    """Commissions of all sales or of the given rows; of all months or of those in ``months`` (year, month_num)."""
    f = facts if facts is not None else star.sales(src, client=False, product=False)
    f = f.filter(~F.col("is_deleted"))
    of = f if months is None else f.join(months, ["year", "month_num"], "left_semi")
    monthly = (of.withColumn("month_start", F.trunc("sale_date", "month"))
               .groupBy("salesperson_key", "month_start")
               .agg(F.sum("net_amount").alias("_sales")))
    lo = f.select(F.trunc(F.min("sale_date"), "month")).scalar()
    hi = f.select(F.trunc(F.max("sale_date"), "month")).scalar()
    sp = star.salespeople(src).filter(F.col("active_flag"))
    grid = sp.select("*", F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    if months is not None:
        grid = grid.withColumns({"year": F.year("month_start"), "month_num": F.month("month_start")})
        grid = grid.join(months, ["year", "month_num"], "left_semi").drop("year", "month_num")
    j = grid.join(monthly, ["salesperson_key", "month_start"], "left")
    sales = F.coalesce(F.col("_sales"), F.lit(0).cast("decimal(25,2)"))
    target, rate = F.col("monthly_target"), F.col("commission_rate")
    met = (target > 0) & (sales >= target)
    bonus_raw = sales * rate * F.lit(BONUS_SHARE).cast("decimal(2,2)")
    return j.select(
        (F.year("month_start") * 10000 + F.month("month_start") * 100 + 1).alias("date_key"),
        year_month(F.col("month_start")).alias("year_month"),
        F.year("month_start").alias("year"),
        F.month("month_start").alias("month_num"),
        "salesperson_key", "salesperson_id", "full_name",
        F.col("sp_zone_key").alias("zone_key"),
        sales.alias("sales_amount"),
        target.alias("target_amount"),
        F.when(target > 0, F.round(sales * 100 / target, 3)).otherwise(F.lit(0)).alias("achievement_pct"),
        rate.alias("commission_rate"),
        F.round(sales * rate, 2).alias("commission_amount"),
        F.when(met, F.round(bonus_raw, 2)).otherwise(F.lit(0)).alias("bonus_amount"),
        F.round(sales * rate + F.when(met, bonus_raw).otherwise(F.lit(0)), 2).alias("total_payout"),
        F.lit(False).alias("paid_flag"),
    )


def commission_monthly(src: Source, facts: DataFrame | None = None, months: DataFrame | None = None) -> DataFrame:
    """Commission mart: one row per salesperson-month with its rank in the month."""
    fc = fact_commission(src, facts, months)
    z = star.zones(src)
    m = fc.join(z, "zone_key")
    # at most one row per salesperson in a month: the window is bounded by the
    # salesperson dimension, not by the data
    m = rank_over(m, ["year_month"], [("sales_amount", True)], out="rank_in_month", small=True)
    return m.select(
        "year_month", "year", "month_num", "salesperson_id",
        F.col("full_name").alias("salesperson_name"), "zone_name",
        F.col("sales_amount").cast("double").alias("sales_amount"),
        F.col("target_amount").cast("double").alias("target_amount"),
        F.col("achievement_pct").cast("double").alias("achievement_pct"),
        (F.col("commission_rate") * 100).cast("double").alias("commission_rate_pct"),
        F.col("commission_amount").cast("double").alias("commission_amount"),
        F.col("bonus_amount").cast("double").alias("bonus_amount"),
        F.col("total_payout").cast("double").alias("total_payout"),
        "paid_flag", F.col("rank_in_month").cast("int").alias("rank_in_month"))
