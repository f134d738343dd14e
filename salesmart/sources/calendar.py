"""Calendar dimension (A-12) with holidays (B-9).

A daily spine ``explode(sequence(start, end))`` - one row per day, computed
per row with date functions; holidays are a left join against the literal
holiday list (broadcast) on ``MM-dd``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.dates import date_key, day_name_es, iso_day_of_week, month_name_es, year_month
from salesmart.sources.reference_data import holidays_df

DEFAULT_START, DEFAULT_END = date(2018, 1, 1), date(2030, 12, 31)


def calendar(spark: SparkSession, start: Column | date = DEFAULT_START, end: Column | date = DEFAULT_END) -> DataFrame:
    s = start if isinstance(start, Column) else F.lit(start)
    e = end if isinstance(end, Column) else F.lit(end)
    spine = spark.range(1).select(F.explode(F.sequence(s, e, F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    d = F.col("full_date")
    cal = spine.select(
        date_key(d).alias("date_key"), d,
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month_num"),
        month_name_es(F.month(d)).alias("month_name"),
        F.substring(month_name_es(F.month(d)), 1, 3).alias("month_name_short"),
        F.weekofyear(d).alias("week_num"), F.dayofmonth(d).alias("day_of_month"),
        iso_day_of_week(d).alias("day_of_week"), day_name_es(iso_day_of_week(d)).alias("day_name"),
        (iso_day_of_week(d) >= 6).alias("is_weekend"),
        F.year(d).alias("fiscal_year"), F.quarter(d).alias("fiscal_quarter"),
        year_month(d).alias("year_month"),
        F.date_format(d, "MM-dd").alias("_md"))
    hol = F.broadcast(holidays_df(spark))
    cal = cal.join(hol, cal._md == hol.mm_dd, "left")
    return cal.select(*[c for c in cal.columns if c not in ("_md", "mm_dd", "holiday_name")],
                      F.col("holiday_name").isNotNull().alias("is_holiday"), "holiday_name")
