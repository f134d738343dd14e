"""Date helpers (calendar attributes, localised names, integer date keys)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.sources.reference_data import DAY_NAMES_ES, MONTH_NAMES_ES


def month_name_es(month: Column) -> Column:
    """Spanish month name from a month number 1..12 (literal lookup, not locale)."""
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES_ES]), month)


def day_name_es(iso_dow: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES_ES]), iso_dow)


def year_month(d: Column) -> Column:
    """``YYYY-MM`` text of a date."""
    return F.date_format(d, "yyyy-MM")


def date_key(d: Column) -> Column:
    """Integer ``YYYYMMDD`` key."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def iso_day_of_week(d: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(d) + 1


def yyyymm_of_key(key: Column) -> Column:
    """``date_key / 100`` - the year*100+month part of a YYYYMMDD key."""
    return (key / 100).cast("int")


def year_of_ym(ym: Column) -> Column:
    """Year number of a ``YYYY-MM`` string."""
    return F.split_part(ym, F.lit("-"), F.lit(1)).cast("int")
