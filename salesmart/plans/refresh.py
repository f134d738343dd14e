"""Marts of a warehouse, brought up to date after a load (B-8, I-5, M-3).

A load reports the dates and zones that it touched. Only the months (for ranked marts: the years) that hold
them are recomputed from the fact table and swapped in; all other partitions keep their files. Distinct counts
need no trick, as a partition is always recomputed from all its rows. Year over year also takes the same
month of the next year, and commissions the months that a longer time span adds without sales.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.dates import month_name_es, year_month
from salesmart.operators import swap
from salesmart.operators.commission import commission_monthly
from salesmart.operators.resolve import Dimensions
from salesmart.plans import marts
from salesmart.plans.load_jobs import Warehouse
from salesmart.session import materialize
from salesmart.sources import star
from salesmart.sources.reference_data import distributors_df
from salesmart.sources.tables import Source

MONTH, YEAR = ("year", "month_num"), ("year",)


def warehouse_sales(src: Source, wh: Warehouse, dims: Dimensions) -> DataFrame:
    """The loaded fact rows with the attributes that marts use; unknown members have null attributes."""
    f = swap.read(src.spark, wh.fact)
    f = f.where(~F.col("is_deleted"))
    amounts = {c: F.col(c).cast("decimal(15,2)") for c in ("gross_amount", "discount_amount", "net_amount", "cost_amount",
                                                           "margin_amount")}
    f = f.withColumns(amounts | {"quantity": F.col("quantity").cast("decimal(12,3)"),
                                 "unit_price": F.col("unit_price").cast("decimal(16,4)") if "unit_price" in f.columns
                                 else F.lit(None).cast("decimal(16,4)"),
                                 "margin_pct": F.col("margin_pct").cast("decimal(12,3)"),
                                 "sale_date": F.to_date(F.col("date_key").cast("string"), "yyyyMMdd")})
    f = f.withColumn("month_num", F.month("sale_date"))
    f = f.withColumns({"month_name": month_name_es(F.col("month_num")), "year_month": year_month(F.col("sale_date"))})
    sellers = distributors_df(src.spark).select("distributor_code", "distributor_name", "distributor_type")
    sellers = dims.distributors.select("distributor_key", "distributor_code").join(sellers, "distributor_code")
    clients = star.clients(src).select("client_key", "client_name", "client_type")
    products = star.products(src).select("product_key", "product_name", "category", "subcategory", "rx_otc_flag", "lab_name")
    return (f.join(dims.zones, "zone_key", "left").join(sellers, "distributor_key", "left")
            .join(dims.cities.select("city_key", "city_name"), "city_key", "left")
            .join(clients, "client_key", "left").join(products, "product_key", "left"))


@dataclass
class Marts:
    """The marts of one warehouse; calling it with touched (date_key, zone_key) refreshes them, with None rebuilds them."""

    src: Source
    wh: Warehouse
    dims: Dimensions

    @property
    def spark(self) -> SparkSession:
        return self.src.spark

    def path(self, name: str) -> str:
        return self.wh.path(name)

    def read(self, name: str) -> DataFrame | None:
        return swap.read(self.spark, self.path(name))

    def _write(self, name: str, df: DataFrame, by: tuple[str, ...], scope: DataFrame | None) -> None:
        """Swap in the partitions of ``scope`` (those without rows end), or the whole mart."""
        if scope is None:
            old = swap.read(self.spark, self.path(name))
            scope = df.select(*by).distinct() if old is None else old.select(*by).distinct()
        parts = ["/".join(swap.part_name(self.spark, c, r[c]) for c in by) for r in scope.select(*by).distinct().collect()]
        swap.replace(df, self.path(name), list(by), parts)

    def __call__(self, touched: DataFrame | None = None) -> None:
        sales = warehouse_sales(self.src, self.wh, self.dims)
        months = None
        if touched is not None and self.read("mv_sales_monthly_zone") is not None:
            day = F.to_date(F.col("date_key").cast("string"), "yyyyMMdd")
            months = materialize(touched.select(F.year(day).alias("year"), F.month(day).alias("month_num")).distinct(),
                                 "touched-months")
        years = None if months is None else months.select("year").distinct()

        def of(keys: DataFrame | None) -> DataFrame:
            return sales if keys is None else sales.join(keys, keys.columns, "left_semi")

        self._write("mv_sales_monthly_zone", marts.monthly_zone(self.src, of(months)), MONTH, months)
        monthly = self.read("mv_sales_monthly_zone")
        later = None if months is None else months.unionByName(months.select((F.col("year") + 1).alias("year"), "month_num")).distinct()
        growth = marts.sales_yoy(self.src, monthly)
        self._write("mv_sales_yoy", growth if later is None else growth.join(later, list(MONTH), "left_semi"), MONTH, later)
        ranked: dict[str, Callable[[Source, DataFrame], DataFrame]] = {
            "mv_top_clients": marts.top_clients, "mv_product_margin": marts.product_margin}
        for name, mart in ranked.items():
            self._write(name, mart(self.src, of(years)), YEAR, years)
        paid = self._months_to_pay(sales, months)
        self._write("mv_commission_monthly", commission_monthly(self.src, sales, paid), MONTH, paid)

    def _months_to_pay(self, sales: DataFrame, months: DataFrame | None) -> DataFrame | None:
        """Touched months, and months of the time span that the mart has not had yet."""
        if months is None:
            return None
        span = sales.agg(F.trunc(F.min("sale_date"), "month").alias("lo"), F.trunc(F.max("sale_date"), "month").alias("hi"))
        every = (span.where("lo IS NOT NULL").select(F.explode(F.expr("sequence(lo, hi, interval 1 month)")).alias("m"))
                 .select(F.year("m").alias("year"), F.month("m").alias("month_num")))
        new = every.join(self.read("mv_commission_monthly").select(*MONTH).distinct(), list(MONTH), "left_anti")
        return materialize(months.unionByName(new).distinct(), "months-to-pay")
