"""Global report filters (C-14, C-23, C-24).

An empty selection means "all" - the predicate is simply not added, so the
plan carries no IN-list at all. Non-empty lists become ``isin`` predicates
that Catalyst pushes below the joins (and, for columns that live on a scan,
into the parquet reader).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Filters:
    years: tuple[int, ...] = ()
    zones: tuple[str, ...] = ()
    categories: tuple[str, ...] = ()
    distributor_types: tuple[str, ...] = ()
    client_types: tuple[str, ...] = ()
    date_from: date | None = None
    date_to: date | None = None       # inclusive
    last_n_months: int | None = None  # relative to as_of
    as_of: date | None = None

    @property
    def needs_product(self) -> bool:
        return bool(self.categories)

    def apply(self, df: DataFrame) -> DataFrame:
        preds = []
        if self.years:
            preds.append(F.col("year").isin(list(self.years)))
        if self.zones:
            preds.append(F.col("zone_name").isin(list(self.zones)))
        if self.categories:
            preds.append(F.col("category").isin(list(self.categories)))
        if self.distributor_types:
            preds.append(F.col("distributor_type").isin(list(self.distributor_types)))
        if self.client_types:
            preds.append(F.col("client_type").isin(list(self.client_types)))
        if self.date_from is not None:
            preds.append(F.col("sale_date") >= F.lit(self.date_from))
        if self.date_to is not None:
            preds.append(F.col("sale_date") <= F.lit(self.date_to))
        if self.last_n_months is not None:
            anchor = F.lit(self.as_of) if self.as_of is not None else F.current_date()
            preds.append(F.col("sale_date") >= F.add_months(anchor, -self.last_n_months))
        for p in preds:
            df = df.filter(p)
        return df


ALL = Filters()
