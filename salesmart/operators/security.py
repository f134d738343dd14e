"""Row- and column-level access (C-20, C-21).

Entitlements are data: one row per (principal, zone_key) a principal may
see, plus a per-principal flag for hidden cost/margin columns. A secured
view is a left-semi join of the data with the principal's entitlements
(Spark broadcasts the small entitlement set) and NULLs for hidden columns.
Entitlements combine restrictively: a principal sees only zones listed for
it, never "everything" because some other role allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.sources.reference_data import SALESPEOPLE

HIDDEN_FOR_NATIONAL = ("total_cost", "total_margin", "avg_margin_pct", "cost_amount", "margin_amount", "margin_pct")
NATIONAL_MANAGER = "NATIONAL"


def entitlements(spark: SparkSession, n_zones: int = 5) -> DataFrame:
    """Salespeople see their own zone; the national manager sees every zone without cost/margin."""
    rows = [(sid, "zone_manager", zk, False) for _, sid, _, zk, _, _ in SALESPEOPLE]
    rows += [(NATIONAL_MANAGER, "national_manager", z, True) for z in range(1, n_zones + 1)]
    return spark.createDataFrame(rows, "principal string, role string, zone_key int, hide_cost boolean")


def secure_view(df: DataFrame, ents: DataFrame, principal: str, zone_col: str = "zone_key",
                hidden: tuple[str, ...] = HIDDEN_FOR_NATIONAL) -> DataFrame:
    mine = ents.filter(F.col("principal") == principal)
    allowed = mine.select(F.col("zone_key").alias("_zk")).distinct()
    out = df.join(F.broadcast(allowed), df[zone_col] == allowed["_zk"], "left_semi")
    hide = mine.select(F.max(F.col("hide_cost").cast("int"))).scalar()
    for c in hidden:
        if c in out.columns:
            out = out.withColumn(c, F.when(F.coalesce(hide, F.lit(0)) == 1, F.lit(None).cast(out.schema[c].dataType))
                                 .otherwise(F.col(c)))
    return out
