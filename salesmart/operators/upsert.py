"""Idempotent upserts into parquet tables (B-2, B-3, B-4, B-6).

Parquet has no MERGE, so an upsert is:

1. keep-last deduplication of the incoming batch on the key;
2. a full outer join of the incoming rows with the *touched* partitions of
   the table only (partition pruning on the partition column);
3. matched keys take the incoming values of the updatable columns and keep
   everything else; new keys are inserted; untouched rows pass through;
4. the merged partitions are written beside the table and swapped in with one
   small file (``operators.swap``): a reader sees the table before or after the
   batch, also if the writer dies in between. Only the touched partitions change.

Insert/update counts come from the same pass through an ``Observation``.
Running the same batch twice leaves the table unchanged (second run: 0
inserted, n updated with identical values).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from salesmart.operators import swap
from salesmart.operators.cleanse import deduplicate
from salesmart.session import materialize

FACT_KEY = ("source_system", "source_record_id", "invoice_line")
# Only these change when a fact row is sent again (keys and invoice number stay).
FACT_UPDATABLE = ("quantity", "unit_price", "gross_amount", "discount_pct", "discount_amount", "net_amount",
                  "cost_amount", "margin_amount", "margin_pct", "load_timestamp", "is_deleted")
INT_COLUMNS = ("invoice_line",)
FLOAT_COLUMNS = ("quantity", "unit_price", "gross_amount", "discount_pct", "discount_amount", "net_amount",
                 "cost_amount", "margin_amount", "margin_pct")


def coerce_for_load(df: DataFrame) -> DataFrame:
    """Non-numeric values become 0 (B-3)."""
    for c in INT_COLUMNS:
        if c in df.columns:
            df = df.withColumn(c, F.coalesce(F.col(c).cast("string").try_cast("int"), F.lit(0)))
    for c in FLOAT_COLUMNS:
        if c in df.columns:
            df = df.withColumn(c, F.coalesce(F.col(c).cast("string").try_cast("double"), F.lit(0.0)))
    return df


def merge(current: DataFrame | None, incoming: DataFrame, key: Sequence[str], updatable: Sequence[str],
          order_col: str | None = None) -> tuple[DataFrame, Observation]:
    """Merged rows (current touched partitions + incoming) and the insert/update counters."""
    key = list(key)
    if order_col:
        incoming = deduplicate(incoming, [order_col], key).drop(order_col)
    cols = [c for c in incoming.columns]
    obs = Observation("upsert")
    if current is None:
        merged = incoming.withColumn("_m", F.lit(1))
    else:
        cur = current.select(*cols)
        inc = incoming.select(*[F.col(c).alias(f"_n_{c}") for c in cols])
        cond = None
        for k in key:
            c = cur[k].eqNullSafe(inc[f"_n_{k}"])
            cond = c if cond is None else cond & c
        j = cur.join(inc, cond, "full_outer")
        is_new = F.col(f"_n_{key[0]}").isNotNull() if key else F.lit(True)
        for k in key[1:]:
            is_new = is_new | F.col(f"_n_{k}").isNotNull()
        has_cur = F.lit(False)
        for k in key:
            has_cur = has_cur | F.col(k).isNotNull()
        sel = []
        for c in cols:
            if c in updatable:
                sel.append(F.when(is_new, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c))
            else:
                sel.append(F.when(has_cur, F.col(c)).otherwise(F.col(f"_n_{c}")).alias(c))
        merged = j.select(*sel, F.when(is_new & has_cur, F.lit(2)).when(is_new, F.lit(1)).otherwise(F.lit(0))
                          .alias("_m"))
    merged = merged.observe(obs, F.count_if(F.col("_m") == 1).alias("inserted"),
                            F.count_if(F.col("_m") == 2).alias("updated"))
    return merged.drop("_m"), obs


def upsert_table(spark, path: str, incoming: DataFrame, key: Sequence[str], updatable: Sequence[str],
                 partition_col: str | None = None, order_col: str | None = None,
                 touched: Sequence[str] = ()) -> dict:
    """Upsert ``incoming`` into the parquet table at ``path``; returns {inserted, updated}.

    With ``touched`` columns the result also has ``touched``: their distinct values in all rows that the
    batch inserts or updates, as the rows were and as they are sent.
    """
    swap.finish(spark, path)
    current = swap.read(spark, path)
    incoming = materialize(incoming, "upsert-batch")   # read several times: computed once
    places = list(dict.fromkeys([*([partition_col] if partition_col else []), *touched]))
    where = None
    if places:
        # partitions of the incoming rows, and those that hold the same keys today (a row may have moved)
        where = incoming.select(*places)
        if current is not None:
            same = incoming.select(*[F.col(k).alias(f"_k_{k}") for k in key]).distinct()
            cond = F.lit(True)
            for k in key:
                cond = cond & current[k].eqNullSafe(same[f"_k_{k}"])
            where = where.unionByName(current.join(same, cond, "left_semi").select(*places))
        where = materialize(where.distinct(), "upsert-touched")
    if current is not None and partition_col:
        parts = where.select(F.col(partition_col).alias("_part")).distinct()
        current = current.join(parts, current[partition_col].eqNullSafe(parts["_part"]), "left_semi")
    merged, obs = merge(current, incoming, key, updatable, order_col)
    by = [partition_col] if partition_col else []
    staged = swap.stage(merged, path, by)
    counts = obs.get
    # a partition whose rows all moved away has no folder among the new ones: it goes
    gone = [swap.part_name(spark, partition_col, r[0]) for r in parts.collect()] if current is not None and by else []
    swap.commit(spark, path, staged, by, gone)
    swap.finish(spark, path)
    out = {"inserted": int(counts.get("inserted", 0)), "updated": int(counts.get("updated", 0))}
    return out | {"touched": where.select(*touched).distinct()} if touched else out


def upsert_fact_sales(spark, path: str, incoming: DataFrame, order_col: str | None = None,
                      touched: Sequence[str] = ()) -> dict:
    """Fact upsert on (source_system, source_record_id, invoice_line), partitioned by year."""
    inc = coerce_for_load(incoming)
    if "year" not in inc.columns:
        inc = inc.withColumn("year", (F.col("date_key") / 10000).cast("int"))
    return upsert_table(spark, path, inc, FACT_KEY, FACT_UPDATABLE, "year", order_col, touched)


CLIENT_UPDATABLE = ("client_name", "client_name_norm", "client_type", "rnc", "updated_at")


def prepare_clients(df: DataFrame, as_of) -> DataFrame | None:
    """Client rows for the dimension upsert (B-4); None when required columns are missing."""
    if not {"client_id", "client_name"} <= set(df.columns):
        return None
    from salesmart.functions.text import lower_unaccent
    from salesmart.sources.reference_data import CLIENT_DEFAULT_CREDIT, CLIENT_DEFAULT_TERMS
    return df.select(
        F.col("client_id"),
        F.substring(F.col("client_name"), 1, 200).alias("client_name"),
        lower_unaccent(F.substring(F.col("client_name"), 1, 200)).alias("client_name_norm"),
        F.substring(F.coalesce(F.col("client_type") if "client_type" in df.columns else F.lit(None),
                               F.lit("FARMACIA")), 1, 40).alias("client_type"),
        (F.col("rnc") if "rnc" in df.columns else F.lit(None).cast("string")).alias("rnc"),
        F.lit(CLIENT_DEFAULT_CREDIT).cast("decimal(15,2)").alias("credit_limit"),
        F.lit(CLIENT_DEFAULT_TERMS).cast("smallint").alias("payment_terms"),
        F.lit(1).alias("city_key"), F.lit(1).alias("zone_key"),
        F.lit(as_of).cast("timestamp").alias("updated_at"))


def upsert_clients(spark, path: str, df: DataFrame, as_of) -> dict:
    rows = prepare_clients(df, as_of)
    if rows is None:
        return {"inserted": 0, "updated": 0}
    return upsert_table(spark, path, rows, ["client_id"], CLIENT_UPDATABLE)


def upsert_watermark(spark, path: str, source_system: str, value, as_of) -> dict:
    """Per-source high-water mark: keeps the greatest value seen (B-6)."""
    row = spark.createDataFrame([(source_system, value, as_of)],
                                "source_system string, last_value timestamp, updated_at timestamp")
    current = swap.read(spark, path)
    if current is not None:
        row = (current.unionByName(row).groupBy("source_system")
               .agg(F.max("last_value").alias("last_value"), F.max("updated_at").alias("updated_at")))
    swap.replace(row, path)
    return {"source_system": source_system}


def read_watermark(spark, path: str, source_system: str, default="2018-01-01 00:00:00"):
    """Current watermark of a source as a scalar Column (default when none yet)."""
    cur = swap.read(spark, path)
    if cur is None:
        return F.lit(default).cast("timestamp")
    v = cur.filter(F.col("source_system") == source_system).select(F.max("last_value")).scalar()
    return F.coalesce(v, F.lit(default).cast("timestamp"))
