"""Data-quality, integrity, access and staging queries (J-3 ... J-5, C-16, C-20, C-21, B-1, B-2, D-1 ... D-7, K-17)."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators import cleanse as cl
from salesmart.operators import staging
from salesmart.operators.resolve import FACT_COLUMNS, resolve_keys
from salesmart.operators.security import NATIONAL_MANAGER, entitlements, secure_view
from salesmart.operators.upsert import FACT_KEY, FACT_UPDATABLE, merge
from salesmart.plans import marts
from salesmart.plans.cleansing_queries import DATA_AS_OF, DATA_MIN_DATE
from salesmart.plans.ingest import AS_OF
from salesmart.plans.reports import run_log
from salesmart.session import materialize_parts
from salesmart.sources import grid, star
from salesmart.sources.tables import Source

QUALITY_AS_OF = date(2001, 6, 1)
SPLIT = date(1998, 1, 1)         # rows booked, and files dated, before this are already loaded


# --------------------------------------------------------------------------- J-4 quality log

def quality_log(src: Source, as_of: date = QUALITY_AS_OF) -> DataFrame:
    """One-pass rule counts over the fact, unpivoted to (check, checked, failed, pct, severity)."""
    f = star.sales(src, include_deleted=True)
    rules = {
        "future_sale_date": F.col("sale_date") > F.lit(as_of),
        "deleted_line": F.col("is_deleted"),
        "negative_margin": F.col("margin_amount") < 0,
        "margin_pct_out_of_range": (F.col("margin_pct") < -100) | (F.col("margin_pct") > 200),
        "zero_discount": F.col("discount_pct") == 0,
        "quantity_over_45": F.col("quantity") > 45,
    }
    agg = f.agg(F.count(F.lit(1)).alias("checked"),
                *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    stacked = agg.unpivot(["checked"], list(rules), "check_name", "failed")
    pct = F.round(F.col("failed").cast("decimal(20,0)") * 100 / F.nullif(F.col("checked"), F.lit(0)), 3)
    return stacked.select("check_name", "checked", "failed", pct.cast("double").alias("pct_failed"),
                          F.when(pct > 5, "HIGH").when(pct > 1, "MEDIUM").otherwise("LOW").alias("severity"))


# --------------------------------------------------------------------------- J-5 referential integrity

FKS = [("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
       ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("orders", "o_custkey", "customer", "c_custkey"),
       ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"),
       ("nation", "n_regionkey", "region", "r_regionkey")]


def referential_integrity(src: Source) -> DataFrame:
    """Orphan count per foreign key (left-anti join per FK)."""
    out = None
    for child, ck, parent, pk in FKS:
        c = src.table(child).select(F.col(ck).alias("_k"))
        p = src.table(parent).select(F.col(pk).alias("_k"))
        orphans = c.join(p, "_k", "left_anti").agg(F.count(F.lit(1)).alias("orphans"))
        checked = c.agg(F.count(F.lit(1)).alias("rows_checked"))
        row = checked.select(F.lit(f"{child}.{ck}->{parent}.{pk}").alias("check_name"), "rows_checked",
                             orphans.scalar().alias("orphans"))
        out = row if out is None else out.unionByName(row)
    return out


# --------------------------------------------------------------------------- J-3 open issues

def open_issues(src: Source) -> DataFrame:
    """Failed loads, newest first."""
    r = run_log(src).filter(F.col("status") == "ERROR")
    return r.select("run_id", "source_system", "started_at", "records_read").orderBy(F.desc("started_at"),
                                                                                      F.desc("run_id"))


# --------------------------------------------------------------------------- C-20 / C-21

SECURE_PRINCIPAL = "SP-005"


def _secured(src: Source, principal: str) -> DataFrame:
    """The monthly zone mart of the rows that a principal may see: zones are cut before the aggregate."""
    ents = entitlements(src.spark)
    own = ents.filter(F.col("principal") == principal).select(F.col("zone_key").alias("own_zone")).distinct()
    f = star.sales(src)
    # one principal's zones: never more than there are zones, and a shuffle by them would have as few tasks
    m = marts.monthly_zone(src, f.join(F.broadcast(own), f["zone_key"] == own["own_zone"], "left_semi"))
    return secure_view(m.join(star.zones(src).select("zone_code", "zone_key"), "zone_code"), ents, principal).drop("zone_key")


def secure_zone_sales(src: Source) -> DataFrame:
    """Monthly zone mart as a zone manager sees it (own zone only)."""
    return _secured(src, SECURE_PRINCIPAL)


def national_zone_sales(src: Source) -> DataFrame:
    """Monthly zone mart as the national manager sees it (all zones, no cost or margin)."""
    return _secured(src, NATIONAL_MANAGER)


# --------------------------------------------------------------------------- B-1 / C-16 staging

def staging_payloads(src: Source) -> DataFrame:
    """Workbook rows staged as JSON payloads by header text, of files that no load has processed yet (B-1, C-16).

    Files dated before ``SPLIT`` are the ones that the ledger has as processed.
    """
    g = grid.land_grid(src)
    day = F.try_to_date(F.regexp_extract("file", r"_(\d{8})\.", 1), "yyyyMMdd")
    ledger = g.where(day < F.lit(SPLIT)).select(F.col("file").alias("source_file"), F.lit("processed").alias("outcome")).distinct()
    rows = staging.unprocessed(staging.payloads(g, AS_OF), ledger)
    return rows.select("distributor_id", "file_name", "sheet", "row_num", "raw_data", "extracted_at")


# --------------------------------------------------------------------------- B-2 merge semantics

RESEND_FROM = date(1997, 7, 1)   # the incoming batch re-sends from here, with revised amounts


def _fact_rows(src: Source) -> DataFrame:
    f = star.sales(src, include_deleted=True)
    return f.select("source_system", "source_record_id", "invoice_line", "sale_date",
                    "invoice_number", "client_key", "product_key", "zone_key",
                    F.col("quantity").cast("double").alias("quantity"),
                    "net_amount", "is_deleted")


def fact_upsert_merge(src: Source) -> DataFrame:
    """The table after upserting an overlapping batch: revised measures, kept keys, new rows added (B-2)."""
    rows = _fact_rows(src)
    others = [c for c in rows.columns if c not in FACT_KEY]
    # both sides unique on the key first (the table is unique by construction)
    current = cl.deduplicate(rows.filter(F.col("sale_date") < F.lit(SPLIT)), others, FACT_KEY)
    incoming = (rows.filter(F.col("sale_date") >= F.lit(RESEND_FROM))
                .withColumn("net_amount", F.round(F.col("net_amount") * F.lit("1.10").cast("decimal(3,2)"), 2)
                            .cast("decimal(15,2)"))
                .withColumn("client_key", F.col("client_key") + 1000000))
    incoming = cl.deduplicate(incoming, others, FACT_KEY)
    merged, _ = merge(current, incoming, FACT_KEY, [c for c in FACT_UPDATABLE if c in incoming.columns])
    return merged.withColumn("net_amount", F.col("net_amount").cast("double"))


# --------------------------------------------------------------------------- D-1 ... D-7

RESOLVED_AS_OF = datetime(2024, 1, 1)


#: Columns of the mapped feed that say which line of a fact a row is, and those from which the facts are made.
LINE_COLUMNS = ["source_file", "sheet", "row_num"]
LOOKUP_COLUMNS = ["sale_date", "sap_product_id", "client_id", "client_name_raw", "city_name_raw", "zone_code_raw",
                  "distributor_code", "salesperson_id"]


def resolved_feed_facts(src: Source) -> DataFrame:
    """Workbook lines mapped, cleansed and resolved to star-schema keys (D-1 ... D-7, C-17 ... C-19).

    Lines are numbered within their file and compared within their distributor, by invoice in both cases, so a large
    feed goes in parts by distributor and invoice: the shuffled lines of one part are gone before the next.
    """
    from salesmart.plans.cleansing_queries import ROUND_LINES, mapped_feed
    from salesmart.plans.load_jobs import default_dimensions, with_line_numbers
    feed, dims = mapped_feed(src), default_dimensions(src)
    used = {*LINE_COLUMNS, *LOOKUP_COLUMNS, *FACT_COLUMNS}
    feed = feed.select(*[c for c in feed.columns if c in used])

    def facts_of(lines: DataFrame) -> DataFrame:
        mapped = with_line_numbers(lines).withColumn("_seq", F.struct("source_file", "row_num")).drop(*LINE_COLUMNS)
        clean, _ = cl.cleanse(mapped, seq_col="_seq", as_of=DATA_AS_OF, min_date=DATA_MIN_DATE)
        facts, _ = resolve_keys(clean.drop("_seq"), dims, as_of=RESOLVED_AS_OF)
        return facts.withColumn("unresolved_keys", F.array_join("unresolved_keys", ","))

    lines = {code: n for code, n in feed.groupBy("distributor_code").count().collect()}    # a row for each layout
    if sum(lines.values()) <= ROUND_LINES:
        return facts_of(feed)

    def parts() -> Iterator[DataFrame]:
        for code, n in sorted(lines.items()):
            rounds = -(-n // ROUND_LINES)
            turn = F.pmod(F.xxhash64("invoice_number"), F.lit(rounds))
            for i in range(rounds):
                yield facts_of(feed.where((F.col("distributor_code") == code) & (turn == i)))

    return materialize_parts(parts(), "feed-facts", compression="zstd")
