"""Cleansing / matching operators applied to whole tables (L-1 ... L-9, C-11, C-12, G-5, D-8 ... D-10, J-2).

Inputs are the source tables or text derived from them by fixed rules (the
dirty spellings a distributor would send), so the work grows with the data.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions import text as tx
from salesmart.operators import cleanse as cl
from salesmart.operators.matching import derive_mapping, map_product_codes, unmapped_report, with_suggestions
from salesmart.plans.ingest import AS_OF
from salesmart.session import materialize, materialize_parts
from salesmart.sources import grid
from salesmart.sources.tables import Source

DATA_MIN_DATE = "1992-01-01"      # the order data starts in the 1990s
DATA_AS_OF = date(2024, 1, 1)

# FIXED VALUES (derivation rule): abbreviations prefixed / suffixed to client names.
NAME_PREFIXES = ["Fcia.", "Farm", "Drog.", "Cia", "Clinica", "Hosp.", "clin."]
NAME_SUFFIXES = [" S.R.L.", " SA", " srl", ""]


def dirty_client_names(src: Source) -> DataFrame:
    c = src.customer
    pre = F.element_at(F.array(*[F.lit(p) for p in NAME_PREFIXES]),
                       (F.pmod(c.c_custkey, F.lit(len(NAME_PREFIXES))) + 1).cast("int"))
    suf = F.element_at(F.array(*[F.lit(s) for s in NAME_SUFFIXES]),
                       (F.pmod(c.c_custkey, F.lit(len(NAME_SUFFIXES))) + 1).cast("int"))
    return c.select(c.c_custkey.alias("client_key"),
                    F.concat(F.lit("  "), pre, F.lit("  "), c.c_name, suf, F.lit(" ")).alias("client_name_raw"),
                    c.c_nationkey, c.c_acctbal)


def clean_text_documents(src: Source) -> DataFrame:
    """normalize_text over every document's whole text (L-1)."""
    d = src.documents
    n = tx.normalize_text(d.text)
    return d.select("doc_id", "lang", n.alias("normalized"),
                    F.when(n == "", F.lit(0)).otherwise(F.size(F.split(n, " "))).alias("n_tokens"))


def title_case_documents(src: Source) -> DataFrame:
    """Spanish title case of every document (L-3)."""
    d = src.documents
    return d.select("doc_id", tx.title_case_spanish(d.text).alias("titled"))


def client_names_clean(src: Source) -> DataFrame:
    """Client-name abbreviations expanded, normalised key and title case (L-8, L-2, L-3)."""
    c = dirty_client_names(src)
    clean = tx.clean_client_name(F.col("client_name_raw"))
    return c.select("client_key", "client_name_raw", clean.alias("client_name_clean"),
                    tx.lower_unaccent(clean).alias("client_name_norm"),
                    tx.title_case_spanish(clean).alias("client_name_title"))


def tax_ids_clean(src: Source) -> DataFrame:
    """Tax ids in several spellings, validated (L-9)."""
    c = src.customer
    k = c.c_custkey
    digits = F.lpad(k.cast("string"), 5, "0")
    raw = (F.when(F.pmod(k, F.lit(4)) == 0, F.concat(F.lit("1-01-"), digits, F.lit("-"), F.pmod(k, F.lit(10)).cast("string")))
           .when(F.pmod(k, F.lit(4)) == 1, F.concat(F.lit("1 01 "), digits, F.lit(" "), F.pmod(k, F.lit(10)).cast("string")))
           .when(F.pmod(k, F.lit(4)) == 2, F.concat(F.lit("RNC "), F.lpad(k.cast("string"), 9, "0")))
           .otherwise(digits))
    return c.select(k.alias("client_key"), raw.alias("rnc_raw"), tx.clean_tax_id(raw).alias("rnc"))


def dr_zone_names(src: Source) -> DataFrame:
    """Zone text as distributors write it, one per customer (by its region)."""
    c = src.customer.join(src.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    z = F.element_at(F.array(*[F.lit(x) for x in grid.DR_ZONES]), (F.col("n_regionkey") + 1).cast("int"))
    v = F.pmod(F.col("c_custkey"), F.lit(4))
    raw = (F.when(v == 0, z).when(v == 1, F.upper(z)).when(v == 2, F.substring(F.lower(z), 1, 3))
           .otherwise(F.lit(None).cast("string")))
    return c.select(F.col("c_custkey").alias("client_key"), raw.alias("zone_raw"))


def zone_codes_clean(src: Source) -> DataFrame:
    """Zone aliases -> codes, default CAP (L-5)."""
    z = dr_zone_names(src)
    return z.select("client_key", "zone_raw", tx.zone_code(F.col("zone_raw")).alias("zone_code"))


def dedup_order_lines(src: Source) -> DataFrame:
    """Keep-last deduplication of order lines on (source, invoice, line) (G-5).

    "Last" = greatest (ship date, part, supplier, price, quantity, discount).
    """
    li = src.lineitem
    d = li.select(F.lit("SAP_HANA").alias("source_system"), li.l_orderkey.alias("invoice_number"),
                  li.l_linenumber.alias("invoice_line"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                  "l_discount", F.to_date("l_shipdate").alias("ship_date"))
    d = d.withColumn("_seq", F.struct("ship_date", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
                                      "l_discount"))
    return cl.deduplicate(d, ["_seq"]).drop("_seq")


def _dated_lines(src: Source) -> DataFrame:
    li = src.lineitem
    txt = (F.when(F.pmod(li.l_orderkey, F.lit(13)) == 0, F.lit("not-a-date"))
           .when(li.l_linenumber == 7, F.lit("2099-01-01"))
           .when(F.pmod(li.l_orderkey, F.lit(29)) == 0, F.lit(None).cast("string"))
           .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")))
    return li.select(li.l_orderkey.alias("invoice_number"), li.l_linenumber.alias("invoice_line"),
                     txt.alias("sale_date"))


def date_validation(src: Source) -> DataFrame:
    """Valid / rejected split on sale dates (C-4, C-11); both sides returned with a reason column."""
    ok, rej = cl.validate_dates(_dated_lines(src), "sale_date", min_date=DATA_MIN_DATE, as_of=DATA_AS_OF)
    return ok.withColumn("rejection_reason", F.lit(None).cast("string")).unionByName(rej)


def numeric_validation(src: Source) -> DataFrame:
    """Numeric rules (C-12) on quantities/prices/discounts shifted into invalid ranges by a fixed rule."""
    li = src.lineitem
    d = li.select(li.l_orderkey.alias("invoice_number"), li.l_linenumber.alias("invoice_line"),
                  (li.l_quantity - 3).alias("quantity"),
                  F.when(li.l_linenumber == 6, -li.l_extendedprice / li.l_quantity)
                  .otherwise(li.l_extendedprice / li.l_quantity).alias("unit_price"),
                  F.round(li.l_extendedprice, 2).alias("gross_amount"),
                  F.when(li.l_linenumber == 5, -li.l_extendedprice).otherwise(li.l_extendedprice * (1 - li.l_discount))
                  .alias("net_amount"),
                  (li.l_discount * 1500 - 20).alias("discount_pct"))
    ok, rej = cl.validate_numeric(d)
    return ok.withColumn("rejection_reason", F.lit(None).cast("string")).unionByName(rej)


def city_cleansing(src: Source) -> DataFrame:
    """City names as distributors spell them -> canonical city and confidence (L-4, L-6, D-10)."""
    c = src.customer.select(F.col("c_custkey").alias("client_key"),
                            grid.dirty_city(F.col("c_custkey")).alias("city_raw"))
    out = cl.clean_city(c, "city_raw")
    return out.select("client_key", "city_raw", "city_name_clean", "city_match_confidence",
                      cl.zone_from_city(F.col("city_name_clean")).alias("zone_code"))


_MAPPED: dict[tuple[str, str, str], DataFrame] = {}
#: Lines whose shuffles stand on disk together; a larger feed is worked through in parts, one after the other.
ROUND_LINES = 1 << 23


def mapped_feed(src: Source) -> DataFrame:
    """The parsed workbook rows with their mapped products, written once per version of the source's files.

    A large feed is written distributor by distributor, so that the shuffled lines of one are gone before the next, and
    not a second time as the parsed feed: who asks for that later reads its columns here.
    """
    key = src.state_key()
    if key not in _MAPPED:
        large = grid.land_grid(src).count() > ROUND_LINES
        feed = grid.parsed_feed(src, AS_OF, keep=not large)
        mapped = map_product_codes(feed, derive_mapping(src))
        if large:
            parts = [mapped.where(F.col("distributor_code") == code) for code in grid.CODES]
            _MAPPED[key] = materialize_parts(parts, "mapped-feed", ["distributor_code"], "zstd")
        else:
            _MAPPED[key] = materialize(mapped, "mapped-feed", ["distributor_code"], "zstd")
        grid.keep_parsed(src, _MAPPED[key].select(*feed.columns))
    return _MAPPED[key]


def product_code_mapping(src: Source) -> DataFrame:
    """Exact then fuzzy product-code mapping of every workbook line (D-8, D-9)."""
    return mapped_feed(src).select("distributor_code", "source_file", "row_num", "dist_product_code",
                                   "product_name_raw", F.col("sap_product_id").cast("string").alias("sap_product_id"),
                                   "sap_product_name", "mapping_confidence", "mapping_exact")


def unmapped_products(src: Source) -> DataFrame:
    """Codes left without a product, with counts, first sighting and the nearest description (J-2)."""
    return with_suggestions(unmapped_report(mapped_feed(src)), derive_mapping(src))


def product_name_cleansing(src: Source) -> DataFrame:
    """Workbook product descriptions -> catalogue names (L-7)."""
    feed = grid.parsed_feed(src, AS_OF).select("product_name_raw").distinct()
    prods = src.part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"))
    out = cl.clean_product_name(feed, "product_name_raw", prods)
    return out.withColumn("matched_product_id", F.col("matched_product_id").cast("string"))
