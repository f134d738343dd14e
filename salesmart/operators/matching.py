"""Distributor product codes -> master products (D-8, D-9, A-10, J-2, B-5).

1. exact: (distributor, trimmed code) equi-join against the mapping table;
2. fuzzy: for rows without an exact hit whose description is longer than 3
   characters, the best token-set similarity (>= cutoff, first candidate on
   ties) against that distributor's mapping descriptions;
3. otherwise unmapped: product id NULL, the description kept as name, 0.0.

Scale: the mapping table is joined on (distributor, code) like any
dimension (Spark picks broadcast or shuffle by size). The fuzzy step runs
on *distinct* (distributor, description) pairs against the distinct
descriptions of the distributor, each at the position of its first mapping
row (identical descriptions score identically, so the first-best answer is
unchanged), by an index (``operators.fuzzy``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators.fuzzy import best_matches
from salesmart.session import materialize
from salesmart.sources.grid import CODES
from salesmart.sources.tables import Source


def load_mapping(raw: DataFrame) -> DataFrame:
    """Typed mapping table (A-10): confidence numeric (default 1.0), flag in {true, 1, yes}."""
    return raw.select(
        F.trim(F.col("distributor_code")).alias("distributor_code"),
        F.trim(F.col("dist_product_code")).alias("dist_product_code"),
        F.col("dist_product_desc"),
        F.col("sap_product_id"), F.col("sap_product_name"), F.col("sap_category"),
        F.coalesce(F.col("mapping_confidence").cast("string").try_cast("double"), F.lit(1.0))
        .alias("mapping_confidence"),
        F.lower(F.trim(F.col("validated_flag").cast("string"))).isin("true", "1", "yes").alias("validated_flag"),
        F.col("map_order"),
    )


def derive_mapping(src: Source) -> DataFrame:
    """The distributors' code lists as a mapping table, derived from the part table.

    Every part gets a row per external distributor with that distributor's
    code and description, except every eleventh part per distributor (those
    codes are unmapped and take the fuzzy path). The sixth distributor's
    list is padded differently from its workbooks, so its codes never match
    exactly either.
    """
    p = src.part
    rows = []
    for i, code in enumerate(CODES, start=1):
        pk = p.p_partkey.cast("string")
        code_expr = {
            "DIST_A": F.concat(F.lit("RA-"), pk), "DIST_B": F.concat(F.lit("MF"), F.lpad(pk, 6, "0")),
            "DIST_C": F.concat(F.lit("FC"), pk), "DIST_D": F.concat(F.lit("AF-"), pk),
            "DIST_E": F.concat(F.lit("BP"), F.lpad(pk, 2, "0"), F.lit("X")), "DIST_F": F.concat(F.lit("MD"), pk),
        }[code]
        desc = {
            "DIST_A": F.upper(p.p_name), "DIST_B": F.concat_ws(" ", p.p_name, p.p_type),
            "DIST_C": F.concat_ws(" ", p.p_name, F.lower(p.p_type)), "DIST_D": p.p_name,
            "DIST_E": F.concat_ws(" ", F.upper(p.p_name), F.lower(p.p_type)), "DIST_F": p.p_name,
        }[code]
        rows.append(p.filter(F.pmod(p.p_partkey + i, F.lit(11)) != 0).select(
            F.lit(code).alias("distributor_code"), code_expr.alias("dist_product_code"),
            desc.alias("dist_product_desc"), p.p_partkey.alias("sap_product_id"),
            p.p_name.alias("sap_product_name"), p.p_type.alias("sap_category"),
            F.when(F.pmod(p.p_partkey, F.lit(3)) == 0, F.lit(None)).otherwise(F.lit("1.0")).alias("mapping_confidence"),
            F.element_at(F.array(F.lit("true"), F.lit("1"), F.lit("yes"), F.lit("no")),
                         (F.pmod(p.p_partkey, F.lit(4)) + 1).cast("int")).alias("validated_flag"),
            (F.lit(i) * F.lit(1 << 40) + p.p_partkey).alias("map_order")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return load_mapping(out)


def _descriptions(mapping: DataFrame) -> DataFrame:
    """Fuzzy candidates: distinct descriptions per distributor, each at its first position."""
    return (mapping.groupBy(F.col("distributor_code").alias("g"), F.col("dist_product_desc").alias("t"))
            .agg(F.min_by(F.struct("map_order", "sap_product_id", "sap_product_name"), "map_order").alias("_m"))
            .select("g", "t", F.col("_m.map_order").alias("pos"),
                    F.struct(F.col("_m.sap_product_id").alias("id"), F.col("_m.sap_product_name").alias("name")).alias("hit")))


def map_product_codes(feed: DataFrame, mapping: DataFrame, *, code_col: str = "dist_product_code",
                      desc_col: str = "product_name_raw", cutoff: float = 70.0) -> DataFrame:
    """Add sap_product_id, sap_product_name, mapping_confidence, mapping_exact."""
    code = F.trim(F.coalesce(F.col(code_col).cast("string"), F.lit("")))
    desc = F.trim(F.coalesce(F.col(desc_col).cast("string"), F.lit("")))
    d = feed.withColumn("_code", code).withColumn("_desc", desc)
    # exact: the last mapping row of a repeated code wins, as in a code -> row lookup
    exact = (mapping.groupBy("distributor_code", F.col("dist_product_code").alias("_code"))
             .agg(F.max_by(F.struct("sap_product_id", "sap_product_name", "mapping_confidence"), "map_order")
                  .alias("_ex")))
    cands = _descriptions(mapping)
    # codes are looked up once each, and the few descriptions left are a table of known size: the lines, which are
    # wide, meet the codes in one shuffle, and the descriptions without one unless they are too many to send
    asked = d.select("distributor_code", "_code", "_desc").distinct().filter(F.length("_desc") > 3)
    need = (asked.join(exact, ["distributor_code", "_code"], "left_anti")
            .select(F.col("distributor_code").alias("g"), F.col("_desc").alias("q")).distinct())
    fz = best_matches(need, cands, cutoff).select(
        F.col("g").alias("distributor_code"), F.col("q").alias("_desc"), F.col("hit").alias("_hit"),
        (F.col("score") / 100).alias("_fzs"))
    d = d.join(exact, ["distributor_code", "_code"], "left")
    d = d.join(materialize(fz, "mapping-fuzzy"), ["distributor_code", "_desc"], "left")
    ex, hit = F.col("_ex"), F.col("_hit")
    return (d.withColumn("sap_product_id", F.coalesce(ex["sap_product_id"], hit["id"]))
             .withColumn("sap_product_name", F.when(ex.isNotNull(), ex["sap_product_name"])
                         .when(hit.isNotNull(), hit["name"]).otherwise(F.col(desc_col)))
             .withColumn("mapping_confidence", F.when(ex.isNotNull(), ex["mapping_confidence"])
                         .when(hit.isNotNull(), F.col("_fzs")).otherwise(F.lit(0.0)))
             .withColumn("mapping_exact", ex.isNotNull())
             .drop("_code", "_desc", "_ex", "_hit", "_fzs"))


def unmapped_report(mapped: DataFrame, *, code_col: str = "dist_product_code",
                    desc_col: str = "product_name_raw", seen_col: str = "extracted_at") -> DataFrame:
    """Unmapped codes with occurrence counts and first sighting (J-2, B-5 grouping)."""
    u = mapped.filter(F.col("sap_product_id").isNull())
    return u.groupBy(F.col("source_system"), F.col("distributor_code"),
                     F.trim(F.col(code_col)).alias("dist_product_code"),
                     F.trim(F.col(desc_col)).alias("product_description")).agg(
        F.count(F.lit(1)).alias("occurrence_count"), F.min(seen_col).alias("first_seen"))


#: Similarity in per cent below which a description is no suggestion.
SUGGEST_FROM = 40.0


def with_suggestions(report: DataFrame, mapping: DataFrame, least: float = SUGGEST_FROM) -> DataFrame:
    """Unmapped codes with ``suggested_match`` and ``similarity_score`` (0 to 1): the product whose description is
    nearest, from ``least`` per cent on, far below the cutoff of the mapping (J-2)."""
    need = report.select(F.col("distributor_code").alias("g"), F.col("product_description").alias("q")).distinct()
    best = best_matches(need, _descriptions(mapping), least).select(
        F.col("g").alias("distributor_code"), F.col("q").alias("product_description"),
        F.col("hit.name").alias("suggested_match"), F.round(F.col("score") / 100, 3).alias("similarity_score"))
    return report.join(best, ["distributor_code", "product_description"], "left")


def merge_unmapped(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Insert-if-absent with counts: existing keys add occurrences, keep the earliest sighting (B-5)."""
    keys = ["distributor_code", "dist_product_code", "product_description"]
    allrows = existing.select(*keys, "source_system", "occurrence_count", "first_seen").unionByName(
        new.select(*keys, "source_system", "occurrence_count", "first_seen"))
    return allrows.groupBy(*keys).agg(F.first("source_system").alias("source_system"),
                                      F.sum("occurrence_count").alias("occurrence_count"),
                                      F.min("first_seen").alias("first_seen"))
