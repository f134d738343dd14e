"""Row cleansing with explicit reject tables (C-11, C-12, G-5, J-1, L-4 ... L-7).

``cleanse(df)`` returns ``(clean, rejected)``. Every input row ends up in
exactly one of: clean, rejected (with ``rejection_reason``), or is removed as
an older duplicate of a kept row (counted, not lost silently):

    rows(input) = rows(clean) + rows(rejected) + duplicates_removed

All steps are column expressions or joins against bounded literal lists. The
fuzzy city step scores only the *distinct* unresolved normalised names, each
against a literal list of 32, and joins the answers back.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions import text as tx
from salesmart.functions.similarity import ratios, sorted_tokens
from salesmart.operators.fuzzy import best_matches
from salesmart.session import materialize
from salesmart.sources import reference_data as rd

CANONICAL_CITIES = sorted({c for _, c in rd.CITY_ALIASES})


# --------------------------------------------------------------------------- cities / zones

def _alias_lists(normalize_aliases: bool):
    keys = [(tx.normalize_text(F.lit(a)) if normalize_aliases else F.lit(a), F.lit(c))
            for a, c in rd.CITY_ALIASES]
    return F.array(*[F.struct(k.alias("k"), v.alias("v")) for k, v in keys])


def clean_city(df: DataFrame, col: str, *, threshold: float = rd.CITY_FUZZY_THRESHOLD,
               out: str = "city_name_clean", conf: str = "city_match_confidence",
               normalize_aliases: bool = True) -> DataFrame:
    """Canonical city name plus a confidence (L-4).

    blank -> default city 0.5; exact alias -> 1.0; first alias contained in
    the name (or containing it) -> 0.95; best token-sort similarity >=
    threshold against the canonical list -> score/100; else default 0.3.

    Everything is computed once per *distinct* spelling (a vocabulary-sized
    set) and joined back on the raw value, so the per-row cost on the big
    side is one hash lookup.
    """
    ordered = _alias_lists(normalize_aliases)
    spell = df.select(F.col(col).alias("_raw")).distinct()
    # an aggregate's result: no predicate on the answers moves the scoring below the distinct spellings
    d = spell.groupBy("_raw").agg(F.max(tx.normalize_text(F.col("_raw"))).alias("_cn"))
    d = d.withColumn("_blank", F.col("_raw").isNull() | (F.trim(F.col("_raw")) == ""))
    # exact lookup (first alias in list order; duplicate keys name the same city)
    d = d.withColumn("_ex", F.try_element_at(F.filter(ordered, lambda a: a["k"] == F.col("_cn")), F.lit(1))["v"])
    hit = F.filter(ordered, lambda a: F.contains(F.col("_cn"), a["k"]) | F.contains(a["k"], F.col("_cn")))
    d = d.withColumn("_sub", F.try_element_at(hit, F.lit(1))["v"])
    cand_norm = F.array(*[sorted_tokens(tx.normalize_text(F.lit(c))) for c in CANONICAL_CITIES])
    cand_name = F.array(*[F.lit(c) for c in CANONICAL_CITIES])
    fuzzy = ~F.col("_blank") & F.col("_ex").isNull() & F.col("_sub").isNull()
    # the first city of the highest token-sort similarity
    scores = ratios(sorted_tokens(F.when(fuzzy, F.col("_cn"))), cand_norm)
    d = d.withColumn("_b", F.array_max(F.transform(scores, lambda s, i: F.when(
        s >= threshold, F.struct(s.alias("score"), (-i).alias("back"))))))
    d = d.withColumn("_fz", F.get(cand_name, -F.col("_b.back"))).withColumn("_fzs", F.col("_b.score") / 100)
    city = (F.when(F.col("_blank"), F.lit(rd.DEFAULT_CITY))
            .when(F.col("_ex").isNotNull(), F.col("_ex"))
            .when(F.col("_sub").isNotNull(), F.col("_sub"))
            .when(F.col("_fz").isNotNull(), F.col("_fz"))
            .otherwise(F.lit(rd.DEFAULT_CITY)))
    confidence = (F.when(F.col("_blank"), F.lit(rd.CITY_CONF_BLANK))
                  .when(F.col("_ex").isNotNull(), F.lit(rd.CITY_CONF_EXACT))
                  .when(F.col("_sub").isNotNull(), F.lit(rd.CITY_CONF_SUBSTRING))
                  .when(F.col("_fz").isNotNull(), F.col("_fzs"))
                  .otherwise(F.lit(rd.CITY_CONF_UNKNOWN)))
    # a table of known size: the rows are shuffled only if there are too many spellings to send
    answers = materialize(d.select("_raw", city.alias(out), confidence.cast("double").alias(conf)), "city-answers")
    return df.join(answers, df[col].eqNullSafe(answers["_raw"]), "left").drop("_raw")


def zone_from_city(city: Column) -> Column:
    """Canonical city -> zone code, default CAP (L-6)."""
    m = F.create_map(*[x for c, z in rd.CITY_ZONE for x in (F.lit(c), F.lit(z))])
    return F.coalesce(F.try_element_at(m, city), F.lit(rd.DEFAULT_ZONE_CODE))


# --------------------------------------------------------------------------- products

def clean_product_name(df: DataFrame, col: str, products: DataFrame, *,
                       id_col: str = "product_id", name_col: str = "product_name", order_col: str | None = None,
                       threshold: float = rd.PRODUCT_FUZZY_THRESHOLD) -> DataFrame:
    """Canonical product name, confidence and matched id (L-7).

    Exact match on the normalised name (1.0), else best token-set similarity
    >= threshold over the normalised catalogue names (score/100), else the
    raw name with 0.0. Catalogue names that normalise alike collapse to one
    candidate: it keeps the position of its first entry and the id/name of
    its last entry. Blank input -> (raw, 0.0, NULL).
    """
    order = F.col(order_col) if order_col else F.col(id_col)
    cat = products.select(tx.normalize_text(F.col(name_col)).alias("_pn"), F.col(id_col).alias("_pid"),
                          F.col(name_col).alias("_pname"), order.alias("_ord"))
    cat = cat.groupBy("_pn").agg(F.min("_ord").alias("_first"),
                                 F.max_by(F.struct("_pid", "_pname"), "_ord").alias("_last"))
    raw = F.col(col)
    d = df.withColumn("_qn", tx.normalize_text(raw)).withColumn("_blank", raw.isNull() | (F.trim(raw) == ""))
    exact = cat.select(F.col("_pn").alias("_qn"), F.col("_last._pid").alias("_ex_id"),
                       F.col("_last._pname").alias("_ex_name"))
    d = d.join(exact, "_qn", "left")
    cands = cat.select(F.lit(0).alias("g"), F.col("_pn").alias("t"), F.col("_first").alias("pos"), F.col("_last").alias("hit"))
    need = d.filter(~F.col("_blank") & F.col("_ex_id").isNull()).select(F.lit(0).alias("g"), F.col("_qn").alias("q")).distinct()
    fz = best_matches(need, cands, threshold).select(
        F.col("q").alias("_qn"), F.col("hit").alias("_hit"), (F.col("score") / 100).alias("_fzs"))
    d = d.join(fz, "_qn", "left")
    blank = F.col("_blank")
    name = (F.when(blank, raw).when(F.col("_ex_id").isNotNull(), F.col("_ex_name"))
            .when(F.col("_hit").isNotNull(), F.col("_hit._pname")).otherwise(raw))
    conf = (F.when(blank, 0.0).when(F.col("_ex_id").isNotNull(), 1.0)
            .when(F.col("_hit").isNotNull(), F.col("_fzs")).otherwise(0.0))
    pid = (F.when(blank, F.lit(None)).when(F.col("_ex_id").isNotNull(), F.col("_ex_id"))
           .when(F.col("_hit").isNotNull(), F.col("_hit._pid")))
    return (d.withColumn("product_name_clean", name).withColumn("product_match_confidence", conf.cast("double"))
             .withColumn("matched_product_id", pid)
             .drop("_qn", "_blank", "_ex_id", "_ex_name", "_hit", "_fzs"))


# --------------------------------------------------------------------------- numeric / dates

def clip(c: Column, lo, hi) -> Column:
    """Clip into [lo, hi]; NULL stays NULL (greatest/least alone would skip it)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def validate_numeric(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numeric business rules (C-12).

    quantity <= 0 and unit_price <= 0 are invalid (NULLs pass); negative net
    is replaced by gross (NULL without a gross column); discount clipped to
    0..100 and margin % to -100..200 (NULLs stay NULL). Invalid rows go to
    the rejected frame with a reason instead of vanishing.
    """
    cols = df.columns
    bad = F.lit(None).cast("string")
    if "unit_price" in cols:
        bad = F.when(F.col("unit_price") <= 0, F.lit("invalid_unit_price")).otherwise(bad)
    if "quantity" in cols:
        bad = F.when(F.col("quantity") <= 0, F.lit("invalid_quantity")).otherwise(bad)
    d = df.withColumn("_bad", bad)
    if "net_amount" in cols:
        repl = F.col("gross_amount") if "gross_amount" in cols else F.lit(None)
        d = d.withColumn("net_amount", F.when(F.col("net_amount") < 0, repl).otherwise(F.col("net_amount")))
    if "discount_pct" in cols:
        d = d.withColumn("discount_pct", clip(F.col("discount_pct"), 0, 100))
    if "margin_pct" in cols:
        d = d.withColumn("margin_pct", clip(F.col("margin_pct"), -100, 200))
    ok = d.filter(F.col("_bad").isNull()).drop("_bad")
    rej = d.filter(F.col("_bad").isNotNull()).withColumnRenamed("_bad", "rejection_reason")
    return ok, rej


def parse_date(c: Column, fmt: str | None = None) -> Column:
    """String or date -> DATE; unparseable -> NULL (C-4). ``fmt=None`` tries common layouts."""
    if fmt:
        return F.try_to_date(c.cast("string"), fmt)
    layouts = ["yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy", "yyyy/MM/dd", "dd-MM-yyyy", "MM/dd/yyyy"]
    return F.coalesce(*[F.try_to_date(c.cast("string"), f) for f in layouts])


def validate_dates(df: DataFrame, date_col: str = "sale_date", min_date: str = rd.MIN_SALE_DATE,
                   as_of: date | None = None) -> tuple[DataFrame, DataFrame]:
    """Split on a valid date within [min_date, as_of] (C-11); NULL/unparseable/out of range rejected."""
    if date_col not in df.columns:
        return df, df.limit(0).withColumn("rejection_reason", F.lit(None).cast("string"))
    if not isinstance(df.schema[date_col].dataType, T.DateType):   # parse only text
        df = df.withColumn(date_col, parse_date(F.col(date_col)))
    d = df
    hi = F.lit(as_of) if as_of is not None else F.current_date()
    ok = F.col(date_col).isNotNull() & (F.col(date_col) >= F.lit(min_date).cast("date")) & (F.col(date_col) <= hi)
    d = d.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    return (d.filter("_ok").drop("_ok"),
            d.filter(~F.col("_ok")).drop("_ok").withColumn("rejection_reason", F.lit("invalid_date")))


# --------------------------------------------------------------------------- dedup

DEDUP_KEYS = ("source_system", "invoice_number", "invoice_line")


def deduplicate(df: DataFrame, order_cols: Sequence[str], keys: Sequence[str] = DEDUP_KEYS) -> DataFrame:
    """Keep the last row per key (G-5); ``order_cols`` define "last" (largest wins).

    Implemented as a grouped ``max_by`` over a struct of all columns: one
    hash aggregate with map-side combine, so a hot key (one invoice repeated
    millions of times) is reduced on every mapper before the shuffle - no
    window sorts a whole key group in one task.
    """
    present = [k for k in keys if k in df.columns]
    if not present:
        return df
    others = [c for c in df.columns if c not in present]
    if not others:
        return df.dropDuplicates(present)
    order = F.struct(*[F.col(c) for c in order_cols])
    kept = df.groupBy(*present).agg(F.max_by(F.struct(*others), order).alias("_r"))
    return kept.select(*present, "_r.*").select(*df.columns)


# --------------------------------------------------------------------------- pipeline

def cleanse(df: DataFrame, *, seq_col: str, as_of: date | None = None, min_date: str = rd.MIN_SALE_DATE,
            fuzzy_city_threshold: float = rd.CITY_FUZZY_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Full cleansing pipeline (J-1): dates -> numeric -> city -> client -> zone -> dedup.

    ``seq_col`` is the arrival order used by keep-last deduplication.
    """
    date_col = tx.first_existing(df.columns, "sale_date", "full_date")
    rejected = []
    if date_col:
        df, rej = validate_dates(df, date_col, min_date=min_date, as_of=as_of)
        rejected.append(rej)
    df, rej = validate_numeric(df)
    rejected.append(rej)
    city_col = tx.first_existing(df.columns, "city_name_raw", "city_name")
    if city_col:
        df = clean_city(df, city_col, threshold=fuzzy_city_threshold)
    else:
        df = df.withColumn("city_name_clean", F.lit(rd.DEFAULT_CITY)) \
               .withColumn("city_match_confidence", F.lit(rd.CITY_CONF_BLANK))
    client_col = tx.first_existing(df.columns, "client_name_raw", "client_name")
    if client_col:
        df = df.withColumn("client_name_clean", tx.clean_client_name(F.col(client_col)))
    zone_col = tx.first_existing(df.columns, "zone_code_raw", "zone_code")
    if zone_col:
        # zone spellings are a handful of distinct values: code them once, join back
        spell = df.select(F.col(zone_col).alias("_zraw")).distinct()
        codes = materialize(spell.select("_zraw", tx.zone_code(F.col("_zraw")).alias("zone_code_clean")), "zone-codes")
        df = df.join(codes, df[zone_col].eqNullSafe(codes["_zraw"]), "left").drop("_zraw")
    else:
        df = df.withColumn("zone_code_clean", zone_from_city(F.col("city_name_clean")))
    df = deduplicate(df, [seq_col])
    rej = rejected[0]
    for r in rejected[1:]:
        rej = rej.unionByName(r, allowMissingColumns=True)
    return df, rej

