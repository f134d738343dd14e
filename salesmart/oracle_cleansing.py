"""Oracle SQL for the cleansing queries that SQL can express (no fuzzy scoring)."""

from __future__ import annotations

from salesmart.functions.text import ACCENTED, MULTI_TRANSLIT, NON_WORD, UNACCENTED, WS
from salesmart.oracle_sql import ORACLE
from salesmart.plans.cleansing_queries import DATA_AS_OF, DATA_MIN_DATE, NAME_PREFIXES, NAME_SUFFIXES
from salesmart.sources.grid import DR_ZONES
from salesmart.sources.reference_data import CLIENT_NAME_RULES, SPANISH_LOWER_WORDS, ZONE_ALIASES


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def unaccent(x: str) -> str:
    out = f"translate({x}, {q(ACCENTED)}, {q(UNACCENTED)})"
    for a, b in MULTI_TRANSLIT:
        out = f"replace({out}, {q(a)}, {q(b)})"
    return out


def normalize(x: str) -> str:
    s = f"regexp_replace(COALESCE({x}, ''), {q('^' + WS + '+|' + WS + '+$')}, '', 'g')"
    s = f"lower({unaccent(s)})"
    s = f"regexp_replace({s}, {q(NON_WORD)}, ' ', 'g')"
    s = f"regexp_replace({s}, {q(WS + '+')}, ' ', 'g')"
    return f"regexp_replace({s}, '^ | $', '', 'g')"


def title(x: str) -> str:
    trimmed = f"regexp_replace(lower({x}), {q('^' + WS + '+|' + WS + '+$')}, '', 'g')"
    small = "[" + ", ".join(q(w) for w in SPANISH_LOWER_WORDS) + "]"
    words = f"string_split_regex({trimmed}, {q(WS + '+')})"
    cap = (f"list_transform({words}, lambda w, i: CASE WHEN i = 1 OR NOT list_contains({small}, w) "
           f"THEN (CASE WHEN substr(w, 1, 1) = 'ß' THEN 'Ss' ELSE upper(substr(w, 1, 1)) END) || substr(w, 2) "
           f"ELSE w END)")
    blank = f"regexp_replace({x}, {q('^' + WS + '+|' + WS + '+$')}, '', 'g') = ''"
    return f"CASE WHEN {x} IS NULL OR {blank} THEN {x} ELSE array_to_string({cap}, ' ') END"


def client_clean(x: str) -> str:
    s = f"regexp_replace(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g')"
    for pat, rep in CLIENT_NAME_RULES:
        s = f"regexp_replace({s}, {q('(?i)' + pat)}, {q(rep)}, 'g')"
    return f"regexp_replace({s}, '^\\s+|\\s+$', '', 'g')"


def pick(xs, expr: str) -> str:
    return "[" + ", ".join(q(x) for x in xs) + f"][CAST({expr} AS INTEGER) + 1]"


ORACLE["clean_text_documents"] = f"""
WITH n AS (SELECT doc_id, lang, {normalize('text')} AS normalized FROM documents)
SELECT doc_id, lang, normalized,
       CAST(CASE WHEN normalized = '' THEN 0 ELSE len(string_split(normalized, ' ')) END AS INTEGER) AS n_tokens
FROM n"""

ORACLE["title_case_documents"] = f"SELECT doc_id, {title('text')} AS titled FROM documents"

DIRTY = (f"'  ' || {pick(NAME_PREFIXES, f'c_custkey % {len(NAME_PREFIXES)}')} || '  ' || c_name || "
         f"{pick(NAME_SUFFIXES, f'c_custkey % {len(NAME_SUFFIXES)}')} || ' '")
ORACLE["client_names_clean"] = f"""
WITH c AS (SELECT c_custkey AS client_key, {DIRTY} AS client_name_raw FROM customer),
k AS (SELECT *, {client_clean('client_name_raw')} AS client_name_clean FROM c)
SELECT client_key, client_name_raw, client_name_clean, lower({unaccent('client_name_clean')}) AS client_name_norm,
       {title('client_name_clean')} AS client_name_title
FROM k"""

ORACLE["tax_ids_clean"] = """
WITH c AS (
  SELECT c_custkey AS client_key,
         CASE c_custkey % 4
           WHEN 0 THEN '1-01-' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') || '-' || CAST(c_custkey % 10 AS VARCHAR)
           WHEN 1 THEN '1 01 ' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') || ' ' || CAST(c_custkey % 10 AS VARCHAR)
           WHEN 2 THEN 'RNC ' || lpad(CAST(c_custkey AS VARCHAR), 9, '0')
           ELSE lpad(CAST(c_custkey AS VARCHAR), 5, '0') END AS rnc_raw
  FROM customer),
k AS (SELECT *, regexp_replace(trim(rnc_raw), '[^0-9\\-]', '', 'g') AS kept FROM c)
SELECT client_key, rnc_raw,
       CASE WHEN rnc_raw IS NULL OR trim(rnc_raw) = '' THEN NULL
            WHEN length(regexp_replace(kept, '[^0-9]', '', 'g')) IN (9, 11) THEN kept END AS rnc
FROM k"""

ZONE_CASE = "CASE " + " ".join(f"WHEN {{n}} = {q(a)} THEN {q(z)}" for a, z in ZONE_ALIASES) + " ELSE 'CAP' END"
ORACLE["zone_codes_clean"] = f"""
WITH z AS (
  SELECT c_custkey AS client_key,
         CASE c_custkey % 4 WHEN 0 THEN {pick(DR_ZONES, 'n_regionkey')}
                            WHEN 1 THEN upper({pick(DR_ZONES, 'n_regionkey')})
                            WHEN 2 THEN substr(lower({pick(DR_ZONES, 'n_regionkey')}), 1, 3) END AS zone_raw
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT client_key, zone_raw,
       CASE WHEN zone_raw IS NULL THEN 'CAP' ELSE {ZONE_CASE.replace('{n}', normalize('zone_raw'))} END AS zone_code
FROM z"""

ORACLE["dedup_order_lines"] = """
WITH d AS (
  SELECT 'SAP_HANA' AS source_system, l_orderkey AS invoice_number, l_linenumber AS invoice_line, l_partkey,
         l_suppkey, l_quantity, l_extendedprice, l_discount, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY source_system, invoice_number, invoice_line
                                   ORDER BY ship_date DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC,
                                            l_quantity DESC, l_discount DESC) AS rn FROM d)
SELECT source_system, invoice_number, invoice_line, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
       ship_date FROM r WHERE rn = 1"""

ORACLE["date_validation"] = f"""
WITH d AS (
  SELECT l_orderkey AS invoice_number, l_linenumber AS invoice_line,
         CASE WHEN l_orderkey % 13 = 0 THEN 'not-a-date' WHEN l_linenumber = 7 THEN '2099-01-01'
              WHEN l_orderkey % 29 = 0 THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END AS txt
  FROM lineitem),
p AS (SELECT invoice_number, invoice_line, CAST(try_strptime(txt, '%Y-%m-%d') AS DATE) AS sale_date FROM d)
SELECT invoice_number, invoice_line, sale_date,
       CASE WHEN sale_date IS NOT NULL AND sale_date >= DATE '{DATA_MIN_DATE}' AND sale_date <= DATE '{DATA_AS_OF}'
            THEN NULL ELSE 'invalid_date' END AS rejection_reason
FROM p"""

ORACLE["numeric_validation"] = """
WITH d AS (
  SELECT l_orderkey AS invoice_number, l_linenumber AS invoice_line, l_quantity - 3 AS quantity,
         CASE WHEN l_linenumber = 6 THEN -l_extendedprice / l_quantity ELSE l_extendedprice / l_quantity END
           AS unit_price,
         round(l_extendedprice, 2) AS gross_amount,
         CASE WHEN l_linenumber = 5 THEN -l_extendedprice ELSE l_extendedprice * (1 - l_discount) END AS net0,
         l_discount * 1500 - 20 AS disc0
  FROM lineitem)
SELECT invoice_number, invoice_line, quantity, unit_price, gross_amount,
       CASE WHEN net0 < 0 THEN gross_amount ELSE net0 END AS net_amount,
       least(greatest(disc0, 0), 100) AS discount_pct,
       CASE WHEN quantity <= 0 THEN 'invalid_quantity' WHEN unit_price <= 0 THEN 'invalid_unit_price' END
         AS rejection_reason
FROM d"""
