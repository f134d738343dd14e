"""Oracle SQL for fuzzy matching: every pair is scored, on DuckDB."""

from __future__ import annotations

from salesmart.operators.cleanse import CANONICAL_CITIES
from salesmart.operators.matching import SUGGEST_FROM
from salesmart.oracle_cleansing import normalize
from salesmart.oracle_ingest import _lit_list
from salesmart.oracle_sql import ORACLE
from salesmart.plans.ingest import AS_OF
from salesmart.sources import reference_data as rd
from salesmart.sources.grid import CODES


def lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence of two strings of at most 62 characters (bit-parallel)."""
    bits = f"((CAST(1 AS BIGINT) << length({a})) - 1)"
    mask = (f"CAST(coalesce(list_sum(list_transform(range(1, length({a}) + 1), lambda i: CASE WHEN substr({a}, i, 1) = ch "
            f"THEN CAST(1 AS BIGINT) << CAST(i - 1 AS INTEGER) ELSE 0 END)), 0) AS BIGINT)")
    steps = f"list_prepend({bits}, list_transform(string_split({b}, ''), lambda ch: {mask}))"
    return f"(length({a}) - bit_count(list_reduce({steps}, lambda v, m: ((v + (v & m)) | (v & ~m)) & {bits})))"


def tokens(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '\\s+'), lambda x: x <> '')"


def token_set_pairs(queries: str, candidates: str) -> str:
    """CTEs ending in ``scored`` (g, q, t, pos, score): token-set similarity of all pairs of a group."""
    return f"""
qs AS (SELECT g, q, list_sort(list_distinct({tokens('q')})) AS a FROM ({queries})),
cs AS (SELECT g, t, pos, list_sort(list_distinct({tokens('t')})) AS b FROM ({candidates})),
parts AS (
  SELECT g, q, t, pos, a, b, array_to_string(list_filter(a, lambda x: NOT list_contains(b, x)), ' ') AS oa,
         array_to_string(list_filter(b, lambda x: NOT list_contains(a, x)), ' ') AS ob,
         array_to_string(list_filter(a, lambda x: list_contains(b, x)), ' ') AS sh
  FROM qs JOIN cs USING (g) WHERE len(a) > 0 AND len(b) > 0),
lens AS (
  SELECT *, CASE WHEN sh = '' THEN 0 ELSE 1 END AS gap, length(oa) + length(ob) - 2 * {lcs('oa', 'ob')} AS apart FROM parts),
scored AS (
  SELECT g, q, t, pos, CASE WHEN sh <> '' AND (oa = '' OR ob = '') THEN CAST(100 AS DOUBLE)
           WHEN sh = '' THEN CAST(100 AS DOUBLE) * (1 - apart / (length(oa) + length(ob)))
           ELSE greatest(CAST(100 AS DOUBLE) * (1 - apart / (2 * (length(sh) + gap) + length(oa) + length(ob))),
                         CAST(100 AS DOUBLE) * (1 - (gap + length(oa)) / (2 * length(sh) + gap + length(oa))),
                         CAST(100 AS DOUBLE) * (1 - (gap + length(ob)) / (2 * length(sh) + gap + length(ob)))) END AS score
  FROM lens),
best AS (SELECT g, q, arg_min(t, (-score, pos)) AS t, arg_min(pos, (-score, pos)) AS pos, max(score) AS score
         FROM scored GROUP BY g, q)"""


_PK = "CAST(p_partkey AS VARCHAR)"
_CODE = {"DIST_A": f"'RA-' || {_PK}", "DIST_B": f"'MF' || lpad({_PK}, 6, '0')", "DIST_C": f"'FC' || {_PK}",
         "DIST_D": f"'AF-' || {_PK}", "DIST_E": f"'BP' || lpad({_PK}, 2, '0') || 'X'", "DIST_F": f"'MD' || {_PK}"}
_DESC = {"DIST_A": "upper(p_name)", "DIST_B": "p_name || ' ' || p_type", "DIST_C": "p_name || ' ' || lower(p_type)",
         "DIST_D": "p_name", "DIST_E": "upper(p_name) || ' ' || lower(p_type)", "DIST_F": "p_name"}
MAPPING = " UNION ALL ".join(
    f"SELECT '{c}' AS g, {_CODE[c]} AS code, {_DESC[c]} AS t, p_partkey AS id, p_name AS name, "
    f"{i} * CAST(1099511627776 AS BIGINT) + p_partkey AS pos FROM part WHERE (p_partkey + {i}) % 11 <> 0"
    for i, c in enumerate(CODES, start=1))

#: CTEs ending in ``mapped``: the parsed feed with exact and fuzzy matches.
MAPPED = f"""
feed AS ({ORACLE['feed_parsed_rows']}),
mapping AS ({MAPPING}),
exact AS (SELECT g, trim(code) AS code, arg_max(id, pos) AS id, arg_max(name, pos) AS name FROM mapping GROUP BY ALL),
cand AS (SELECT g, t, min(pos) AS pos, arg_min(id, pos) AS id, arg_min(name, pos) AS name FROM mapping GROUP BY g, t),
f AS (SELECT feed.*, distributor_code AS g, trim(dist_product_code) AS code, trim(product_name_raw) AS q, e.id AS ex, e.name AS ex_name
      FROM feed LEFT JOIN exact e ON e.g = distributor_code AND e.code = trim(dist_product_code)),
{token_set_pairs("SELECT DISTINCT g, q FROM f WHERE ex IS NULL AND length(q) > 3", "SELECT g, t, pos FROM cand")},
hits AS (SELECT best.g, best.q, score, id, name FROM best JOIN cand ON cand.g = best.g AND cand.pos = best.pos WHERE score >= 70),
mapped AS (
  SELECT f.*, coalesce(ex, h.id) AS sap_product_id,
         CASE WHEN ex IS NOT NULL THEN ex_name WHEN h.id IS NOT NULL THEN h.name ELSE product_name_raw END AS sap_product_name,
         CASE WHEN ex IS NOT NULL THEN 1 WHEN h.id IS NOT NULL THEN score / 100 ELSE 0 END AS mapping_confidence,
         ex IS NOT NULL AS mapping_exact
  FROM f LEFT JOIN hits h ON h.g = f.g AND h.q = f.q AND ex IS NULL)"""

ORACLE["product_code_mapping"] = f"""
WITH {MAPPED}
SELECT distributor_code, source_file, row_num, dist_product_code, product_name_raw, CAST(sap_product_id AS VARCHAR) AS sap_product_id,
       sap_product_name, mapping_confidence, mapping_exact FROM mapped"""

ORACLE["unmapped_products"] = f"""
WITH {MAPPED},
u AS (SELECT g AS source_system, g AS distributor_code, code AS dist_product_code, q AS product_description,
             COUNT(*) AS occurrence_count, TIMESTAMP '{AS_OF}' AS first_seen
      FROM mapped WHERE sap_product_id IS NULL GROUP BY g, code, q),
near AS (SELECT best.g, best.q, name, score FROM best JOIN cand ON cand.g = best.g AND cand.pos = best.pos
         WHERE score >= {SUGGEST_FROM})
SELECT u.*, name AS suggested_match, round(score / 100, 3) AS similarity_score
FROM u LEFT JOIN near ON near.g = u.distributor_code AND near.q = u.product_description"""

ORACLE["feed_quality_counters"] = f"""
WITH {MAPPED}
SELECT distributor_code, COUNT(*) AS rows, CAST(0 AS BIGINT) AS invalid_quantity, CAST(0 AS BIGINT) AS invalid_price,
       CAST(0 AS BIGINT) AS invalid_amounts, CAST(0 AS BIGINT) AS invalid_dates,
       round(COUNT(sap_product_id) * CAST(100 AS DOUBLE) / COUNT(*), 1) AS mapped_pct
FROM mapped GROUP BY distributor_code"""

ORACLE["product_name_cleansing"] = f"""
WITH feed AS ({ORACLE['feed_parsed_rows']}),
raw AS (SELECT DISTINCT product_name_raw, {normalize('product_name_raw')} AS q FROM feed),
cat AS (SELECT t, min(id) AS pos, arg_max(id, id) AS id, arg_max(name, id) AS name
        FROM (SELECT {normalize('p_name')} AS t, p_partkey AS id, p_name AS name FROM part) GROUP BY t),
{token_set_pairs("SELECT DISTINCT 0 AS g, q FROM raw WHERE trim(product_name_raw) <> '' AND q NOT IN (SELECT t FROM cat)",
                 "SELECT 0 AS g, t, pos FROM cat")},
hits AS (SELECT q, score, id, name FROM best JOIN cat ON cat.pos = best.pos WHERE score >= {rd.PRODUCT_FUZZY_THRESHOLD})
SELECT product_name_raw,
       CASE WHEN trim(product_name_raw) = '' THEN product_name_raw ELSE coalesce(e.name, h.name, product_name_raw) END AS product_name_clean,
       CAST(CASE WHEN trim(product_name_raw) = '' THEN 0 WHEN e.id IS NOT NULL THEN 1 WHEN h.id IS NOT NULL THEN score / 100 ELSE 0 END
            AS DOUBLE) AS product_match_confidence,
       CAST(CASE WHEN trim(product_name_raw) <> '' THEN coalesce(e.id, h.id) END AS VARCHAR) AS matched_product_id
FROM raw LEFT JOIN cat e ON e.t = raw.q LEFT JOIN hits h ON h.q = raw.q"""

_SORTED = "array_to_string(list_sort({}), ' ')"
_CITIES = ", ".join(f"({i}, '{c}', {_SORTED.format(tokens(normalize(repr(c))))})" for i, c in enumerate(CANONICAL_CITIES))
_ALIASES = ", ".join(f"({i}, {normalize(repr(a))}, '{c}')" for i, (a, c) in enumerate(rd.CITY_ALIASES))
_VARIANT = "CASE k % 5 WHEN 0 THEN city WHEN 1 THEN upper(city) WHEN 2 THEN lower(city) " \
           "WHEN 3 THEN substr(city, 1, 1) || substr(city, 3) ELSE '' END"
_ZONES = " ".join(f"WHEN '{c}' THEN '{z}'" for c, z in rd.CITY_ZONE)


def clean_cities(raw: str) -> str:
    """CTEs ending in ``cities`` (raw, city, conf): the canonical city of each distinct spelling in ``raw`` (raw)."""
    return f"""
city_list(i, name, words) AS (VALUES {_CITIES}),
aliases(i, alias, name) AS (VALUES {_ALIASES}),
spelled AS (SELECT DISTINCT raw, {normalize('raw')} AS cn, coalesce(trim(raw), '') = '' AS blank FROM ({raw})),
found AS (SELECT raw, cn, blank,
                 (SELECT arg_min(name, i) FROM aliases WHERE alias = cn) AS ex,
                 (SELECT arg_min(name, i) FROM aliases WHERE contains(cn, alias) OR contains(alias, cn)) AS part,
                 {_SORTED.format(tokens('cn'))} AS words FROM spelled),
near AS (SELECT raw, arg_min(name, (-score, i)) AS name, max(score) AS score
         FROM (SELECT raw, name, i, CAST(100 AS DOUBLE) * (1 - (length(f.words) + length(c.words) - 2 * {lcs('f.words', 'c.words')})
                                                       / (length(f.words) + length(c.words))) AS score
               FROM found f, city_list c WHERE NOT blank AND ex IS NULL AND part IS NULL)
         WHERE score >= {rd.CITY_FUZZY_THRESHOLD} GROUP BY raw),
cities AS (
  SELECT f.raw, CASE WHEN blank THEN '{rd.DEFAULT_CITY}' ELSE coalesce(ex, part, n.name, '{rd.DEFAULT_CITY}') END AS city,
         CAST(CASE WHEN blank THEN {rd.CITY_CONF_BLANK} WHEN ex IS NOT NULL THEN {rd.CITY_CONF_EXACT}
                   WHEN part IS NOT NULL THEN {rd.CITY_CONF_SUBSTRING} WHEN n.name IS NOT NULL THEN n.score / 100
                   ELSE {rd.CITY_CONF_UNKNOWN} END AS DOUBLE) AS conf
  FROM found f LEFT JOIN near n ON n.raw = f.raw)"""


ORACLE["city_cleansing"] = f"""
WITH c0 AS (SELECT c_custkey AS client_key, c_custkey AS k,
                   {_lit_list(CANONICAL_CITIES)}[CAST(c_custkey % {len(CANONICAL_CITIES)} + 1 AS INTEGER)] AS city FROM customer),
c AS (SELECT client_key, {_VARIANT} AS city_raw FROM c0),
{clean_cities("SELECT city_raw AS raw FROM c")}
SELECT client_key, city_raw, city AS city_name_clean, conf AS city_match_confidence,
       coalesce(CASE city {_ZONES} END, '{rd.DEFAULT_ZONE_CODE}') AS zone_code
FROM c JOIN cities ON raw = city_raw"""

# ----------------------------------------------------------------------------- validation queue

from salesmart.plans import validation as v  # noqa: E402

_ID = "CAST('0x' || substr(md5(entry_type || '|' || coalesce(distributor_code, '') || '|' || coalesce(raw_value, '')), 1, 15) AS BIGINT)"
QUEUE = f"""
{MAPPED},
{clean_cities("SELECT city_name_raw AS raw FROM feed")},
entries AS (
  SELECT '{v.CITY}' AS entry_type, city_name_raw AS raw_value, any_value(city) AS suggested_value, any_value(conf) AS conf,
         distributor_code, min(source_file) AS source_file
  FROM feed JOIN cities ON cities.raw IS NOT DISTINCT FROM city_name_raw WHERE conf < 1 GROUP BY distributor_code, city_name_raw
  UNION ALL
  SELECT '{v.PRODUCT}', product_name_raw, any_value(sap_product_name), any_value(mapping_confidence), distributor_code, min(source_file)
  FROM mapped WHERE NOT mapping_exact GROUP BY distributor_code, product_name_raw),
queue AS (
  SELECT {_ID} AS queue_id, entry_type, raw_value, suggested_value, round(conf * 100, 1) AS confidence_pct,
         distributor_code AS source_distributor, source_file, TIMESTAMP '{AS_OF}' AS created_at FROM entries),
state AS (
  SELECT *, CASE queue_id % 3 WHEN 0 THEN '{v.APPROVED}' WHEN 1 THEN '{v.REJECTED}' ELSE '{v.PENDING}' END AS status,
         CASE WHEN queue_id % 3 < 2 THEN TIMESTAMP '{AS_OF}' END AS resolved_at,
         CASE WHEN queue_id % 3 < 2 THEN '{v.REVIEWER}' END AS resolved_by FROM queue)"""

ORACLE["validation_status_counts"] = f"WITH {QUEUE} SELECT status, COUNT(*) AS entries FROM state GROUP BY status"
ORACLE["validation_by_distributor"] = f"""
WITH {QUEUE} SELECT source_distributor, status, COUNT(*) AS entries FROM state GROUP BY ALL"""
ORACLE["validation_approval_rate"] = f"""
WITH {QUEUE}
SELECT round(COUNT(*) FILTER (status = '{v.APPROVED}') * CAST(100 AS DOUBLE) / nullif(COUNT(*), 0), 1) AS approval_rate_pct,
       COUNT(*) AS resolved FROM state WHERE status <> '{v.PENDING}'"""
ORACLE["validation_pending"] = f"""
WITH {QUEUE}
SELECT queue_id, entry_type, raw_value, suggested_value, confidence_pct,
       CASE WHEN confidence_pct >= {v.HIGH} THEN 'ALTA' WHEN confidence_pct >= {v.MEDIUM} THEN 'MEDIA' ELSE 'BAJA' END AS confidence_band,
       source_distributor, source_file, created_at
FROM state WHERE status = '{v.PENDING}'"""
ORACLE["validation_history"] = f"""
WITH {QUEUE}
SELECT entry_type, raw_value, suggested_value, confidence_pct, source_distributor, status, resolved_at, resolved_by
FROM state WHERE status <> '{v.PENDING}'"""

# ----------------------------------------------------------------------------- key resolution

from salesmart.operators.resolve import ZONES  # noqa: E402
from salesmart.oracle_cleansing import client_clean  # noqa: E402
from salesmart.plans.cleansing_queries import DATA_AS_OF, DATA_MIN_DATE  # noqa: E402
from salesmart.plans.governance import RESOLVED_AS_OF  # noqa: E402

_ZONE_KEY = {code: key for key, code, _ in ZONES}
_CITY_KEYS = ", ".join(f"('{c}', {i + 1}, {_ZONE_KEY[dict(rd.CITY_ZONE)[c]]})" for i, c in enumerate(CANONICAL_CITIES))
_SELLERS = " ".join(f"WHEN '{c}' THEN {k}" for k, c, *_ in rd.DISTRIBUTORS)

ORACLE["resolved_feed_facts"] = f"""
WITH {MAPPED},
{clean_cities("SELECT city_name_raw AS raw FROM feed")},
city_keys(name, city_key, zone_key) AS (VALUES {_CITY_KEYS}),
named AS (SELECT c_name AS name, min(c_custkey) AS client_key FROM customer GROUP BY c_name),
raw_names AS (SELECT raw, {client_clean('raw')} AS clean FROM (SELECT DISTINCT client_name_raw AS raw FROM feed)),
numbered AS (SELECT *, g AS source_system, CAST(row_number() OVER (PARTITION BY source_file, invoice_number ORDER BY sheet, row_num)
                                               AS INTEGER) AS invoice_line FROM mapped),
valid AS (SELECT * FROM numbered WHERE sale_date BETWEEN DATE '{DATA_MIN_DATE}' AND DATE '{DATA_AS_OF}'
          AND coalesce(quantity > 0, TRUE) AND coalesce(unit_price > 0, TRUE)),
kept AS (SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY source_system, invoice_number, invoice_line
                                                        ORDER BY source_file DESC, row_num DESC) = 1),
net AS (SELECT *, CASE WHEN net_amount < 0 THEN gross_amount ELSE net_amount END AS net FROM kept)
SELECT CAST(strftime(sale_date, '%Y%m%d') AS INTEGER) AS date_key, coalesce(p_partkey, 0) AS product_key,
       coalesce(named.client_key, 0) AS client_key, city_key, zone_key,
       CASE g {_SELLERS} END AS distributor_key,
       coalesce(CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER), 0) AS laboratory_key, 0 AS salesperson_key,
       invoice_number, invoice_line, quantity, unit_price, coalesce(gross_amount, net) AS gross_amount,
       CAST(coalesce(least(greatest(discount_pct, 0), 100), 0) AS DOUBLE) AS discount_pct,
       CAST(coalesce(discount_amount, 0) AS DOUBLE) AS discount_amount, net AS net_amount,
       CAST(NULL AS DOUBLE) AS cost_amount, CAST(NULL AS DOUBLE) AS margin_amount, CAST(NULL AS DOUBLE) AS margin_pct,
       source_system, invoice_number || '-' || invoice_line AS source_record_id, TIMESTAMP '{RESOLVED_AS_OF}' AS load_timestamp,
       FALSE AS is_deleted,
       CASE WHEN p_partkey IS NULL THEN 'product,' ELSE '' END || CASE WHEN named.client_key IS NULL THEN 'client,' ELSE '' END
         || 'salesperson' AS unresolved_keys
FROM net JOIN cities ON cities.raw IS NOT DISTINCT FROM city_name_raw JOIN city_keys ON city_keys.name = cities.city
LEFT JOIN part ON p_partkey = sap_product_id
LEFT JOIN raw_names ON raw_names.raw = client_name_raw LEFT JOIN named ON named.name = raw_names.clean"""
