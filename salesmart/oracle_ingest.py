"""Oracle SQL for the ingest path: parsed workbook rows equal the clean source values."""

from __future__ import annotations

from salesmart.operators.cleanse import CANONICAL_CITIES
from salesmart.oracle_sql import ORACLE, with_sales
from salesmart.sources.grid import BLANK_INVOICE_LINE, BLANK_NET_LINE, CODES, DR_ZONES, GENERIC_DESC_LINE, LINE_ORDER
from salesmart.sources.profiles import PROFILES


def _lit_list(xs) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"


def _case(values: dict[str, str], default: str = "NULL") -> str:
    arms = " ".join(f"WHEN '{c}' THEN {v}" for c, v in values.items())
    return f"CASE code {arms} ELSE {default} END"


FEED_CTE = f""",
fl AS (
  SELECT s.*, distributor_code AS code,
         distributor_code || '_' || strftime(sale_date, '%Y%m%d') || '.xlsx' AS file,
         {_lit_list(CANONICAL_CITIES)}[CAST((client_key % {len(CANONICAL_CITIES)}) + 1 AS INTEGER)] AS city0,
         {_lit_list(DR_ZONES)}[zone_key] AS zone_raw,
         CAST(client_key % 5 AS INTEGER) AS variant,
         ROW_NUMBER() OVER (ORDER BY {", ".join(LINE_ORDER)}) AS line_seq
  FROM sales s WHERE distributor_key > 1),
fl2 AS (
  SELECT *, CASE variant WHEN 0 THEN city0 WHEN 1 THEN upper(city0) WHEN 2 THEN lower(city0)
                 WHEN 3 THEN substr(city0, 1, 1) || substr(city0, 3) ELSE '' END AS city_raw,
            ROUND(unit_price, 2) AS price2
  FROM fl)
"""

PK = "CAST(product_key AS VARCHAR)"
QTY = "CAST(CAST(CAST(quantity AS BIGINT) AS VARCHAR) AS DOUBLE)"
GROSS_B = f"ROUND({QTY} * CAST(price2 AS DOUBLE), 2)"
SELECT = {
    "source_file": "file",
    "sheet": _case({c: (f"'{PROFILES[c].zone_prefix}' || zone_raw" if PROFILES[c].multi_sheet
                        else f"'{PROFILES[c].sheet}'") for c in CODES}),
    "row_num": "CAST(" + _case({c: str(PROFILES[c].header_row) for c in CODES}) + " + 1 + line_seq AS BIGINT)",
    "sale_date": "sale_date",
    "invoice_number": "'F' || CAST(invoice_number AS VARCHAR)",
    "dist_product_code": _case({"DIST_A": f"'RA-' || {PK}", "DIST_B": f"'MF' || lpad({PK}, 6, '0')",
                                "DIST_C": f"'FC' || {PK}", "DIST_D": f"'AF-' || {PK}",
                                "DIST_E": f"'BP' || lpad({PK}, 3, '0') || 'X'", "DIST_F": f"'MD' || {PK}"}),
    "product_name_raw": _case({"DIST_A": "upper(product_name)", "DIST_B": "product_name || ' ' || category",
                               "DIST_C": f"CASE WHEN invoice_line = {GENERIC_DESC_LINE} THEN 'ITEM ' || {PK} "
                                         f"ELSE product_name || ' ' || lower(category) END",
                               "DIST_D": "product_name",
                               "DIST_E": "upper(product_name) || ' ' || lower(category)", "DIST_F": "product_name"}),
    "quantity": QTY,
    "unit_price": "CAST(price2 AS DOUBLE)",
    "discount_pct": _case({"DIST_A": "CAST(CAST(discount_pct AS DECIMAL(5,2)) AS DOUBLE)",
                           "DIST_C": "CAST(CAST(discount_pct AS DECIMAL(5,2)) AS DOUBLE)",
                           "DIST_E": "CAST(CAST(discount_pct AS DECIMAL(5,2)) AS DOUBLE)"}),
    "net_amount": f"CASE WHEN code = 'DIST_B' AND invoice_line = {BLANK_NET_LINE} "
                  f"THEN ROUND({GROSS_B} - ROUND({GROSS_B} * 0.0 / 100, 2), 2) ELSE CAST(net_amount AS DOUBLE) END",
    "gross_amount": f"CASE WHEN code = 'DIST_B' AND invoice_line = {BLANK_NET_LINE} THEN {GROSS_B} END",
    "discount_amount": f"CASE WHEN code = 'DIST_B' AND invoice_line = {BLANK_NET_LINE} "
                       f"THEN ROUND({GROSS_B} * 0.0 / 100, 2) END",
    "client_name_raw": "client_name",
    "city_name_raw": _case({c: ("trim(city_raw)" if c == "DIST_F" else "city_raw") for c in CODES}),
    "zone_code_raw": _case({"DIST_A": "zone_raw", "DIST_D": "zone_raw", "DIST_F": "zone_raw"}),
    "margin_pct_raw": _case({"DIST_F": "CAST(margin_pct AS DOUBLE)"}),
    "distributor_code": "code",
}

FEED_COLUMNS = list(SELECT)

ORACLE["feed_parsed_rows"] = with_sales(FEED_CTE + "SELECT " + ",\n  ".join(
    f"{v} AS {k}" for k, v in SELECT.items()) + f"\nFROM fl2 WHERE invoice_line <> {BLANK_INVOICE_LINE}",
    include_deleted=True)

ORACLE["landing_files"] = with_sales(FEED_CTE + """
SELECT DISTINCT file AS file_name, code AS distributor_code FROM fl2""", include_deleted=True)
