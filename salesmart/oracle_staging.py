"""Oracle SQL for the staged payloads: the cells of every workbook row as text, by header."""

from __future__ import annotations

from salesmart.oracle_ingest import FEED_CTE, PK, SELECT
from salesmart.oracle_sql import ORACLE, with_sales
from salesmart.plans.governance import SPLIT
from salesmart.plans.ingest import AS_OF
from salesmart.sources.grid import BLANK_INVOICE_LINE, BLANK_NET_LINE, CODES
from salesmart.sources.profiles import PROFILES


def _text(x: str, scale: int) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,{scale})) AS VARCHAR)"


def _comma(x: str) -> str:
    return f"translate(format('{{:,.2f}}', CAST({x} AS DOUBLE)), ',.', '.,')"


_ISO, _INV = "strftime(sale_date, '%Y-%m-%d')", f"CASE WHEN invoice_line = {BLANK_INVOICE_LINE} THEN '' ELSE 'F' || invoice_number END"
_QTY, _PRICE, _NET, _DISC = "CAST(CAST(quantity AS BIGINT) AS VARCHAR)", _text("price2", 2), _text("net_amount", 2), _text("discount_pct", 2)
#: Text of a cell by canonical column, where the layouts agree; what they write their own way follows.
_CELL = {"sale_date": _ISO, "invoice_number": _INV, "quantity": _QTY, "unit_price": _PRICE, "net_amount": _NET,
         "discount_pct": _DISC, "discount_pct_raw": f"{_DISC} || '%'", "client_name_raw": "client_name", "city_name_raw": "city_raw",
         "zone_code_raw": "zone_raw", "category_raw": "category", "client_type_raw": "client_type", "lab_code_raw": "lab_name",
         "city_zone_combined": "city_raw || ' / ' || zone_raw",
         "margin_pct_raw": f"replace({_text('margin_pct', 3)}, '.', ',') || '%'",
         "dist_product_code": SELECT["dist_product_code"], "product_name_raw": SELECT["product_name_raw"]}
_OWN = {("DIST_B", "net_amount"): f"CASE WHEN invoice_line = {BLANK_NET_LINE} THEN '' ELSE {_NET} END",
        ("DIST_F", "sale_date"): "strftime(sale_date, '%d/%m/%Y')", ("DIST_F", "unit_price"): _comma("price2"),
        ("DIST_F", "net_amount"): _comma("net_amount"), ("DIST_E", "dist_product_code"): f"'BP' || lpad({PK}, 3, '0') || 'X'"}


def _payload(code: str) -> str:
    cells = [f"'\"{h}\":\"' || ({_OWN.get((code, c), _CELL[c])}) || '\"'" for h, c in PROFILES[code].columns]
    return "'{' || " + " || ',' || ".join(cells) + " || '}'"


ORACLE["staging_payloads"] = with_sales(FEED_CTE + f"""
SELECT code AS distributor_id, file AS file_name, {SELECT['sheet']} AS sheet, {SELECT['row_num']} AS row_num,
       CASE code {" ".join(f"WHEN '{c}' THEN {_payload(c)}" for c in CODES)} END AS raw_data, TIMESTAMP '{AS_OF}' AS extracted_at
FROM fl2 WHERE sale_date >= DATE '{SPLIT}'""", include_deleted=True)
