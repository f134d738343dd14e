"""Oracle SQL for quality, integrity, access and merge queries."""

from __future__ import annotations

from salesmart.oracle_sql import MONTHLY_ZONE_BODY, ORACLE, rdiv, with_sales
from salesmart.plans.governance import FKS, QUALITY_AS_OF, RESEND_FROM, SPLIT

CHECKS = [
    ("future_sale_date", f"sale_date > DATE '{QUALITY_AS_OF}'"),
    ("deleted_line", "is_deleted"),
    ("negative_margin", "margin_amount < 0"),
    ("margin_pct_out_of_range", "margin_pct < -100 OR margin_pct > 200"),
    ("zero_discount", "discount_pct = 0"),
    ("quantity_over_45", "quantity > 45"),
]
_parts = " UNION ALL ".join(
    f"SELECT '{n}' AS check_name, COUNT(*) AS checked, COUNT(*) FILTER (WHERE COALESCE({c}, FALSE)) AS failed "
    f"FROM sales" for n, c in CHECKS)
PCT = rdiv("failed * 100", "checked", 3)
ORACLE["quality_log"] = with_sales(f""", q AS ({_parts})
SELECT check_name, checked, failed, {PCT} AS pct_failed,
       CASE WHEN {PCT} > 5 THEN 'HIGH' WHEN {PCT} > 1 THEN 'MEDIUM' ELSE 'LOW' END AS severity FROM q""",
                                   include_deleted=True)

ORACLE["referential_integrity"] = " UNION ALL ".join(
    f"SELECT '{c}.{ck}->{p}.{pk}' AS check_name, COUNT(*) AS rows_checked, "
    f"(SELECT COUNT(*) FROM {c} x WHERE NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{pk} = x.{ck})) AS orphans "
    f"FROM {c}" for c, ck, p, pk in FKS)

ORACLE["open_issues"] = """
SELECT event_id AS run_id, ['SAP_HANA', 'SQL_SERVER', 'DIST_A', 'DIST_B', 'DIST_C', 'DIST_D', 'DIST_E', 'DIST_F']
         [CAST(user_id % 8 AS INTEGER) + 1] AS source_system, ts AS started_at,
       CAST(floor(value * 100) AS BIGINT) AS records_read
FROM events WHERE event_type = 'error'"""

ORACLE["secure_zone_sales"] = with_sales(f""", mz AS ({MONTHLY_ZONE_BODY})
SELECT * FROM mz WHERE zone_code IN (SELECT zone_code FROM zones WHERE zone_key = 2)""")
ORACLE["national_zone_sales"] = with_sales(f""", mz AS ({MONTHLY_ZONE_BODY})
SELECT * REPLACE (CAST(NULL AS DOUBLE) AS total_cost, CAST(NULL AS DOUBLE) AS total_margin,
                  CAST(NULL AS DOUBLE) AS avg_margin_pct) FROM mz""")

_KEY = ["source_system", "source_record_id", "invoice_line"]
_OTHERS = ["sale_date", "invoice_number", "client_key", "product_key", "zone_key", "quantity", "net_amount",
           "is_deleted"]
_UPD = {"quantity", "net_amount", "is_deleted"}


def _dedup(x: str) -> str:
    order = ", ".join(f"{c} DESC" for c in _OTHERS)
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(_KEY)} "
            f"ORDER BY {order}) AS rn FROM {x}) WHERE rn = 1")


_sel = []
for col in _KEY + _OTHERS:
    if col == "net_amount":
        _sel.append(f"CAST(CASE WHEN i.{_KEY[0]} IS NOT NULL THEN i.{col} ELSE c.{col} END AS DOUBLE) AS {col}")
    elif col in _UPD:
        _sel.append(f"CASE WHEN i.{_KEY[0]} IS NOT NULL THEN i.{col} ELSE c.{col} END AS {col}")
    else:
        _sel.append(f"CASE WHEN c.{_KEY[0]} IS NOT NULL THEN c.{col} ELSE i.{col} END AS {col}")
ORACLE["fact_upsert_merge"] = with_sales(f""", rws AS (
  SELECT source_system, source_record_id, invoice_line, sale_date, invoice_number, client_key, product_key, zone_key,
         CAST(quantity AS DOUBLE) AS quantity, net_amount, is_deleted FROM sales),
cur0 AS (SELECT * FROM rws WHERE sale_date < DATE '{SPLIT}'),
inc0 AS (SELECT * REPLACE (CAST(round(net_amount * 1.10, 2) AS DECIMAL(15,2)) AS net_amount, client_key + 1000000 AS client_key)
         FROM rws WHERE sale_date >= DATE '{RESEND_FROM}'),
cur AS ({_dedup('cur0')}),
inc AS ({_dedup('inc0')})
SELECT {', '.join(_sel)}
FROM cur c FULL OUTER JOIN inc i
  ON c.source_system = i.source_system AND c.source_record_id = i.source_record_id
 AND c.invoice_line = i.invoice_line""", include_deleted=True)
