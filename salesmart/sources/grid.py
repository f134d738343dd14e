"""Distributor workbooks as a raw-grid table, and their parsing (A-6 ... A-8, C-1 ... C-10).

Raw grid: ``file STRING, sheet STRING, row_num BIGINT, cells ARRAY<STRING>`` -
one row per spreadsheet row, all cells as text. Decoding the workbook bytes is
the job of whatever lands the files; everything after that is here, as one
distributed plan for *all* files of a layout at once:

* the header row of every (file, sheet) is found by row index and joined to
  that sheet's data rows; each canonical column is picked by the position
  of its header text (``array_position``), so files whose columns are in a
  different order parse correctly;
* multi-sheet layouts read every sheet with the prefix and tag rows with the
  rest of the sheet name;
* then the cleaning of the layout: empty rows, blank invoices, date layouts,
  locale numbers, percent strings, "city / zone" cells.

``derive_grids`` builds such a grid from the order tables (one workbook per
distributor and day), which is how the ingest path is exercised on the
test data.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.operators.cleanse import CANONICAL_CITIES, parse_date
from salesmart.operators.ranking import running_total
from salesmart.session import checkpoint_dir, materialize, release_shuffles
from salesmart.sources import star
from salesmart.sources.profiles import NUMERIC_COLUMNS, PERCENT_COLUMNS, PROFILES, Profile
from salesmart.sources.tables import Source

GRID_SCHEMA = "file string, sheet string, row_num bigint, cells array<string>"
GRID_COLUMNS = ["file", "sheet", "row_num", "cells", "distributor"]
CODES = ["DIST_A", "DIST_B", "DIST_C", "DIST_D", "DIST_E", "DIST_F"]
# FIXED VALUES: zone names used in the workbooks (zone key 1..5).
DR_ZONES = ["Capital", "Norte", "Este", "Sur", "Oeste"]
BLANK_INVOICE_LINE = 7      # lines with this number arrive with an empty invoice cell
BLANK_NET_LINE = 6          # DIST_B leaves the amount empty on these lines
GENERIC_DESC_LINE = 5       # DIST_C sends a generic description on these lines
EMPTY_ROW = 1 << 40         # row index of the trailing empty row of each sheet
LINE_ORDER = ["invoice_number", "invoice_line", "product_key", "supplier_key", "quantity", "gross_amount",
              "discount_pct"]


# --------------------------------------------------------------------------- parsing

def _sheets(grid: DataFrame, profile: Profile) -> DataFrame:
    """The grid rows of the sheets of one layout."""
    g = (grid.filter(F.col("distributor") == profile.code) if "distributor" in grid.columns
         else grid.filter(F.col("file").startswith(profile.code + "_")))
    return g.filter(F.col("sheet").startswith(profile.zone_prefix) if profile.multi_sheet else F.col("sheet") == profile.sheet)


def _headers(grid: DataFrame, profile: Profile) -> DataFrame:
    """file, sheet, _h: the trimmed header row of every sheet of one layout."""
    return (_sheets(grid, profile).filter(F.col("row_num") == profile.header_row)
            .select("file", "sheet", F.transform("cells", lambda c: F.trim(c)).alias("_h")))


def read_profile(grid: DataFrame, profile: Profile, as_of: datetime | None = None,
                 headers: DataFrame | None = None) -> DataFrame:
    """Parse the grid rows of one layout into canonical columns."""
    g = _sheets(grid, profile)
    hdr = _headers(grid, profile) if headers is None else headers
    # where each column stands, found once for a sheet and not again for each of its rows
    hdr = hdr.select("file", "sheet", *[F.array_position("_h", F.lit(h)).cast("int").alias(f"_at_{c}") for h, c in profile.columns])
    rows = g.filter(F.col("row_num") > profile.header_row)
    # C-2: rows whose cells are all empty
    rows = rows.filter(F.exists("cells", lambda c: c.isNotNull()))
    d = rows.join(hdr, ["file", "sheet"])

    def cell(name: str) -> Column:
        pos = F.col(f"_at_{name}")
        return F.when(pos > 0, F.try_element_at(F.col("cells"), pos))

    out = d.select("file", "sheet", "row_num",
                   *[cell(c).alias(c) for _, c in profile.columns])
    cols = [c for _, c in profile.columns]
    # C-3: blank invoice numbers
    if "invoice_number" in cols:
        out = out.filter(F.col("invoice_number").isNotNull() & (F.trim("invoice_number") != ""))
    # C-4: dates
    if "sale_date" in cols:
        out = out.withColumn("sale_date", parse_date(F.col("sale_date"), profile.date_fmt))
    # C-5: locale numbers
    for c in NUMERIC_COLUMNS:
        if c in cols:
            out = out.withColumn(c, parse_number(F.col(c), profile.decimal_sep))
    # C-6: percent strings, missing -> 0
    for c in PERCENT_COLUMNS:
        if c in cols:
            out = out.withColumn(c, F.coalesce(parse_percent(F.col(c).cast("string")), F.lit(0.0)))
    if "discount_pct_raw" in cols:
        out = out.withColumnRenamed("discount_pct_raw", "discount_pct")
    # C-7: "city / zone"
    if profile.city_zone_combined and "city_zone_combined" in cols:
        parts = F.split(F.col("city_zone_combined"), profile.city_zone_sep, 2)
        out = (out.withColumn("city_name_raw", F.trim(F.try_element_at(parts, F.lit(1))))
                  .withColumn("zone_code_raw", F.trim(F.try_element_at(parts, F.lit(2))))
                  .drop("city_zone_combined"))
    # C-8: zone from the sheet name
    if profile.multi_sheet and "zone_code_raw" not in out.columns:
        out = out.withColumn("zone_code_raw", F.substr(F.col("sheet"), F.lit(len(profile.zone_prefix) + 1)))
    # C-9: provenance
    out = (out.withColumn("distributor_code", F.lit(profile.code))
              .withColumn("source_system", F.lit(profile.code))
              .withColumnRenamed("file", "source_file")
              .withColumn("extracted_at", F.lit(as_of) if as_of else F.current_timestamp()))
    # C-10: gross / discount / net where the net amount is missing (row level)
    if {"quantity", "unit_price"} <= set(out.columns):
        disc = F.coalesce(F.col("discount_pct"), F.lit(0.0)) if "discount_pct" in out.columns else F.lit(0.0)
        gross = F.round(F.col("quantity") * F.col("unit_price"), 2)
        missing = F.col("net_amount").isNull() if "net_amount" in out.columns else F.lit(True)
        out = out.withColumn("gross_amount", F.when(missing, gross))
        out = out.withColumn("discount_amount", F.when(missing, F.round(F.col("gross_amount") * disc / 100, 2)))
        net = F.round(F.col("gross_amount") - F.col("discount_amount"), 2)
        out = out.withColumn("net_amount", F.coalesce(F.col("net_amount"), net) if "net_amount" in out.columns
                             else net)
    return out


#: Columns without which no row of a file can be loaded.
NEEDED_COLUMNS = ("sale_date", "invoice_number", "dist_product_code", "quantity")


def _of_layout(value) -> Column:
    """A property of the layout that the row's file name tells, NULL if there is no such layout."""
    code = F.regexp_extract("file", r"^(DIST_[A-Z])_", 1)
    return F.coalesce(*[F.when(code == c, value(p)) for c, p in PROFILES.items()])


def layout() -> tuple[Column, Column, Column]:
    """Code, whether the row's sheet is one of the layout, header row: of a grid row by its file name."""
    in_sheet = _of_layout(lambda p: F.col("sheet").startswith(p.zone_prefix) if p.multi_sheet else F.col("sheet") == p.sheet)
    return F.regexp_extract("file", r"^(DIST_[A-Z])_", 1), in_sheet, _of_layout(lambda p: F.lit(p.header_row))


def file_status(grid: DataFrame) -> DataFrame:
    """file, distributor_code, reason: why a landed workbook cannot be read, or NULL (B-10).

    One aggregate over the whole batch, so every file is judged on its own before anything is written:
    unknown layout, rows without cells, no sheet of the layout, no header row, missing columns, no data rows.
    """
    code, in_sheet, header_row = layout()
    needed = _of_layout(lambda p: F.array(*[F.lit(h) for h, c in p.columns if c in NEEDED_COLUMNS]))
    header = F.when(in_sheet & (F.col("row_num") == header_row), F.transform("cells", lambda c: F.trim(c)))
    data = in_sheet & (F.col("row_num") > header_row) & F.exists("cells", lambda c: c.isNotNull())
    sheets = grid.groupBy("file", code.alias("distributor_code"), "sheet").agg(
        F.bool_or(F.coalesce(in_sheet, F.lit(False))).alias("used"), F.max(header).alias("header"),
        F.max(needed).alias("needed"), F.count_if(F.coalesce(data, F.lit(False))).alias("rows"),
        F.count_if(F.col("cells").isNull()).alias("broken"))
    missing = F.when(F.col("used"), F.array_except("needed", F.coalesce("header", F.array().cast("array<string>"))))
    files = sheets.groupBy("file", "distributor_code").agg(
        F.max("needed").alias("needed"), F.bool_or("used").alias("used"), F.sum("rows").alias("rows"),
        F.sum("broken").alias("broken"), F.bool_or(F.col("used") & F.col("header").isNull()).alias("headless"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(missing)))).alias("missing"))
    reason = (F.when(F.col("needed").isNull(), F.lit("unknown layout"))
              .when(F.col("broken") > 0, F.lit("rows without cells"))
              .when(~F.col("used"), F.lit("no sheet of the layout"))
              .when(F.col("headless"), F.lit("no header row"))
              .when(F.size("missing") > 0, F.concat(F.lit("missing columns: "), F.array_join("missing", ", ")))
              .when(F.col("rows") == 0, F.lit("no data rows")))
    return files.select("file", "distributor_code", reason.alias("reason"))


def parse_number(c: Column, decimal_sep: str) -> Column:
    """Text -> DOUBLE; with a decimal comma: drop '.', ',' -> '.', strip the rest."""
    s = c.cast("string")
    if decimal_sep == ",":
        s = F.regexp_replace(F.replace(F.regexp_replace(s, r"\.", ""), F.lit(","), F.lit(".")), r"[^\d.\-]", "")
    return F.trim(s).try_cast("double")


def parse_percent(c: Column) -> Column:
    return F.trim(F.replace(F.replace(c, F.lit("%"), F.lit("")), F.lit(","), F.lit("."))).try_cast("double")


def read_all_profiles(grid: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """All six layouts parsed and unioned by column name (H-1)."""
    # the header rows as a table of known size: the data rows are then shuffled only if that is too large to send
    headers = None
    for code in CODES:
        h = _headers(grid, PROFILES[code]).withColumn("_code", F.lit(code))
        headers = h if headers is None else headers.unionByName(h)
    headers = materialize(headers, "grid-headers")
    out = None
    for code in CODES:
        df = read_profile(grid, PROFILES[code], as_of, headers.filter(F.col("_code") == code).drop("_code"))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def discover_files(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """Landing-zone discovery (A-8): workbook files named ``DIST_X_*`` -> (code, file).

    ``paths`` is any listing of file paths (e.g. ``spark.read.format("binaryFile")``
    with ``pathGlobFilter``, or ``_metadata.file_path`` of a scan).
    """
    name = F.regexp_extract(F.col(path_col), r"([^/]+)$", 1)
    code = F.regexp_extract(name, r"^(DIST_[A-Z])_", 1)
    return (paths.select(F.col(path_col).alias("path"), name.alias("file_name"), code.alias("distributor_code"))
            .filter((F.col("distributor_code") != "") & F.lower("file_name").rlike(r"\.xlsx?$")))


# --------------------------------------------------------------------------- derivation from the tables

def fmt_comma(x: Column) -> Column:
    """1234.5 -> '1.234,50' (thousands dot, decimal comma)."""
    return F.translate(F.format_number(x, 2), ",.", ".,")


def dirty_city(client_key: Column) -> Column:
    """A canonical city picked by client, spelled one of five ways (as-is, upper, lower, typo, blank)."""
    city = F.element_at(F.array(*[F.lit(x) for x in CANONICAL_CITIES]),
                        (F.pmod(client_key, F.lit(len(CANONICAL_CITIES))) + 1).cast("int"))
    variant = F.pmod(client_key, F.lit(5))
    return (F.when(variant == 0, city).when(variant == 1, F.upper(city)).when(variant == 2, F.lower(city))
            .when(variant == 3, F.concat(F.substring(city, 1, 1), F.substr(city, F.lit(3))))
            .otherwise(F.lit("")))


def _numbered(lines: DataFrame) -> DataFrame:
    """``line_seq``: the global row number over a total order of the lines (invoice, line first).

    Only the invoices and their line counts are sorted and summed up; a line's number is the lines of the invoices
    before plus its place in its own invoice (a plain window: its partitions are the lines of one invoice).
    """
    counts = lines.groupBy("invoice_number").agg(F.count(F.lit(1)).alias("_n"))
    upto = running_total(counts, "_n", [("invoice_number", False)], out="_upto")
    place = F.row_number().over(Window.partitionBy("invoice_number").orderBy(
        *[F.col("discount" if c == "discount_pct" else c).asc_nulls_first() for c in LINE_ORDER[1:]]))
    return (lines.join(upto, "invoice_number")
            .withColumn("line_seq", F.col("_upto") - F.col("_n") + place).drop("_upto", "_n"))


def feed_lines(src: Source) -> DataFrame:
    """External-distributor order lines with everything a workbook row shows."""
    # numbered before the derived columns are there: rows of an invoice are in line order, no two share a position
    f = star.rows(src, include_deleted=True).filter(star.distributor_key(F.col("supplier_key")) > 1)
    f = star.described(_numbered(f))
    zone = F.element_at(F.array(*[F.lit(z) for z in DR_ZONES]), F.col("zone_key"))
    return f.select(
        "*", F.col("distributor_code").alias("code"),
        F.concat(F.col("distributor_code"), F.lit("_"), F.date_format("sale_date", "yyyyMMdd"), F.lit(".xlsx"))
        .alias("file"),
        dirty_city(F.col("client_key")).alias("city_raw"), zone.alias("zone_raw"))


def _cells(code: str) -> list[Column]:
    """Formatted cells of one data row, in the layout's column order."""
    inv = F.when(F.col("invoice_line") == BLANK_INVOICE_LINE, F.lit("")) \
        .otherwise(F.concat(F.lit("F"), F.col("invoice_number").cast("string")))
    qty = F.col("quantity").cast("bigint").cast("string")
    price = F.col("unit_price").cast("decimal(16,2)")
    net = F.col("net_amount")
    disc = F.col("discount_pct").cast("decimal(5,2)").cast("string")
    pk = F.col("product_key").cast("string")
    name, typ = F.col("product_name"), F.col("category")
    iso = F.date_format("sale_date", "yyyy-MM-dd")
    by_header = {
        "DIST_A": [iso, inv, F.concat(F.lit("RA-"), pk), F.upper(name), qty, price.cast("string"), disc,
                   net.cast("string"), F.col("client_name"), F.col("city_raw"), F.col("zone_raw")],
        "DIST_B": [iso, inv, F.concat(F.lit("MF"), F.lpad(pk, 6, "0")), F.concat_ws(" ", name, typ),
                   F.col("client_name"), qty, price.cast("string"),
                   F.when(F.col("invoice_line") == BLANK_NET_LINE, F.lit("")).otherwise(net.cast("string")),
                   F.col("city_raw")],
        "DIST_C": [iso, inv, F.concat(F.lit("FC"), pk),
                   F.when(F.col("invoice_line") == GENERIC_DESC_LINE, F.concat(F.lit("ITEM "), pk))
                   .otherwise(F.concat_ws(" ", name, F.lower(typ))), qty,
                   price.cast("string"), net.cast("string"), F.col("client_name"), F.col("city_raw"),
                   F.concat(disc, F.lit("%"))],
        "DIST_D": [iso, inv, F.concat(F.lit("AF-"), pk), name, typ, F.col("client_name"), F.col("client_type"),
                   F.col("city_raw"), qty, price.cast("string"), net.cast("string")],
        "DIST_E": [iso, inv, F.concat(F.lit("BP"), F.lpad(pk, 3, "0"), F.lit("X")),
                   F.concat_ws(" ", F.upper(name), F.lower(typ)), qty, price.cast("string"), disc,
                   net.cast("string"), F.col("client_name"), F.col("city_raw"), F.col("lab_name"), typ],
        "DIST_F": [F.date_format("sale_date", "dd/MM/yyyy"), inv, F.concat(F.lit("MD"), pk), name,
                   F.col("client_name"), F.concat_ws(" / ", F.col("city_raw"), F.col("zone_raw")), qty,
                   fmt_comma(price), fmt_comma(net),
                   F.concat(F.translate(F.col("margin_pct").cast("string"), ".", ","), F.lit("%"))],
    }
    return by_header[code]


def _by_code(values: dict[str, Column]) -> Column:
    out = None
    for code, v in values.items():
        out = F.when(F.col("code") == code, v) if out is None else out.when(F.col("code") == code, v)
    return out


def _grid_data(lines: DataFrame) -> DataFrame:
    """Data rows of every workbook: one pass over the feed's lines, layout chosen per distributor."""
    sheet = _by_code({c: (F.concat(F.lit(PROFILES[c].zone_prefix), F.col("zone_raw")) if PROFILES[c].multi_sheet
                          else F.lit(PROFILES[c].sheet)) for c in CODES})
    header_row = _by_code({c: F.lit(PROFILES[c].header_row) for c in CODES})
    return lines.select("file", sheet.alias("sheet"),
                        (header_row + 1 + F.col("line_seq")).cast("bigint").alias("row_num"),
                        _by_code({c: F.array(*_cells(c)) for c in CODES}).alias("cells"),
                        F.col("code").alias("distributor"))


def _grid_extras(data: DataFrame) -> DataFrame:
    """Header, metadata, empty and summary rows, from the (file, sheet) pairs of the data rows."""
    sheets = data.select(F.col("distributor").alias("code"), "file", "sheet").distinct()
    header_row = _by_code({c: F.lit(PROFILES[c].header_row) for c in CODES})
    header = sheets.select("file", "sheet", header_row.cast("bigint").alias("row_num"),
                           _by_code({c: F.array(*[F.lit(h) for h in PROFILES[c].headers]) for c in CODES})
                           .alias("cells"), F.col("code").alias("distributor"))
    empty = sheets.select("file", "sheet", F.lit(EMPTY_ROW).alias("row_num"),
                          _by_code({c: F.array_repeat(F.lit(None).cast("string"), len(PROFILES[c].headers))
                                    for c in CODES}).alias("cells"), F.col("code").alias("distributor"))
    meta = (sheets.filter(header_row > 0)
            .select("code", "file", "sheet", F.explode(F.sequence(F.lit(0), header_row - 1)).alias("row_num"))
            .select("file", "sheet", F.col("row_num").cast("bigint").alias("row_num"),
                    F.array(F.lit("Reporte de ventas"), F.col("file")).alias("cells"),
                    F.col("code").alias("distributor")))
    summary = (data.filter(F.col("distributor") == "DIST_B").groupBy("file").agg(F.count(F.lit(1)).alias("t"))
               .select("file", F.lit("Resumen").alias("sheet"), F.lit(0).cast("bigint").alias("row_num"),
                       F.array(F.lit("Lineas"), F.col("t").cast("string")).alias("cells"),
                       F.lit("DIST_B").alias("distributor")))
    return header.unionByName(empty).unionByName(meta).unionByName(summary)


def derive_grids(src: Source) -> DataFrame:
    """Raw grid of every distributor workbook (one per distributor and day).

    One pass over the order lines produces all data rows (the layout is a
    CASE on the distributor); header, metadata and empty rows come from the
    distinct (file, sheet) pairs.
    """
    data = materialize(_grid_data(feed_lines(src)), "grid-data", ["distributor"], "zstd")
    return data.unionByName(_grid_extras(data))


_LANDED: dict[tuple[str, str, str], DataFrame] = {}


def land_grid(src: Source) -> DataFrame:
    """The landed raw-grid table, partitioned by distributor (one scan per layout prunes to its folder).

    Landing happens once per version of the source's files: later readers
    scan the landed files, as they would the landing-zone table.
    """
    key = src.state_key()
    if key not in _LANDED:
        import uuid
        path = f"{checkpoint_dir(src.spark).rstrip('/')}/tables/grid-{uuid.uuid4().hex[:12]}"
        lines = feed_lines(src)
        # numbers are places in an invoice and among all invoices, which are there by now: parts need nothing of each other
        for part in star.by_invoice(src, lines):
            data = _grid_data(part)
            data.write.mode("append").partitionBy("distributor").option("compression", "zstd").parquet(path)
            release_shuffles(src.spark)
        written = src.spark.read.schema(data.schema).parquet(path)
        _grid_extras(written).write.mode("append").partitionBy("distributor").option("compression", "zstd").parquet(path)
        _LANDED[key] = src.spark.read.schema(data.schema).parquet(path).select(*GRID_COLUMNS)
    return _LANDED[key]


_PARSED: dict[tuple[str, str, str], DataFrame] = {}


def parsed_feed(src: Source, as_of: datetime | None = None, keep: bool = True) -> DataFrame:
    """The parsed workbook rows as a staging table (written once per version of the source's files).

    Consumers of parsed rows (mapping results, the validation queue, key
    resolution) read this table instead of re-parsing every workbook. Without ``keep`` it is not written for this
    caller, who parses the rows on the way.
    """
    key = src.state_key()
    if key not in _PARSED:
        rows = read_all_profiles(land_grid(src), as_of)
        if not keep:
            return rows
        _PARSED[key] = materialize(rows, "parsed-feed", ["distributor_code"], "zstd")
    return _PARSED[key]


def keep_parsed(src: Source, rows: DataFrame) -> None:
    """From now on the parsed feed is read from a table that holds its columns, unless it has one of its own."""
    _PARSED.setdefault(src.state_key(), rows)
