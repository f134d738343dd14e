"""The sales star schema derived from the raw order tables.

Mapping (one fact row per order line):

* invoice = order, invoice line = line number, sale date = order date;
* client = customer, city = the customer's nation, zone = its region;
* product = part, category = part type, laboratory = brand, RX when size <= 25;
* distributor = supplier key modulo 7 (0 is internal sales, 1..6 the six
  external distributors); salesperson = customer key modulo 15, plus 1;
* soft-deleted = returned lines (return flag ``R``).

Plan shape (what matters at 100 TB):

* A line is shuffled twice at most, by part and by order, with the columns that no other column
  determines; the rest is computed from the loaded row (``described``).
* nation/region/customer/part are ordinary tables: Spark decides broadcast vs
  shuffle join from their measured size (``autoBroadcastJoinThreshold``, AQE
  re-plans with runtime sizes). Literal dimensions are lookups (7 distributors)
  or carry a broadcast hint (15 salespeople) - their size is the literal itself.
* Dimensions are joined only when the caller asks for them (``client``, ``product``).
* The soft-delete filter is applied on the scan, where it is a pushed parquet filter.
* Money is DECIMAL end to end (exact sums); ratios are computed on decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.dates import month_name_es, year_month
from salesmart.sources.reference_data import DISTRIBUTORS, salespeople_df
from salesmart.sources.tables import Source

RX_MAX_SIZE = 25
N_DISTRIBUTORS = 7
N_SALESPEOPLE = 15


def zones(src: Source) -> DataFrame:
    """Zone dimension: one row per region (zone_key = region key + 1)."""
    r = src.region
    return r.select(
        (r.r_regionkey + 1).alias("zone_key"),
        F.upper(F.substring(r.r_name, 1, 3)).alias("zone_code"),
        r.r_name.alias("zone_name"),
    )


def cities(src: Source) -> DataFrame:
    """City dimension: one row per nation, with its zone and a map position.

    The position is a fixed function of the keys (the source has no
    coordinates); it only feeds the map screen.
    """
    n = src.nation
    return n.select(
        n.n_nationkey.alias("city_key"),
        n.n_name.alias("city_name"),
        (n.n_regionkey + 1).alias("zone_key"),
        (F.lit(17.5) + n.n_nationkey.cast("double") / 10).alias("latitude"),
        (F.lit(-71.5) + n.n_regionkey.cast("double") / 2).alias("longitude"),
    )


def clients(src: Source) -> DataFrame:
    c = src.customer
    return c.select(
        c.c_custkey.alias("client_key"),
        c.c_name.alias("client_name"),
        c.c_mktsegment.alias("client_type"),
        c.c_nationkey.alias("city_key"),
    )


def products(src: Source) -> DataFrame:
    p = src.part
    return p.select(
        p.p_partkey.alias("product_key"),
        p.p_name.alias("product_name"),
        p.p_type.alias("category"),
        F.concat(F.lit("SIZE_"), F.lpad((p.p_size / 10).cast("int").cast("string"), 2, "0")).alias("subcategory"),
        F.when(p.p_size <= RX_MAX_SIZE, F.lit("RX")).otherwise(F.lit("OTC")).alias("rx_otc_flag"),
        F.regexp_extract(p.p_brand, r"(\d+)$", 1).cast("int").alias("laboratory_key"),
        p.p_brand.alias("lab_name"),
        p.p_retailprice.cast("decimal(12,4)").alias("list_price"),
    )


def distributor_key(suppkey: Column) -> Column:
    return F.pmod(suppkey, F.lit(N_DISTRIBUTORS)).cast("int") + 1


def salesperson_key(custkey: Column) -> Column:
    return F.pmod(custkey, F.lit(N_SALESPEOPLE)).cast("int") + 1


def _headers(src: Source, client: bool, how: str) -> DataFrame:
    """Orders with their date and (optionally) the client's own attributes."""
    o = src.orders
    hdr = o.select(
        o.o_orderkey.alias("invoice_number"),
        o.o_custkey.alias("client_key"),
        F.to_date(o.o_orderdate).alias("sale_date"),
    )
    return hdr.join(clients(src), "client_key", how) if client else hdr


def _joined(src: Source, client: bool, product: bool, include_deleted: bool, outer: bool = False) -> DataFrame:
    """The star joins themselves, with the columns that :func:`described` cannot compute from the others.

    Lines meet the parts first and the orders last, so that an invoice's lines lie together; zones and cities are
    attached to the joined rows, so no shuffle carries them. ``outer`` keeps lines whose dimension row is missing
    (flags say so).
    """
    how = "left" if outer else "inner"
    li = src.lineitem
    li = li.filter(li.l_suppkey.isNotNull())     # every key has its distributor
    if not include_deleted:
        li = li.filter(F.coalesce(li.l_returnflag != F.lit("R"), F.lit(True)))
    fact = li.select(
        li.l_orderkey.alias("invoice_number"),
        li.l_linenumber.alias("invoice_line"),
        li.l_partkey.alias("product_key"),
        li.l_suppkey.alias("supplier_key"),
        li.l_quantity.cast("decimal(12,3)").alias("quantity"),
        li.l_extendedprice.cast("decimal(15,2)").alias("gross_amount"),
        li.l_discount.cast("decimal(5,2)").alias("discount"),
        F.coalesce(li.l_returnflag == F.lit("R"), F.lit(False)).alias("is_deleted"),
    )
    if product:
        prods = products(src)
        fact = fact.join(prods.withColumn("_has_product", F.lit(True)) if outer else prods, "product_key", how)
    fact = fact.join(_headers(src, client, how), "invoice_number")
    if client:
        geo = cities(src).select("city_key", "city_name", "zone_key").join(zones(src), "zone_key")
        fact = fact.join(geo.withColumn("_has_client", F.lit(True)) if outer else geo, "city_key", how)
    return fact.withColumn("year", F.year("sale_date"))


def of_distributor(n: int) -> Column:
    """Field ``n`` (from the key) of the row's distributor, a literal lookup."""
    return F.element_at(F.array(*[F.lit(d[n]) for d in sorted(DISTRIBUTORS)]), F.col("distributor_key"))


def described(f: DataFrame, product: bool = True) -> DataFrame:
    """Rows of the star with all that their own columns determine: dates, amounts, cost and margin, distributor, texts."""
    d = F.col("sale_date")
    qty, gross = F.col("quantity"), F.col("gross_amount")
    f = f.withColumns({
        "distributor_key": distributor_key(F.col("supplier_key")),
        "salesperson_key": salesperson_key(F.col("client_key")),
        "unit_price": F.round(F.try_divide(gross, F.nullif(qty, F.lit(0))), 4).cast("decimal(16,4)"),
        "discount_pct": F.col("discount") * 100,
        "discount_amount": F.round(gross * F.col("discount"), 2),
        "date_key": F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d),
        "month_num": F.month(d),
        "month_name": month_name_es(F.month(d)),
        "year_month": year_month(d),
        "source_record_id": F.concat_ws("-", F.col("invoice_number").cast("string"), F.col("invoice_line").cast("string")),
    }).withColumns({
        "net_amount": gross - F.col("discount_amount"),
        "distributor_code": of_distributor(1), "distributor_name": of_distributor(2), "distributor_type": of_distributor(3),
    })
    if product:
        f = f.withColumn("cost_amount", F.round(qty * F.col("list_price") * F.lit(0.60).cast("decimal(2,2)"), 2))
        f = f.withColumn("margin_amount", F.col("net_amount") - F.col("cost_amount"))
        f = f.withColumn(
            "margin_pct",
            F.round(F.try_divide(F.col("margin_amount") * 100, F.nullif(F.col("net_amount"), F.lit(0))), 3)
            .cast("decimal(12,3)"))
    return f.withColumn("source_system", F.when(F.col("distributor_code") == "INT", "SAP_HANA")
                        .otherwise(F.col("distributor_code")))


_LOADED: dict[tuple[str, str, str], DataFrame] = {}
#: Order lines that are joined at a time.
ROUND_LINES = 1 << 26
BASE_COLUMNS = ["invoice_number", "invoice_line", "product_key", "supplier_key", "distributor_key", "quantity", "unit_price",
                "gross_amount", "discount_pct", "discount_amount", "net_amount", "is_deleted", "client_key",
                "sale_date", "date_key", "year", "month_num", "month_name", "year_month", "salesperson_key",
                "distributor_code", "distributor_name", "distributor_type", "source_system", "source_record_id"]
CLIENT_COLUMNS = ["city_key", "zone_key", "client_name", "client_type", "city_name", "zone_code", "zone_name"]
PRODUCT_COLUMNS = ["product_name", "category", "subcategory", "rx_otc_flag", "laboratory_key", "lab_name",
                   "cost_amount", "margin_amount", "margin_pct"]


def by_invoice(src: Source, rows: DataFrame) -> list[DataFrame]:
    """Rows of the order lines in parts of whole invoices, so many that each has about ROUND_LINES of all lines at most.

    Written one after the other, the shuffles of one part are gone before the next.
    """
    parts = -(-src.lineitem.count() // ROUND_LINES)
    if parts <= 1:
        return [rows]
    turn = F.pmod(F.xxhash64("invoice_number"), F.lit(parts))
    return [rows.where(turn == i) for i in range(parts)]


def loaded_fact(src: Source, path: str | None = None) -> DataFrame:
    """The denormalised sales fact, written once per version of the source's files.

    This is the warehouse's load step: every line with the attributes of its dimensions (left-joined, with
    found-flags), soft-deleted lines included, written partitioned by year and sorted by (zone, date) inside files.
    Reports then scan only the columns they use instead of re-joining the sources; the found-flags give them exactly
    the rows an inner join would. What one row determines (:func:`described`) is computed when the row is read, so
    neither the joins nor the files carry it; a table loaded to a ``path`` of its own has these columns too.
    """
    key = src.state_key()
    if key not in _LOADED or path is not None:
        rows = _joined(src, client=True, product=True, include_deleted=True, outer=True)
        rows = (rows.withColumn("_has_client", F.col("_has_client").isNotNull())
                    .withColumn("_has_product", F.col("_has_product").isNotNull()))
        order = ["year", "zone_key", "sale_date", "invoice_number", "invoice_line"]
        if path is None:
            from salesmart.session import materialize_parts
            _LOADED[key] = materialize_parts((x.sortWithinPartitions(*order) for x in by_invoice(src, rows)), "fact-sales",
                                             ["year"], "zstd")
        else:
            rows = described(rows).sortWithinPartitions(*order)
            rows.write.mode("overwrite").partitionBy("year").parquet(path)
            _LOADED[key] = src.spark.read.schema(rows.schema).parquet(path).select(*rows.columns)
    return _LOADED[key]


def rows(src: Source, *, client: bool = True, product: bool = True, include_deleted: bool = False) -> DataFrame:
    """The star's rows as loaded, before :func:`described`."""
    if not src.use_loaded_fact:
        return _joined(src, client, product, include_deleted)
    f = loaded_fact(src)
    if not include_deleted:
        f = f.filter(~F.col("is_deleted"))
    if client:
        f = f.filter(F.col("_has_client"))
    if product:
        f = f.filter(F.col("_has_product"))
    return f


def sales(src: Source, *, client: bool = True, product: bool = True,
          include_deleted: bool = False) -> DataFrame:
    """The sales fact at line grain, with the requested dimensions.

    ``client`` adds client/city/zone columns, ``product`` adds product/lab
    columns and the cost/margin measures. Rows are those of inner joins with
    the requested dimensions.
    """
    f = rows(src, client=client, product=product, include_deleted=include_deleted)
    if "net_amount" not in f.columns:
        f = described(f, product)
    return f.select(*BASE_COLUMNS, *(CLIENT_COLUMNS if client else []), *(PRODUCT_COLUMNS if product else []))


def salespeople(src: Source) -> DataFrame:
    return F.broadcast(salespeople_df(src.spark))
