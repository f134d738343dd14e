"""Load jobs: bad files alone are rejected, retries leave no trace, marts follow, a killed backfill goes on."""

import os
import tempfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from salesmart.operators import runlog
from salesmart.operators.matching import derive_mapping
from salesmart.plans import load_jobs as lj
from salesmart.plans.refresh import Marts
from salesmart.sources import grid
from salesmart.sources.tables import Source
from tests.conftest import SF_SMALL
from tests.helpers import rows

AS_OF = datetime(2024, 1, 1)
MIN_DATE = "1992-01-01"


@pytest.fixture(scope="module")
def src(spark):
    return Source(spark, SF_SMALL)


@pytest.fixture(scope="module")
def workbooks(spark, src):
    path = tempfile.mkdtemp(prefix="salesmart-grid-") + "/g"
    grid.derive_grids(src).where("distributor IN ('DIST_A', 'DIST_C', 'DIST_D')").where(
        "file LIKE '%199601%' OR distributor = 'DIST_C' AND file LIKE '%1996%'").write.parquet(path)
    return spark.read.parquet(path)


def warehouse():
    return lj.Warehouse(tempfile.mkdtemp(prefix="salesmart-wh-"))


def table(spark, wh, name, *cols):
    return rows(spark.read.parquet(wh.path(name)), *cols)


LEDGER = ("source_file", "outcome", "reason", "rows")


def test_one_bad_file_does_not_stop_the_others(spark, src, workbooks):
    names = [r.file for r in workbooks.where("distributor = 'DIST_A'").select("file").distinct().orderBy("file").limit(3).collect()]
    three = workbooks.where(F.col("file").isin(names))
    broken = three.where((F.col("file") != names[1]) | (F.col("row_num") != 0))  # the second one lost its header row
    wh, mapping, dims = warehouse(), derive_mapping(src), lj.default_dimensions(src)
    out = lj.load_distributor_batch(spark, broken, mapping, dims, wh, AS_OF, min_date=MIN_DATE)
    assert out.inserted > 0 and out.files_rejected == 1
    ledger = {r[0]: r[1:] for r in table(spark, wh, "file_ledger", *LEDGER)}
    assert ledger[names[1]] == ("rejected", "no header row", 0)
    assert {ledger[n][0] for n in (names[0], names[2])} == {"processed"}
    want = warehouse()
    lj.load_distributor_batch(spark, three.where(F.col("file") != names[1]), mapping, dims, want, AS_OF, min_date=MIN_DATE)
    keys = ("source_system", "source_record_id", "invoice_line", "net_amount")
    assert table(spark, wh, "fact_sales", *keys) == table(spark, want, "fact_sales", *keys)
    assert runlog.run_status(runlog.read_log(spark, wh.path("etl_run_log"))).first().status == "SUCCESS"


def test_file_status_names_the_reason(spark):
    head = ["Fecha", "Num_Factura", "Cod_Producto", "Descripcion", "Cantidad"]
    data = [("DIST_A_1.xlsx", "Ventas", 0, head), ("DIST_A_1.xlsx", "Ventas", 1, ["x"] * 5),
            ("DIST_A_2.xlsx", "Ventas", 0, head[:2]), ("DIST_A_2.xlsx", "Ventas", 1, ["x"] * 5),
            ("DIST_A_3.xlsx", "Otra", 0, head), ("DIST_A_4.xlsx", "Ventas", 1, ["x"] * 5),
            ("DIST_A_5.xlsx", "Ventas", 0, head), ("DIST_A_5.xlsx", "Ventas", 1, [None] * 5),
            ("DIST_A_6.xlsx", "Ventas", 0, head), ("DIST_A_6.xlsx", "Ventas", 1, None),
            ("other.xlsx", "Ventas", 0, head),
            ("DIST_D_1.xlsx", "Zona_Sur", 0, ["Fecha", "Factura", "Codigo", "Cantidad"]), ("DIST_D_1.xlsx", "Zona_Sur", 1, ["x"]),
            ("DIST_D_1.xlsx", "Zona_Este", 0, ["Fecha", "Factura", "Codigo"]), ("DIST_D_1.xlsx", "Notas", 0, ["y"])]
    got = grid.file_status(spark.createDataFrame(data, "file string, sheet string, row_num bigint, cells array<string>"))
    assert {r.file: r.reason for r in got.collect()} == {
        "DIST_A_1.xlsx": None, "DIST_A_2.xlsx": "missing columns: Cantidad, Cod_Producto", "DIST_A_3.xlsx": "no sheet of the layout",
        "DIST_A_4.xlsx": "no header row", "DIST_A_5.xlsx": "no data rows", "DIST_A_6.xlsx": "rows without cells",
        "other.xlsx": "unknown layout", "DIST_D_1.xlsx": "missing columns: Cantidad"}


def test_a_retried_batch_leaves_every_table_as_it_was(spark, src, workbooks):
    wh, mapping, dims = warehouse(), derive_mapping(src), lj.default_dimensions(src)
    late = "1996-01-15"  # earlier lines are rejected

    def run():
        out = lj.load_distributor_batch(spark, workbooks, mapping, dims, wh, AS_OF, run_id="stream-7", min_date=late)
        state = {"rejected_rows": table(spark, wh, "rejected_rows", "source_file", "row_num", "rejection_reason"),
                 "file_ledger": table(spark, wh, "file_ledger", *LEDGER),
                 "unmapped": rows(lj.unmapped_codes(spark, wh), "distributor_code", "dist_product_code", "occurrence_count"),
                 "log": rows(runlog.read_log(spark, wh.path("etl_run_log")), "run_id", "status", "records_read",
                             "records_loaded", "records_rejected"),
                 "fact": table(spark, wh, "fact_sales", "source_system", "source_record_id", "invoice_line", "net_amount")}
        return out, state

    first, before = run()
    second, after = run()
    assert before == after and before["rejected_rows"] and before["unmapped"] and len(before["log"]) == 2
    assert (second.inserted, second.updated) == (0, first.inserted) and first.rejected == len(before["rejected_rows"])
    assert first.read == first.loaded + first.rejected + first.duplicates and first.duplicates >= 0
    other = lj.load_distributor_batch(spark, workbooks, mapping, dims, wh, AS_OF, run_id="stream-8", min_date=late)
    assert other.rejected == first.rejected
    assert len(table(spark, wh, "rejected_rows", "row_num")) == 2 * first.rejected  # another run has rows of its own
    twice = {r[:2]: r[2] for r in rows(lj.unmapped_codes(spark, wh), "distributor_code", "dist_product_code", "occurrence_count")}
    assert twice == {r[:2]: 2 * r[2] for r in before["unmapped"]}


MARTS = ("mv_sales_monthly_zone", "mv_sales_yoy", "mv_top_clients", "mv_product_margin", "mv_commission_monthly")


def stamps(wh):
    out = {}
    for name in MARTS:
        for top, folders, files in os.walk(wh.path(name)):
            if files and not folders and "=" in os.path.basename(top):
                out[os.path.relpath(top, wh.root)] = os.stat(top).st_mtime_ns
    return out


def test_marts_follow_a_load_and_other_months_stay(spark, src):
    dims, feed, wh = lj.default_dimensions(src), lj.change_feed(src), warehouse()
    marts = Marts(src, wh, dims)
    load = lambda part, **kw: lj.load_change_feed_batch(spark, part, dims, wh, AS_OF, min_date=MIN_DATE, refresh=marts, **kw)
    load(feed.where("sale_date < '1996-03-01' AND NOT (sale_date >= '1995-06-01' AND sale_date < '1995-06-20')"))
    before = stamps(wh)
    load(feed.where("sale_date >= '1995-06-01' AND sale_date < '1995-06-20'"))
    after = stamps(wh)
    changed = {k for k in after if before.get(k) != after[k]}
    assert changed == {"mv_sales_monthly_zone/year=1995/month_num=6", "mv_sales_yoy/year=1995/month_num=6",
                       "mv_top_clients/year=1995", "mv_product_margin/year=1995", "mv_commission_monthly/year=1995/month_num=6"} \
        | {k for k in after if k == "mv_sales_yoy/year=1996/month_num=6"}
    # later sales leave a gap of months without any: commissions have them
    load(feed.where("sale_date >= '1996-06-01' AND sale_date < '1996-08-01'"))
    full = Marts(src, lj.Warehouse(wh.root), dims)
    got = {name: spark.createDataFrame(marts.read(name).collect(), marts.read(name).schema) for name in MARTS}
    full(None)
    for name in MARTS:
        want = full.read(name)
        cols = sorted(want.columns)
        assert rows(got[name], *cols) == rows(want, *cols), name
        assert want.count() > 0


def test_a_killed_backfill_goes_on_at_the_first_open_range(spark, src, monkeypatch):
    dims, feed = lj.default_dimensions(src), lj.change_feed(src)
    ranges = lj.date_ranges(date(1995, 1, 1), date(1997, 3, 1), months=6)
    assert len(ranges) == 5 and ranges[0] == (date(1995, 1, 1), date(1995, 7, 1)) and ranges[-1][1] == date(1997, 3, 1)
    # rows that are rejected and older copies of rows, so that all counts have something
    odd = feed.where("invoice_line = 1").withColumn("changed_at", F.col("changed_at") - F.expr("INTERVAL 1 DAY"))
    feed = feed.withColumn("quantity", F.when(F.col("invoice_line") == 2, F.lit(-1.0)).otherwise(F.col("quantity"))).unionByName(odd)
    whole, cut = warehouse(), warehouse()
    want = lj.run_backfill(spark, feed, dims, whole, AS_OF, "history", ranges, min_date=MIN_DATE)
    load, done = lj.load_change_feed_batch, []

    def dying(*args, **kw):
        if len(done) == 2:
            raise KeyboardInterrupt
        done.append(kw["run_id"])
        return load(*args, **kw)

    monkeypatch.setattr(lj, "load_change_feed_batch", dying)
    with pytest.raises(KeyboardInterrupt):
        lj.run_backfill(spark, feed, dims, cut, AS_OF, "history", ranges, min_date=MIN_DATE)
    started = []
    monkeypatch.setattr(lj, "load_change_feed_batch", lambda *a, **kw: started.append(kw["run_id"]) or load(*a, **kw))
    got = lj.run_backfill(spark, feed, dims, cut, AS_OF, "history", ranges, min_date=MIN_DATE)
    assert len(started) == 3 and not set(started) & set(done)
    assert got == want and want["read"] == want["loaded"] + want["rejected"] + want["duplicates"]
    inside = feed.where("sale_date >= '1995-01-01' AND sale_date < '1997-03-01'")
    keys = inside.where("quantity > 0").select("invoice_number", "invoice_line").distinct().count()
    assert (want["read"], want["loaded"], want["rejected"]) == (inside.count(), keys, inside.where("quantity <= 0").count())
    assert want["duplicates"] > 0
    cols = ("source_system", "source_record_id", "invoice_line", "date_key", "quantity", "net_amount")
    assert table(spark, cut, "fact_sales", *cols) == table(spark, whole, "fact_sales", *cols)


def test_full_load_loads_every_source_and_repeats_nothing(spark, src, workbooks):
    wh, mapping, dims = warehouse(), derive_mapping(src), lj.default_dimensions(src)
    marts = Marts(src, wh, dims)
    args = (spark, src, workbooks, mapping, wh, AS_OF, (date(1995, 1, 1), date(1996, 1, 1)))
    first = lj.run_full_load(*args, min_date=MIN_DATE, refresh=marts)
    fact = spark.read.parquet(wh.fact)
    by = {r.source_system: r["count"] for r in fact.groupBy("source_system").count().collect()}
    assert {"SQL_SERVER", "SAP_HANA", "DIST_A", "DIST_C", "DIST_D"} <= set(by)
    assert first["loaded"] == sum(by.values()) and first["read"] == first["loaded"] + first["rejected"] + first["duplicates"]
    assert spark.read.parquet(wh.path("dim_client")).count() == src.customer.count()
    assert marts.read("mv_commission_monthly").count() > 0
    runs = runlog.read_log(spark, wh.path("etl_run_log")).count()
    assert lj.run_full_load(*args, min_date=MIN_DATE) == first
    assert runlog.read_log(spark, wh.path("etl_run_log")).count() == runs
