"""Key resolution defaults and rejects (D-1 ... D-7, C-17); validation queue status (K-17)."""

import tempfile
from datetime import date, datetime

from pyspark.sql import functions as F

from salesmart.operators import runlog, staging
from salesmart.operators.resolve import UNKNOWN, Dimensions, resolve_keys
from salesmart.plans import load_jobs, marts
from salesmart.plans import validation as v
from salesmart.sources.tables import Source
from tests.conftest import SF_SMALL


def _dims(spark):
    products = spark.createDataFrame([(10, 10, 3)], "product_key bigint, product_id bigint, laboratory_key int")
    clients = spark.createDataFrame([(7, "C7", "Farmacia Uno")], "client_key bigint, client_id string, client_name string")
    return Dimensions.build(spark, products, clients)


def test_resolve_keys_defaults_and_rejects(spark):
    rows = [("F1", 1, date(2024, 1, 5), "Santiago", None, 10, "DIST_A", "Farmacia Uno", 100.0, 60.0),
            ("F2", 1, date(2024, 1, 6), "Nowhere", "SUR", 99, "DIST_Z", "Desconocida", 50.0, None),
            ("F3", 1, None, "Bani", None, 10, None, "Farmacia Uno", 10.0, 5.0)]
    df = spark.createDataFrame(rows, "invoice_number string, invoice_line int, sale_date date, city_name_clean string, "
                                     "zone_code_clean string, sap_product_id bigint, distributor_code string, "
                                     "client_name_clean string, net_amount double, cost_amount double")
    facts, rejected = resolve_keys(df, _dims(spark), source_system="DIST_A", as_of=datetime(2024, 2, 1))
    got = {r.invoice_number: r for r in facts.collect()}
    assert set(got) == {"F1", "F2"}
    assert rejected.select("invoice_number", "rejection_reason").collect()[0].asDict() == {
        "invoice_number": "F3", "rejection_reason": "missing_critical_key"}
    f1, f2 = got["F1"], got["F2"]
    assert f1.zone_key == 2 and f1.product_key == 10 and f1.laboratory_key == 3 and f1.client_key == 7
    assert f1.margin_amount == 40.0 and f1.margin_pct == 40.0 and f1.unresolved_keys == ["salesperson"]
    # unknown city -> capital's key; zone from the zone code; unknown product/client -> unknown member
    assert f2.zone_key == 4 and f2.product_key == UNKNOWN and f2.client_key == UNKNOWN
    assert set(f2.unresolved_keys) == {"product", "client", "salesperson"}
    assert f2.distributor_key == 1          # unknown distributor code -> internal
    assert f1.source_record_id == "F1-1" and f1.is_deleted is False


def test_validation_status_latest_decision_wins(spark):
    queue = spark.createDataFrame([(1, "CIUDAD", "Stgo", "Santiago", 95.0), (2, "PRODUCTO", "X", "Y", 70.0),
                                   (3, "CIUDAD", "Zz", "Santo Domingo", 30.0)],
                                  "queue_id bigint, entry_type string, raw_value string, suggested_value string, "
                                  "confidence_pct double")
    log = tempfile.mkdtemp(prefix="salesmart-decisions-")
    state = lambda: {r.queue_id: r.status for r in v.with_status(queue, v.decisions(spark, log)).collect()}
    # no decision, no status: the confidence decides nothing
    assert state() == dict.fromkeys((1, 2, 3), v.PENDING)
    v.apply_decision(spark, log, 1, v.APPROVED, datetime(2024, 1, 1), "analyst")
    v.apply_decision(spark, log, 3, v.REJECTED, datetime(2024, 1, 1), "analyst")
    v.apply_decision(spark, log, 1, v.REJECTED, datetime(2024, 1, 2), "other")
    assert state() == {1: v.REJECTED, 2: v.PENDING, 3: v.REJECTED}
    v.compact(spark, log)
    assert state() == {1: v.REJECTED, 2: v.PENDING, 3: v.REJECTED}
    v.apply_decision(spark, log, 3, v.APPROVED, datetime(2024, 1, 3), "other")
    v.compact(spark, log)
    assert state() == {1: v.REJECTED, 2: v.PENDING, 3: v.APPROVED}
    bands = queue.select("queue_id", v.band(F.col("confidence_pct")).alias("b")).collect()
    assert {r.queue_id: r.b for r in bands} == {1: "ALTA", 2: "BAJA", 3: "BAJA"}


def test_a_decision_changes_the_next_queue_report(spark):
    src = Source(spark, SF_SMALL)
    spark.conf.set("salesmart.validation.decisions", tempfile.mkdtemp(prefix="salesmart-decisions-"))
    try:
        before = {r.status: r.entries for r in v.validation_status_counts(src).collect()}
        entry = v.validation_pending(src).first()
        v.apply_decision(spark, v.decision_log(spark), entry.queue_id, v.APPROVED, datetime(2024, 6, 1), "analyst")
        after = {r.status: r.entries for r in v.validation_status_counts(src).collect()}
        assert after == before | {v.PENDING: before[v.PENDING] - 1, v.APPROVED: before[v.APPROVED] + 1}
        newest = v.validation_history(src).first()
        assert (newest.raw_value, newest.resolved_by) == (entry.raw_value, "analyst")
    finally:
        spark.conf.unset("salesmart.validation.decisions")


def test_staged_twice_loaded_once_none_unprocessed(spark):
    root = tempfile.mkdtemp(prefix="salesmart-staging-")
    head = ["Fecha", "Num_Factura", "", "Num_Factura", "Cod_Producto", "Cantidad"]
    g = spark.createDataFrame(
        [(f, "Ventas", 0, head) for f in ("DIST_A_1.xlsx", "DIST_A_2.xlsx")]
        + [("DIST_A_1.xlsx", "Ventas", 1, ["2024-01-01", "F1", "x", "again", None]), ("DIST_A_1.xlsx", "Ventas", 2, [None] * 6),
           ("DIST_A_2.xlsx", "Ventas", 1, ["2024-01-02", 'F"2', "x", "again", "RA-1", "3"]), ("DIST_A_2.xlsx", "Notas", 1, ["no data"])],
        "file string, sheet string, row_num bigint, cells array<string>")
    at = datetime(2024, 1, 5)
    for run in ("a", "a", "b"):
        staging.stage(g, f"{root}/staging", run, at)
    assert staging.waiting(spark, f"{root}/none", f"{root}/ledger") is None
    got = staging.waiting(spark, f"{root}/staging", f"{root}/ledger").orderBy("file_name").collect()
    assert [(r.distributor_id, r.file_name, r.row_num, r.raw_data) for r in got] == [
        ("DIST_A", "DIST_A_1.xlsx", 1, '{"Fecha":"2024-01-01","Num_Factura":"F1","column 3":"x","Num_Factura 4":"again",'
                                       '"Cod_Producto":null,"Cantidad":null}'),
        ("DIST_A", "DIST_A_2.xlsx", 1, '{"Fecha":"2024-01-02","Num_Factura":"F\\"2","column 3":"x","Num_Factura 4":"again",'
                                       '"Cod_Producto":"RA-1","Cantidad":"3"}')]
    done = lambda *files: spark.createDataFrame([(f, "processed") for f in files] + [("DIST_A_9.xlsx", "rejected")],
                                                "source_file string, outcome string")
    runlog.put(done("DIST_A_1.xlsx"), f"{root}/ledger", "a")
    assert [r.file_name for r in staging.waiting(spark, f"{root}/staging", f"{root}/ledger").collect()] == ["DIST_A_2.xlsx"]
    runlog.put(done("DIST_A_2.xlsx"), f"{root}/ledger", "b")
    assert staging.waiting(spark, f"{root}/staging", f"{root}/ledger").isEmpty()


def test_landed_data_is_seen_by_the_next_report(spark):
    import shutil
    root = tempfile.mkdtemp(prefix="salesmart-src-")
    for name in ("region", "nation", "customer", "part", "orders"):
        shutil.copy(f"{SF_SMALL}/{name}.parquet", root)
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    half = lines.where("l_orderkey % 2 = 0")
    half.coalesce(1).write.parquet(f"{root}/lineitem.parquet")
    net = lambda: marts.sales_by_category(Source(spark, root)).agg(F.sum("total_quantity")).first()[0]
    before = net()
    assert before == net()
    lines.where("l_orderkey % 2 = 1").coalesce(1).write.mode("append").parquet(f"{root}/lineitem.parquet")
    assert net() > 1.5 * before


def test_dimensions_are_cached_until_their_files_move(spark):
    import shutil
    root = tempfile.mkdtemp(prefix="salesmart-dims-")
    for name in ("region", "nation", "part"):
        shutil.copy(f"{SF_SMALL}/{name}.parquet", root)
    clients = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    clients.where("c_custkey % 2 = 0").coalesce(1).write.parquet(f"{root}/customer.parquet")
    src = Source(spark, root)
    first = load_jobs.default_dimensions(src).clients
    assert load_jobs.default_dimensions(Source(spark, root)).clients is first and first.count() < clients.count()
    clients.where("c_custkey % 2 = 1").coalesce(1).write.mode("append").parquet(f"{root}/customer.parquet")
    assert load_jobs.default_dimensions(src).clients.count() == clients.count()
