"""Client dimension upsert (B-4), mart refresh order (B-8), post-load commission refresh (I-5)."""

import tempfile
from datetime import datetime

from pyspark.sql import functions as F

from salesmart.operators.upsert import upsert_clients
from salesmart.plans import admin
from salesmart.sources.tables import Source
from tests.conftest import SF_SMALL


def test_client_upsert_inserts_then_updates(spark):
    path = tempfile.mkdtemp(prefix="salesmart-clients-") + "/dim_client"
    rows = spark.createDataFrame([("C1", "Fcia. Uno", "FARMACIA", "1-01-12345-6"), ("C2", "Hosp. Dos", None, None)],
                                 "client_id string, client_name string, client_type string, rnc string")
    first = upsert_clients(spark, path, rows, datetime(2024, 1, 1))
    assert first == {"inserted": 2, "updated": 0}
    changed = spark.createDataFrame([("C2", "Hospital Dos", "HOSPITAL", None), ("C3", "x" * 250, None, None)],
                                    "client_id string, client_name string, client_type string, rnc string")
    second = upsert_clients(spark, path, changed, datetime(2024, 2, 1))
    assert second == {"inserted": 1, "updated": 1}
    t = {r.client_id: r for r in spark.read.parquet(path).collect()}
    assert t["C2"].client_name == "Hospital Dos" and t["C2"].client_type == "HOSPITAL"
    assert len(t["C3"].client_name) == 200 and t["C3"].credit_limit == 50000
    # missing required columns: nothing happens
    assert upsert_clients(spark, path, changed.drop("client_name"), datetime(2024, 3, 1)) == {"inserted": 0,
                                                                                               "updated": 0}


def test_refresh_marts_and_commissions(spark):
    src = Source(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="salesmart-marts-")
    paths = admin.refresh_marts(src, root)
    mz = spark.read.parquet(paths["mv_sales_monthly_zone"])
    yoy = spark.read.parquet(paths["mv_sales_yoy"])
    assert mz.count() == yoy.count() > 0
    cpath = root + "/fact_commission"
    admin.refresh_commissions(src, cpath, ["1996-01", "1996-02"])
    admin.refresh_commissions(src, cpath, ["1996-02", "1996-03"])
    fc = spark.read.parquet(cpath)
    assert sorted(r.year_month for r in fc.select("year_month").distinct().collect()) == ["1996-01", "1996-02",
                                                                                          "1996-03"]
    assert fc.groupBy("year_month").count().filter(F.col("count") != 15).count() == 0
