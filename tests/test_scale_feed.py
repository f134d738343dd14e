"""The feed at size: headers looked up once for a sheet, shuffle files of finished steps let go."""

from salesmart import session
from salesmart.sources import grid


def test_tables_let_their_shuffles_go(spark, monkeypatch):
    calls, keep = [], session.release_shuffles
    monkeypatch.setattr(session, "release_shuffles", lambda s: calls.append(1) or keep(s))
    assert session.materialize(spark.range(3).repartition(2), "small").count() == 3 and calls == [1]


def test_header_texts_are_not_compared_for_each_row(spark):
    data = spark.createDataFrame([("DIST_F_1.xlsx", "Ventas_MedDist", 0, [" Referencia", "Fecha", "CodMD"], "DIST_F"),
                                  ("DIST_F_1.xlsx", "Ventas_MedDist", 1, ["F1", "02/01/2024", "MD7"], "DIST_F")],
                                 grid.GRID_SCHEMA + ", distributor string")
    got = grid.read_profile(data, grid.PROFILES["DIST_F"])
    assert [(r.invoice_number, str(r.sale_date), r.dist_product_code, r.quantity) for r in got.collect()] == [("F1", "2024-01-02", "MD7", None)]
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(plan) if "Join" in line)
    assert not any("array_position" in line for line in plan[:join + 1])
