"""What is shuffled and written at size: the fact without derived columns, ranks without checkpoints of whole rows."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from salesmart.operators.ranking import rank_over, running_total
from salesmart.sources import star
from salesmart.sources.tables import Source
from tests.conftest import SF_SMALL
from tests.helpers import rows


def test_loaded_fact_holds_no_derived_column(spark):
    stored = star.loaded_fact(Source(spark, SF_SMALL))
    derived = {"net_amount", "discount_amount", "unit_price", "margin_pct", "month_name", "distributor_name", "source_record_id"}
    assert not derived & set(stored.columns)


@pytest.mark.parametrize("client, product", [(True, True), (False, False), (True, False)])
def test_loaded_rows_equal_the_joins(spark, client, product):
    kinds = {"client": client, "product": product, "include_deleted": True}
    got, want = (star.sales(Source(spark, SF_SMALL, loaded), **kinds) for loaded in (True, False))
    assert got.schema.simpleString() == want.schema.simpleString()
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_ranks_checkpoint_no_rows(spark, monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("whole rows checkpointed uncompressed")

    monkeypatch.setattr(DataFrame, "checkpoint", refuse)
    df = spark.range(0, 300).select((F.col("id") % 2).alias("g"), (F.col("id") % 7).alias("v"), F.col("id").alias("k")).repartition(5)
    by = rank_over(df, ["g"], [("v", True)], out="r", tie_breakers=["k"]).where("k in (0, 1, 6)")
    # of 150 rows of a group 21 or 22 have each value
    want = {(k, 1 + sum(x % 2 == k % 2 and x % 7 > k % 7 for x in range(300))) for k in (0, 1, 6)}
    assert set(rows(by, "k", "r")) == want
    n = rank_over(df, ["g"], [("v", True)], out="r", method="row_number", tie_breakers=["k"])
    assert rows(n.groupBy("g").agg(F.min("r"), F.max("r"), F.count_distinct("r"))) == [(0, 1, 150, 150), (1, 1, 150, 150)]
    assert running_total(df, "v", [("k", False)]).agg(F.max("running_total")).first()[0] == sum(x % 7 for x in range(300))


def test_feed_lines_are_numbered_by_their_invoices_only(spark, monkeypatch):
    from salesmart.operators import ranking
    from salesmart.sources import grid
    written = []
    keep = ranking.materialize
    monkeypatch.setattr(ranking, "materialize", lambda df, *a, **k: written.append(df.columns) or keep(df, *a, **k))
    f = grid.feed_lines(Source(spark, SF_SMALL))
    assert written and all(set(c) <= {"invoice_number", "_n", "_pid", "_pos"} for c in written)
    n = f.agg(F.min("line_seq"), F.max("line_seq"), F.count_distinct("line_seq"), F.count("*")).first()
    assert n[0] == 1 and n[1] == n[2] == n[3]
    last = f.groupBy("invoice_number").agg(F.min("line_seq").alias("a"), F.max("line_seq").alias("b"), F.count("*").alias("n"))
    assert last.where("b - a + 1 <> n").isEmpty()


@pytest.mark.parametrize("query", ["secure_zone_sales", "national_zone_sales"])
def test_secured_lines_are_not_shuffled_by_zone(spark, query):
    from salesmart.plans import governance
    plan = getattr(governance, query)(Source(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    semi = [line for line in plan.splitlines() if "LeftSemi" in line]
    assert semi and all("BroadcastHashJoin" in line for line in semi)
