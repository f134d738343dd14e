"""The validation queue: each code is mapped once, the wide lines are not joined or written for it."""

from pyspark.sql import functions as F

from salesmart.operators import matching
from salesmart.operators.matching import derive_mapping, map_product_codes
from salesmart.plans import cleansing_queries, validation
from salesmart.plans.ingest import AS_OF
from salesmart.sources import grid
from salesmart.sources.tables import Source
from tests.conftest import SF_SMALL


def test_queue_maps_codes_and_not_lines(spark, monkeypatch):
    src, written = Source(spark, SF_SMALL), []
    feed = grid.parsed_feed(src, AS_OF)
    monkeypatch.setattr(cleansing_queries, "_MAPPED", {})
    for module in (cleansing_queries, validation, matching):
        keep = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, name, *a, _k=keep, **k: written.append(name) or _k(df, name, *a, **k))
    queue = validation.build_queue(src).where(F.col("entry_type") == validation.PRODUCT)
    got = queue.select("source_distributor", "raw_value", "suggested_value", "confidence_pct", "source_file", "created_at")
    assert "mapped-feed" not in written
    lines = map_product_codes(feed, derive_mapping(src)).where(~F.col("mapping_exact"))
    want = lines.groupBy("distributor_code", "product_name_raw").agg(
        F.min("sap_product_name"), F.round(F.min("mapping_confidence") * 100, 1), F.min("source_file"), F.min("extracted_at"))
    one = lines.groupBy("distributor_code", "product_name_raw").agg(F.count_distinct("sap_product_name", "mapping_confidence").alias("n"))
    assert one.where("n > 1").isEmpty()
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()
