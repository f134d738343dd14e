"""A large feed in parts: the same rows, and the shuffles of one part gone before the next."""

import datetime as dt

from pyspark.sql import functions as F

from salesmart import session
from salesmart.plans import cleansing_queries, governance
from salesmart.sources import grid, star
from salesmart.sources.tables import Source
from tests.conftest import SF_SMALL

TABLES = {star: "_LOADED", grid: "_LANDED", cleansing_queries: "_MAPPED"}


def test_parts_make_one_table_and_let_their_shuffles_go(spark, monkeypatch):
    calls, keep = [], session.release_shuffles
    monkeypatch.setattr(session, "release_shuffles", lambda s: calls.append(1) or keep(s))
    df = spark.createDataFrame([(i % 3, None if i == 5 else i % 2) for i in range(12)] * 2, "k int, v int").repartition(2)
    got = session.materialize_parts((df.where(F.col("k") == i) for i in range(4)), "parts", ["k"], "zstd")  # the last is empty
    assert calls == [1] * 4 and got.columns == ["k", "v"] and sorted(map(str, got.collect())) == sorted(map(str, df.collect()))


def test_facts_in_parts_equal_the_whole(spark, monkeypatch):
    def fresh(limit):
        src = Source(spark, SF_SMALL)
        for module, name in [*TABLES.items(), (grid, "_PARSED")]:
            monkeypatch.setattr(module, name, {})
        for module in (star, cleansing_queries):
            monkeypatch.setattr(module, "ROUND_LINES", limit, raising=False)
        return src

    written = []
    keep = session.release_shuffles
    for module in (session, grid):
        monkeypatch.setattr(module, "release_shuffles", lambda s: written.append(1) or keep(s))
    counts, results = [], []
    for limit in (1 << 40, 2500):
        src = fresh(limit)
        written.clear()
        facts = governance.resolved_feed_facts(src)
        results.append((facts, cleansing_queries.mapped_feed(src), grid.land_grid(src), star.loaded_fact(src),
                        grid.parsed_feed(src, cleansing_queries.AS_OF)))
        counts.append(len(written))
    assert counts[1] > counts[0] + 6
    for whole, part in zip(*results, strict=True):
        assert whole.columns == part.columns and whole.count() == part.count() > 0
        assert whole.exceptAll(part).isEmpty() and part.exceptAll(whole).isEmpty()


def test_repeated_invoices_meet_in_their_part(spark, monkeypatch):
    feed = grid.parsed_feed(Source(spark, SF_SMALL), cleansing_queries.AS_OF)
    line = lambda code, file, row, inv, qty: (code, code, file, "S", row, inv, dt.date(1996, 1, 2), qty, 7, "Azua", "Acme")
    lines = [line(code, f"{code}_{day}.xlsx", row, f"F{inv}", float(10 * day + row)) for code in ("DIST_A", "DIST_B")
             for day in (1, 2) for inv in range(6) for row in (inv * 2 + 1, inv * 2 + 2)]
    lines.append(line("DIST_B", "DIST_B_1.xlsx", 99, None, 5.0))
    own = spark.createDataFrame(lines, "distributor_code string, source_system string, source_file string, sheet string, row_num long, "
                                "invoice_number string, sale_date date, net_amount double, sap_product_id long, city_name_raw string, "
                                "client_name_raw string")
    assert set(own.columns) <= set(feed.columns) | {"sap_product_id"}
    monkeypatch.setattr(cleansing_queries, "mapped_feed", lambda src: own)
    names = ["source_system", "invoice_number", "invoice_line", "net_amount"]
    found = []
    for limit in (1 << 40, 8):
        monkeypatch.setattr(cleansing_queries, "ROUND_LINES", limit, raising=False)
        found.append(sorted(map(tuple, governance.resolved_feed_facts(Source(spark, SF_SMALL)).select(*names).collect()), key=str))
    # of a repeated (distributor, invoice, line) the later file's row stays
    want = [(code, f"F{inv}", k, 20.0 + inv * 2 + k) for code in ("DIST_A", "DIST_B") for inv in range(6) for k in (1, 2)]
    assert found[0] == found[1] == sorted([*want, ("DIST_B", None, 1, 5.0)], key=str)
