"""Fuzzy paths checked against brute force over the same inputs."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from salesmart.functions import similarity as sim
from salesmart.operators import cleanse as cl
from salesmart.operators import fuzzy
from salesmart.operators.matching import SUGGEST_FROM, derive_mapping, map_product_codes, with_suggestions
from salesmart.plans import cleansing_queries as cq
from salesmart.sources import grid
from salesmart.sources import reference_data as rd
from salesmart.sources.tables import Source
from tests.conftest import SF_SMALL
from tests.slow_similarity import ratio, token_set_ratio, token_sort_ratio


def py_norm(s):
    if not isinstance(s, str):
        return ""
    s = s.strip()
    s = "".join(ch for ch in unicodedata.normalize("NFD", s) if not unicodedata.combining(ch)).lower()
    s = "".join(ch if (ch.isascii() and (ch.isalnum() or ch == "_")) or ch.isspace() else " " for ch in s)
    return " ".join(s.split())


def py_city(raw, threshold=75):
    if not isinstance(raw, str) or not raw.strip():
        return rd.DEFAULT_CITY, 0.5
    n = py_norm(raw)
    keys = [(py_norm(a), c) for a, c in rd.CITY_ALIASES]
    for k, c in keys:
        if k == n:
            return c, 1.0
    for k, c in keys:
        if k in n or n in k:
            return c, 0.95
    best = None
    for c in cl.CANONICAL_CITIES:
        sc = token_sort_ratio(n, py_norm(c))
        if sc >= threshold and (best is None or sc > best[1]):
            best = (c, sc)
    if best:
        return best[0], best[1] / 100
    return rd.DEFAULT_CITY, 0.3


def test_scorers_basic():
    assert ratio("", "") == 100.0
    assert token_sort_ratio("b a", "a b") == 100.0
    assert token_set_ratio("a b", "a b c") == 100.0
    assert token_set_ratio("", "x") == 0.0
    assert round(ratio("sntiago", "santiago"), 4) == 93.3333


def test_column_scorers_equal_the_slow_ones(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("aab cdeé 世\t\u2003") for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 20, 61, 62, 63, 125])))
             for _ in range(5000)]

    def near(x):
        x = list(x)
        for _ in range(rng.randint(0, 4)):
            x.insert(rng.randint(0, len(x)), rng.choice("abc "))
            x.pop(rng.randrange(len(x)))
        return "".join(x)

    pairs = [*zip(texts, texts[1:] + texts[:1], strict=True), *((a, near(a)) for a in texts), (None, "a"), ("a", None)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string").repartition(8)
    scores = [f(F.col("a"), F.col("b")) for f in (sim.ratio, sim.token_sort_ratio, sim.token_set_ratio)]
    got = df.select("i", *[x.alias(f"s{k}") for k, x in enumerate(scores)]).collect()
    assert len(got) == len(pairs) > 10_000
    for r in got:
        a, b = pairs[r.i]
        assert tuple(r)[1:] == ((None,) * 3 if a is None or b is None else
                                (ratio(a, b), token_sort_ratio(a, b), token_set_ratio(a, b))), (a, b)


def test_city_cleansing_matches_brute_force(spark):
    got = cq.city_cleansing(Source(spark, SF_SMALL)).collect()
    assert got
    for r in got:
        want = py_city(r.city_raw)
        assert (r.city_name_clean, pytest.approx(r.city_match_confidence)) == (want[0], pytest.approx(want[1])), r


def test_product_mapping_matches_brute_force(spark):
    src = Source(spark, SF_SMALL)
    mapping = derive_mapping(src)
    feed = grid.read_all_profiles(grid.land_grid(src)).filter(F.col("distributor_code").isin("DIST_C", "DIST_E"))
    got = map_product_codes(feed, mapping).collect()
    rows = mapping.orderBy("map_order").collect()
    by_dist = {}
    for m in rows:
        by_dist.setdefault(m.distributor_code, []).append(m)
    unmapped = 0
    for r in got:
        cands = by_dist[r.distributor_code]
        exact = [m for m in cands if m.dist_product_code == r.dist_product_code.strip()]
        if exact:
            assert r.mapping_exact and r.sap_product_id == exact[-1].sap_product_id
            continue
        desc = r.product_name_raw.strip()
        best = None
        if len(desc) > 3:
            for m in cands:
                sc = token_set_ratio(desc, m.dist_product_desc)
                if sc >= 70 and (best is None or sc > best[1]):
                    best = (m, sc)
        if best is None:
            unmapped += 1
            assert r.sap_product_id is None and r.mapping_confidence == 0.0
        else:
            assert r.sap_product_id == best[0].sap_product_id
            assert r.mapping_confidence == pytest.approx(best[1] / 100)
    assert unmapped > 0


def test_unmapped_report_counts(spark):
    out = cq.unmapped_products(Source(spark, SF_SMALL))
    rows = out.collect()
    assert rows and all(r.occurrence_count >= 1 for r in rows)
    assert {r.distributor_code for r in rows} == {"DIST_C"}


def test_product_name_cleansing_matches_brute_force(spark):
    src = Source(spark, SF_SMALL)
    got = {r.product_name_raw: r for r in cq.product_name_cleansing(src).collect()}
    parts = sorted(src.part.select("p_partkey", "p_name").collect())
    # catalogue: normalised name -> (first position, id/name of the last entry)
    cat = {}
    for pos, p in enumerate(parts):
        n = py_norm(p.p_name)
        first = cat[n][0] if n in cat else pos
        cat[n] = (first, p.p_partkey, p.p_name)
    ordered = sorted(cat.items(), key=lambda kv: kv[1][0])
    for raw, r in got.items():
        q = py_norm(raw)
        if not isinstance(raw, str) or not raw.strip():
            continue
        if q in cat:
            assert (r.product_name_clean, r.product_match_confidence) == (cat[q][2], 1.0)
            continue
        best = None
        for n, (_, pid, name) in ordered:
            sc = token_set_ratio(q, n)
            if sc >= 70 and (best is None or sc > best[1]):
                best = ((pid, name), sc)
        if best is None:
            assert r.product_name_clean == raw and r.product_match_confidence == 0.0
        else:
            assert r.matched_product_id == str(best[0][0]) and r.product_name_clean == best[0][1]
            assert r.product_match_confidence == pytest.approx(best[1] / 100)


def test_best_matches_equals_scoring_every_pair(spark):
    words = ["blue", "green", "greem", "steel", "st", "tin", "copper", "coper", "ñandú", "x"]
    texts = [" ".join(words[(i * k + k) % 10] for k in range(1, 2 + i % 4)) for i in range(40)] + ["", "  "]
    asked = [f"{a} {b}" for a in words for b in words[::3]] + ["", "zzz", "grean", "coppre tim"]
    cands = spark.createDataFrame([(g, t, g * 1000 + i, (i,)) for g in (1, 2) for i, t in enumerate(dict.fromkeys(texts[g:]))]
                                  + [(1, None, 5000, (0,))], "g int, t string, pos int, hit struct<id: int>")
    queries = spark.createDataFrame([(g, q) for g in (1, 2, 3) for q in asked] + [(1, None)], "g int, q string").distinct()
    got = {(r.g, r.q): (r.hit.id, r.score) for r in fuzzy.best_matches(queries, cands, 60.0).collect()}
    want = {}
    for g in (1, 2):
        for q in asked:
            scored = [(-token_set_ratio(q, t), i) for i, t in enumerate(dict.fromkeys(texts[g:]))]
            if scored and -min(scored)[0] >= 60.0:
                want[g, q] = (min(scored)[1], -min(scored)[0])
    assert len(want) > 20 and got == want


def test_more_candidates_than_any_chunk_holds(spark):
    n = 200_500
    cands = spark.range(n).select(F.lit("D").alias("g"), F.concat(F.lit("item "), F.hex("id")).alias("t"),
                                  F.col("id").alias("pos"), F.struct("id").alias("hit"))
    queries = spark.createDataFrame([("D", "itm 2A3F"), ("D", "2a3f item item"), ("D", "qqqqqqqq")], "g string, q string")
    got = {r.q: r.hit.id for r in fuzzy.best_matches(queries, cands, 70.0).collect()}
    assert got["2a3f item item"] == 0x23 and got["itm 2A3F"] == 0x2A3F and "qqqqqqqq" not in got


def catalogue(rng, n):
    """Product descriptions of invented words, and queries: copies with typos, lost and swapped words, and strangers."""
    words = ["".join(rng.choice("aeioulnrstdcmpbgfvz") for _ in range(rng.randint(3, 10))) for _ in range(n // 4)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 5))) for _ in range(n)]
    asked = []
    for t in rng.sample(texts, n // 5):
        own = list(t)
        for _ in range(rng.randint(0, 4)):
            own.insert(rng.randint(0, len(own)), rng.choice("aeios "))
            own.pop(rng.randrange(len(own)))
        own = "".join(own).split()
        rng.shuffle(own)
        asked.append(" ".join(own[: rng.randint(1, 5)] + rng.sample(words, rng.randint(0, 2))))
    return texts, sorted({*asked, "qqq www", "z", "xx yy zz"})


def best_of_all(asked, texts, cutoff):
    out = {}
    for q in asked:
        less, i = min((-token_set_ratio(q, t), i) for i, t in enumerate(texts))
        if -less >= cutoff:
            out[q] = (i, -less)
    return out


@pytest.mark.parametrize("cutoff", [1.0, 70.0, 85.0, 100.0])
def test_the_index_misses_no_best_match(spark, cutoff):
    texts, asked = catalogue(random.Random(7), 400)
    cands = spark.createDataFrame([("d", t, i, (i,)) for i, t in enumerate(texts)], "g string, t string, pos int, hit struct<id: int>")
    queries = spark.createDataFrame([("d", q) for q in asked], "g string, q string")
    counts = {}
    got = {r.q: (r.hit.id, r.score) for r in fuzzy.best_matches(queries, cands, cutoff, counts).collect()}
    want = best_of_all(asked, texts, cutoff)
    assert got == want and len(want) >= 10
    if cutoff >= 70:
        assert counts["pairs"] < 0.05 * len(asked) * len(texts)


def test_few_pairs_are_scored_on_the_part_table(spark):
    src = Source(spark, SF_SMALL)
    mapping = derive_mapping(src).where("distributor_code = 'DIST_B'")
    cands = mapping.select(F.col("distributor_code").alias("g"), F.col("dist_product_desc").alias("t"), F.col("map_order").alias("pos"),
                           F.struct(F.col("map_order").alias("id")).alias("hit"))
    queries = src.part.select(F.lit("DIST_B").alias("g"), F.concat_ws(" ", "p_type", F.upper("p_name"), "p_name").alias("q")).distinct()
    counts = {}
    got = {r.q: (r.hit.id, r.score) for r in fuzzy.best_matches(queries, cands, 70.0, counts).collect()}
    texts = {r.pos: r.t for r in cands.collect()}
    asked = [r.q for r in queries.collect()]
    want = {}
    for q in asked:
        less, pos = min((-token_set_ratio(q, t), pos) for pos, t in texts.items())
        if -less >= 70:
            want[q] = (pos, -less)
    assert got == want and want
    assert counts["pairs"] < 0.05 * len(asked) * len(texts)


def test_suggestions_are_the_nearest_descriptions(spark):
    texts, asked = catalogue(random.Random(11), 200)
    mapping = spark.createDataFrame([("D", t, i, i, f"p{i}") for i, t in enumerate(texts)],
                                    "distributor_code string, dist_product_desc string, map_order int, sap_product_id int, "
                                    "sap_product_name string")
    report = spark.createDataFrame([("D", q) for q in asked], "distributor_code string, product_description string")
    got = {r.product_description: (r.suggested_match, r.similarity_score) for r in with_suggestions(report, mapping).collect()}
    want = best_of_all(asked, texts, SUGGEST_FROM)
    assert got == {q: (f"p{want[q][0]}", pytest.approx(want[q][1] / 100, abs=6e-4)) if q in want else (None, None) for q in asked}
    assert 0 < sum(s is None for s, _ in got.values()) < len(asked) / 2
