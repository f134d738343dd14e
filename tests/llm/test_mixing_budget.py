"""The token budget holds whatever a rare kind of document asks for; weights equal a slow raking."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from salesmart.llm import mixing
from tests.llm.fixtures import SCHEMA, documents

WORDS = " ".join(["word"] * 200)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, WORDS if i % 5 else "few words here " * 4, ("en", "de", "fr", "es")[i % 4], f"src{i % 3}") for i in range(400)]
    rows += [(1000 + i, f"a | b {WORDS}", "en", f"src{i % 3}") for i in range(30)]
    rows += [(2000, "one licence", "en", "src0"), (None, None, None, None), (2001, "", "de", "src1")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("weight", F.lit(1)).repartition(4)


def raked(rows):
    """weight of each row: cycles of source, language and topic factors over all rows"""
    mass = {id(r): float(r.n_tokens) for r in rows}
    total = sum(mass.values())
    by_source = Counter()
    for r in rows:
        by_source[r.source] += r.n_tokens
    root = {k: v ** mixing.TEMPERATURE for k, v in by_source.items()}
    want = {"source": {k: v / sum(root.values()) for k, v in root.items()}}
    for axis, named in (("lang", mixing.LANG_TARGETS), ("topic", mixing.TOPIC_TARGETS)):
        own = Counter()
        for r in rows:
            own[getattr(r, axis) if getattr(r, axis) in named else "other"] += r.n_tokens
        rest = own["other"] / total
        live = sum(v for k, v in named.items() if own[k])
        want[axis] = {k: (1 - rest) * v / live for k, v in named.items() if own[k]} | ({"other": rest} if rest else {})
    factor = defaultdict(lambda: 1.0)
    key = lambda r, axis: getattr(r, axis) if getattr(r, axis) in want[axis] else "other"
    for _ in range(300):
        for axis in ("lang", "topic", "source"):
            now = Counter()
            for r in rows:
                now[key(r, axis)] += mass[id(r)]
            for r in rows:
                k = key(r, axis)
                if now[k]:
                    mass[id(r)] *= want[axis][k] * total / now[k]
    return {r.doc_id: mixing.RATE * mass[id(r)] / r.n_tokens for r in rows if r.n_tokens}


def test_weights_equal_slow_raking(docs):
    got = mixing.calibrate(docs, hold_budget=True).collect()
    want = raked(got)
    for r in got:
        if r.n_tokens:
            assert r.weight == pytest.approx(min(want[r.doc_id], mixing.MOST_COPIES), rel=1e-3), r
            assert int(r.weight) <= r.copies <= int(r.weight) + 1
    assert max(want.values()) > mixing.MOST_COPIES


def test_one_rare_document_keeps_the_rest(docs):
    got = mixing.calibrate(docs, hold_budget=True).collect()
    tokens = sum(r.n_tokens for r in got)
    assert sum(r.n_tokens * r.copies for r in got) > 0.3 * tokens
    assert sum(r.n_tokens * r.copies for r in mixing.calibrate(docs).collect()) < 0.05 * tokens
    told = {(r.axis, r.category): r for r in mixing.marginals(docs, hold_budget=True).collect()}
    assert told["topic", "licensed"].expected < 0.01 < told["topic", "licensed"].target
    assert told["lang", "de"].expected == pytest.approx(told["lang", "de"].target, rel=0.2)


def test_sample_has_the_copies_and_all_columns(docs, spark):
    want = {r.doc_id: r.copies for r in mixing.calibrate(docs, hold_budget=True).collect() if r.copies}
    out = mixing.sample(docs, hold_budget=True)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter(want)
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.sample(empty, hold_budget=True).count() == 0
    assert mixing.marginals(empty, hold_budget=True).count() == 0
    many = spark.createDataFrame(documents(), SCHEMA)
    assert mixing.sample(many, hold_budget=True).columns == many.columns


def test_targets_are_arguments(docs):
    targets = mixing.Targets(lang={"de": 1.0}, topic={"table": 0.5, "prose": 0.5}, temperature=1.0, rate=0.2, most_copies=9)
    told = {(r.axis, r.category): r.fitted for r in mixing.marginals(docs, targets).collect()}
    assert told["topic", "table"] == pytest.approx(told["topic", "prose"], rel=1e-3)
    assert ("lang", "en") not in told and ("lang", "other") in told
