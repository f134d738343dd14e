"""The pipeline as a whole on awkward rows, and on empty tables; its stages against slow versions."""

import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from salesmart.llm import mixing
from tests.llm.fixtures import SCHEMA, documents, shingle_set

LABELS = "doc_id long, quality int, toxic int"
ITEMS = "item_id long, text string"


def folder(spark, rows, items):
    root = tempfile.mkdtemp(prefix="salesmart-corpus-")
    extra = {"weight": F.lit(1), "spans": F.lit("x"), "h": F.lit(2)}
    spark.createDataFrame(rows, SCHEMA).withColumns(extra).repartition(3).write.parquet(f"{root}/documents.parquet")
    labels = [(r[0], 1, 0) for r in rows[::3]] + [(None, None, None)]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, ITEMS).write.parquet(f"{root}/benchmark.parquet")
    return root


@pytest.fixture(scope="module")
def rows():
    return documents()


@pytest.fixture(scope="module")
def items(rows):
    words = rows[0][1].split()
    return [(1, " ".join(words[20:60])), (2, None), (3, ""), (1, " ".join(words[20:60])), (None, "never seen words in any document at all")]


def test_stages_on_awkward_rows(spark, rows, items):
    root = folder(spark, rows, items)
    docs = spark.read.parquet(f"{root}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]
    stages = dict(corpus_pipeline.STAGES)
    for name in names[:-1]:
        out = stages[name](spark, docs, root)
        assert out.columns == docs.columns, name
        assert not Counter(r.doc_id for r in out.collect()) - Counter(r[0] for r in rows), name
    # no label is toxic, so nothing goes
    assert stages["toxicity"](spark, docs, root).count() == len(rows)
    kept = {r.doc_id for r in stages["near_dedup"](spark, docs, root).collect()}
    sets = {r[0]: shingle_set(r[1]) for r in rows if r[0] is not None}
    for a in sets:
        near = [b for b in sets if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
        assert (a in kept) == (not near), a
    left = {r.doc_id for r in stages["decontamination"](spark, docs, root).collect()}
    item = shingle_set(items[0][1])
    assert {i for i, s in sets.items() if item <= s} & left == set()
    assert {i for i, s in sets.items() if not item & s} <= left


def test_run_goes_through_all_stages(spark, rows, items, monkeypatch):
    root = folder(spark, rows, items)
    out = corpus_pipeline.run(spark, root)
    assert out.columns == spark.read.parquet(f"{root}/documents.parquet").columns
    copies = Counter(r.doc_id for r in out.collect())
    assert copies and set(copies) <= {r[0] for r in rows} and max(copies.values()) <= mixing.MOST_COPIES


def test_run_on_empty_tables(spark):
    assert corpus_pipeline.run(spark, folder(spark, [], [])).count() == 0
