"""Line repeats: letters counted in windows only, probes dealt out without lambdas."""

import numpy as np
from pyspark.sql import functions as F

from salesmart.llm import line_dedup


def _edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = int(rng.integers(0, len(out) + 1))
        out[at: at + int(rng.integers(0, 2))] = list(rng.choice(list("etaox"), rng.integers(0, 2)))
    return "".join(out)


def test_near_lines_around_the_windows(spark):
    rng = np.random.default_rng(11)
    lines = []
    for size in (12, 13, 30, 31, 32, 33, 34, 35, 63, 64, 65, 66, 90, 200):
        for _ in range(4):
            line = "".join(rng.choice(list("etanoribx "), size)).strip(" ").ljust(12, "z")
            lines += [line, *(_edited(rng, line, k) for k in (1, 2, 2, 3, 4))]
    lines = [x for x in dict.fromkeys(lines) if len(x) >= line_dedup.LEAST and x.strip(" ")]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r.doc_id for r in line_dedup.repeats(docs).where("n_removed > 0").collect()}
    pairs = docs.alias("a").crossJoin(docs.alias("b")).where(F.col("a.doc_id") < F.col("b.doc_id"))
    near = pairs.where(F.levenshtein("a.text", "b.text") <= line_dedup.EDITS)
    assert got == {r.doc_id for r in near.select("b.doc_id").distinct().collect()} and 50 < len(got) < len(lines)


def test_probes_have_no_lambda(spark, monkeypatch):
    plans, keep = {}, line_dedup.save

    def save(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return keep(df, name)

    monkeypatch.setattr(line_dedup, "save", save)
    docs = spark.createDataFrame([(1, "one line that stands here"), (2, "one line that stands there")], "doc_id long, text string")
    assert [r.n_removed for r in line_dedup.repeats(docs).orderBy("doc_id").collect()] == [0, 1]
    pairs = [p for n, p in plans.items() if n.startswith("line-pairs-")]
    assert len(pairs) == line_dedup.EDITS + 1 and not any("lambda" in p for p in pairs)
