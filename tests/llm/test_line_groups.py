"""Line repeats in large groups of one template: every link, and no pairs."""

import numpy as np
from pyspark.sql import functions as F

from salesmart.llm import line_dedup
from tests.llm.test_line_windows import _edited


def _lines():
    rng = np.random.default_rng(5)
    lines = []
    for size in (12, 17, 40, 75):
        for _ in range(2):
            base = "".join(rng.choice(list("etanoribx "), size)).strip(" ").ljust(12, "z")
            lines += [base, *(_edited(rng, base, int(k)) for k in rng.integers(1, 5, 14))]
    # one end stays while the other is counted up
    lines += [f"the same beginning of a line {i * 37 % 4096:04d}" for i in range(40)]
    lines += [base[:-1], base + "e", "x" + base, base[1:], base[1:] + "t", "qq" + base, base + "qq", base[2:]]
    return [x for x in dict.fromkeys(lines) if len(x) >= line_dedup.LEAST and x.strip(" ")]


def _near(spark, lines):
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    pairs = docs.alias("a").crossJoin(docs.alias("b")).where(F.col("a.doc_id") < F.col("b.doc_id"))
    near = pairs.where(F.levenshtein("a.text", "b.text") <= line_dedup.EDITS)
    return docs, {r.doc_id for r in near.select("b.doc_id").distinct().collect()}


def test_lines_of_groups_meet_by_their_places(spark):
    lines = _lines()
    docs, want = _near(spark, lines)
    rows = docs.select(F.col("doc_id").alias("uid"), F.col("text").alias("line"), F.length("text").alias("n"),
                       F.col("doc_id").alias("first"))
    got = {r.uid for r in line_dedup.near_in_groups(rows, rows.select("uid")).collect()}
    assert got == want and 40 < len(got) < len(lines)


def test_repeats_with_frequent_segments(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "EVERY", 1)
    monkeypatch.setattr(line_dedup, "OFTEN", 3)
    docs, want = _near(spark, _lines())
    assert {r.doc_id for r in line_dedup.repeats(docs).where("n_removed > 0").collect()} == want


def test_one_template_makes_no_pairs(spark, monkeypatch):
    made, keep = {}, line_dedup.save

    def save(df, name):
        made[name] = keep(df, name)
        return made[name]

    monkeypatch.setattr(line_dedup, "save", save)
    n = 1200
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("the very same beginning of a line, then "),
                                                                      F.format_string("%06d", F.col("id") * 7919 % 1000000)).alias("text"))
    got = {r.doc_id for r in line_dedup.repeats(docs).where("n_removed > 0").collect()}
    assert sum(made[f"line-pairs-{i}"].count() for i in range(3)) < 20 * n
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    _, want = _near(spark, texts)
    assert got == want


def test_repeats_with_segments_for_crowd_and_groups(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "EVERY", 1)
    monkeypatch.setattr(line_dedup, "OFTEN", 2)
    monkeypatch.setattr(line_dedup, "MOST", 4)
    docs, want = _near(spark, _lines())
    assert {r.doc_id for r in line_dedup.repeats(docs).where("n_removed > 0").collect()} == want


def _saved(monkeypatch):
    """name -> (table, plan that was written), filled as line_dedup saves."""
    made, keep = {}, line_dedup.save

    def save(df, name):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        made[name] = (keep(df, name), plan)
        return made[name][0]

    monkeypatch.setattr(line_dedup, "save", save)
    return made


def test_near_copies_of_one_text_make_few_pairs(spark, monkeypatch):
    """Copies with other words in the middle share segments and both ends, but few of them are near."""
    made = _saved(monkeypatch)
    rng = np.random.default_rng(9)
    word = lambda size: "".join(rng.choice(list("etanorihsd"), size))
    words = [word(int(k)) for k in rng.integers(2, 9, 40)]
    lines = set()
    while len(lines) < 100:
        changed = rng.integers(14, 26, 2)
        lines.add(" ".join(word(len(w)) if k in changed else w for k, w in enumerate(words)))
    docs, want = _near(spark, sorted(lines))
    assert {r.doc_id for r in line_dedup.repeats(docs).where("n_removed > 0").collect()} == want
    pairs = [t.where("b is not null").count() for n, (t, _) in made.items() if n.startswith(("line-pairs-", "line-crowd-pairs-"))]
    assert len(pairs) == 2 * (line_dedup.EDITS + 1) and sum(pairs) < 10 * len(lines)


def test_lines_of_groups_are_not_looked_up_among_all_lines(spark, monkeypatch):
    """A join of all lines for the groups shuffles their text, also if no line is in a group."""
    made = _saved(monkeypatch)
    docs, _ = _near(spark, _lines())
    line_dedup.repeats(docs).collect()
    lookups = [p for n, (_, p) in made.items() if n in ("line-grouped", "line-crowd")]
    assert not any("line-distinct" in p or "last#" in p for p in lookups)
    assert "line-grouped" not in made or "line-crowd" in made
