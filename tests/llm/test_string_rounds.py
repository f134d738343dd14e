"""Repeated strings at size: no filter fills up with the corpus, and ranges of triggers give the same spans."""

import numpy as np

from salesmart.llm import suffix_dedup as sd
from salesmart.llm import window_dedup


def _docs(spark, unique=120):
    rng = np.random.default_rng(3)
    text = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()
    shared = text(900)
    rows = [(i, text(2000)) for i in range(unique)]
    rows += [(unique, text(300) + shared + text(200)), (unique + 1, shared[100:700] + text(400)), (unique + 2, rows[0][1]),
             (None, text(150) + shared), (None, rows[1][1]), (5, text(50) + shared[:300]), (unique + 3, shared + shared), (unique + 4, None)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_triggers_that_stand_once_leave_whatever_the_sketch_holds(spark, monkeypatch):
    docs, kept, keep = _docs(spark), {}, sd.save

    def save(df, name):
        out = keep(df, name)
        kept[name] = out.count()
        return out

    monkeypatch.setattr(sd, "save", save)
    for limit in ("LEAST_BITS", "MOST_BITS"):  # a full sketch, as 2**26 counters are at 6 GB
        monkeypatch.setattr(window_dedup, limit, 8)
    sd.remove_repeats(docs)
    phrases = sum(p.g.size for r in docs.collect() for _, p in sd.parses((r.text or "").encode()))
    assert 0 < kept["phrase-dictionary"] <= kept["phrase-parse"] < phrases / 10


def test_rounds_find_the_same_spans(spark, monkeypatch):
    docs = _docs(spark, 12)
    rows = lambda: sorted(map(tuple, sd.remove_repeats(docs).collect()), key=str)
    want, turns, keep = rows(), [], sd._round
    assert sum(r[2] > 0 for r in want) >= 6
    monkeypatch.setattr(sd, "ROUND", 8000)
    monkeypatch.setattr(sd, "_round", lambda texts, several, turn, rounds: turns.append((turn, rounds)) or keep(texts, several, turn, rounds))
    assert rows() == want
    assert len(turns) > 2 and turns == [(i, len(turns)) for i in range(len(turns))]


def test_filters_hold_every_hash(spark):
    rng = np.random.default_rng(4)
    keys, others = rng.integers(-(1 << 63), (1 << 63) - 1, (2, 5000))
    bitmap = sd._filter(spark.createDataFrame([(int(k),) for k in keys], "k long"), "k")
    assert sd._has(bitmap, keys.view(np.uint64)).all() and sd._has(bitmap, others.view(np.uint64)).mean() < 0.02
    assert sd._bits(40_000_000) == 1 << 29 == sd._bits(1 << 40) and sd._bits(0) == sd.BITMAP_BITS
