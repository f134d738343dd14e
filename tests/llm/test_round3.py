"""Manifest, ranked search and repeated passages against slow versions, on awkward rows and empty tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm import lexical, merkle, window_dedup
from tests.llm.fixtures import SCHEMA, documents


@pytest.fixture(scope="module")
def rows():
    return documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    clash = {c: F.lit(1) for c in ("key", "pos", "n", "digest", "rank", "h", "doc", "s", "e", "score", "norm")}
    return spark.createDataFrame(rows, SCHEMA).withColumns(clash).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ----------------------------------------------------------------------------- 11

def H(parts):
    return hashlib.sha256(parts.encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row[:5]
    fields = (doc_id, source, lang, n_chars, text)
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree(nodes):
    """levels of a list of digests, each with runs of eight"""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i: i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def steps(levels, i):
    for level in levels[:-1]:
        run = level[i // 8 * 8: i // 8 * 8 + 8]
        yield "".join(run[: i % 8]), "".join(run[i % 8 + 1:])
        i //= 8


def audit(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([n[2] for n in sorted(langs[x], key=lambda n: n[:3])]) for x in order}
    top = tree([trees[x][-1][0] for x in order])
    out = Counter()
    for k, x in enumerate(order):
        for i, (_, _, own, r) in enumerate(sorted(langs[x], key=lambda n: n[:3])):
            low = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            node = leaf(r, re.sub("[A-Z]", lambda m: m.group().lower(), r[1])) if low else own
            way = [*steps(trees[x], i), *steps(top, k)]
            for left, right in way:
                node = H(left + node + right)
            out[r[0], own, trees[x][-1][0], top[-1][0], H("".join(a + b for a, b in way)), node, node == top[-1][0]] += 1
    return out


def checked(docs):
    got = merkle.audit(docs, merkle.tampered())
    return Counter(tuple(r) for r in got.drop("copied").collect())


def test_manifest(docs, rows, empty, spark):
    assert checked(docs) == audit(rows)
    assert checked(empty) == Counter()
    one = [(7, "Only One", "en", None, 8, 7, "x")]
    assert checked(spark.createDataFrame(one, SCHEMA)) == audit(one)


def test_manifest_over_several_blocks_and_rounds(spark):
    langs = ["en"] * 20 + ["de", None]
    many = [(i if i % 50 else None, f"Text {i % 1000}", langs[i % 22], f"s{i % 3}", 8, 7, "x") for i in range(9000)]
    got = checked(spark.createDataFrame(many, SCHEMA).repartition(7))
    assert got == audit(many)
    assert {v[-1] for v in got} == {True, False}


def test_manifest_with_many_langs(spark):
    many = [(i, "A text", f"lang{i % 600:03}", None, 6, 7, "x") for i in range(1300)]
    assert checked(spark.createDataFrame(many, SCHEMA)) == audit(many)


def test_a_version_copies_only_the_path(spark):
    many = [(i, f"TEXT {i}", "en", None, 6, 7, "x") for i in range(600)]
    got = merkle.audit(spark.createDataFrame(many, SCHEMA), merkle.tampered()).collect()
    assert {len(r.copied) for r in got} == {merkle.LEVELS + 1}
    assert all(r.verified == (r.copied[0] == r.leaf) for r in got)


# ----------------------------------------------------------------------------- 12

def words(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def ranking(rows, items):
    texts = [(r[0], Counter(words(r[1]))) for r in rows]
    texts = [(i, c, c.total()) for i, c in texts if c]
    n_docs, total = len(texts), sum(n for *_, n in texts)
    df = Counter(t for _, c, _ in texts for t in c)
    out = Counter()
    for item_id, text in set(items):
        scored = []
        for i, c, n in texts:
            m = 100 - 50 + (50 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in set(words(text)) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        for k, (score, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:50]):
            out[item_id, k + 1, i, -score] += 1
    return out


@pytest.fixture(scope="module")
def items(rows):
    texts = [t for _, t, *_ in rows if t]
    some = [(i, " ".join(t.split()[3:40])) for i, t in enumerate(texts[:20])]
    return [*some, some[0], (3, "another text of item 3 " + texts[1][:60]), (90, None), (91, ""), (92, "??? --"),
            (93, "nowheretobefound"), (None, texts[2][:80]), (94, "É " + texts[5][:50]), (95, "aa " * 5000)]


def found(docs, items, spark):
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))
    return Counter(tuple(r) for r in lexical.search(docs, table).collect())


def test_ranked_search(docs, rows, items, spark, empty, monkeypatch):
    want = ranking(rows, items)
    assert found(docs, items, spark) == want
    monkeypatch.setattr(lexical, "HEAD", 2)
    monkeypatch.setattr(lexical, "ITEM_TERMS", 200)
    assert found(docs, items, spark) == want
    assert found(empty, items, spark) == Counter()
    assert found(docs, [], spark) == Counter()


def test_many_documents_with_ties(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(300)]
    many = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(1, 60))) if i % 3 else ["w1", "w2", "w3"]), "en", None, 1, 7, "x")
            for i in range(3000)]
    items = [(i, " ".join(rng.choice(vocabulary, 12))) for i in range(15)] + [(99, "w1 w2 w3")]
    assert found(spark.createDataFrame(many, SCHEMA).repartition(6), items, spark) == ranking(many, items)


def test_buckets_pass_over_what_cannot_win():
    block = lexical.Block.of([list(range(12)), [3, 40]], np.arange(50, 0, -1, dtype=np.int64))
    rng = np.random.default_rng(4)
    found = lexical.Search(block, np.zeros(2, dtype=np.int64))
    every = []
    for b in range(30):
        n = 64
        vectors = np.where(rng.random((n, 50)) < 0.2, rng.integers(1, 1000, (n, 50)), 0) // (b + 1)
        norm = np.sqrt((vectors**2).sum(axis=1))
        order = np.argsort(-norm)
        vectors, norm = vectors[order], norm[order]
        row, ids = np.nonzero(vectors)
        doc = np.arange(n) + b * n
        found.add(norm, doc, np.zeros(n, dtype=bool), row, ids, vectors[row, ids])
        every += [(d, v) for d, v in zip(doc.tolist(), vectors, strict=True)]
    for q, own in enumerate(block.items):
        best = sorted(((-int(v[own].sum()), d) for d, v in every if v[own].sum() > 0))[:50]
        score, _, doc = found.best[q]
        assert [(-s, d) for s, d in zip(score.tolist(), doc.tolist(), strict=True)] == best


def test_terms_do_not_depend_on_pieces(monkeypatch):
    text = ("Ab1 c'd " * 50 + "ÉéZ" * 40 + " end").encode()
    whole = [t for p in lexical.terms(text) for t in p]
    assert [t.decode() for t in whole] == words(text.decode())
    monkeypatch.setattr(lexical, "PIECE", 7)
    assert [t for p in lexical.terms(text) for t in p] == whole


# ----------------------------------------------------------------------------- 13

def passages(rows):
    texts = [(r[0], re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    seen = Counter(tuple(w[i: i + 35]) for _, w in texts for i in range(len(w) - 34))
    out = Counter()
    for doc_id, w in texts:
        gone = set()
        for i in range(len(w) - 34):
            if seen[tuple(w[i: i + 35])] > 1:
                gone.update(range(i, i + 35))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


@pytest.fixture(scope="module")
def passage_rows(rows):
    words = rows[0][1].split()
    loop = " ".join(f"w{i % 40}" for i in range(300))
    more = [(700, loop), (701, "x " + loop[:600]), (702, "\t".join(words[20:60]) + "\x0b\x0c tail"),
            (703, " ".join(words[10:44])), (704, " ".join([*words[10:45], "other"])), (705, "same " * 100),
            (706, "é " * 35), (707, "é " * 34 + "É"), (None, " ".join(words[:50]))]
    return [*rows, *[(i, t, "en", None, 1, 7, "x") for i, t in more]]


def test_repeated_passages(spark, passage_rows, empty, monkeypatch):
    table = spark.createDataFrame(passage_rows, SCHEMA).withColumns({"h": F.lit(1), "spans": F.lit(2)}).repartition(9)
    monkeypatch.setattr(window_dedup, "FAN_IN", 2)
    want = passages(passage_rows)
    assert Counter(tuple(r) for r in window_dedup.digest(table).collect()) == want
    kept = window_dedup.remove_repeats(table).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in kept) == want
    assert window_dedup.digest(empty).count() == 0


def test_a_full_sketch_loses_nothing(spark, passage_rows, monkeypatch):
    monkeypatch.setattr(window_dedup, "sketch_bits", lambda texts: 6)
    table = spark.createDataFrame(passage_rows, SCHEMA)
    assert Counter(tuple(r) for r in window_dedup.digest(table).collect()) == passages(passage_rows)


def test_words_do_not_depend_on_blocks():
    text = b" a bb\tccc " * 30 + b"x" * 300 + b" yy " + b"z" * 64
    want = text.split()
    for size in (64, 100, 1 << 20):
        hashes, own = [], []
        for lo, hi, h in window_dedup.word_blocks(text, size):
            own += text[lo:hi].split()
            hashes += h.tolist()
        assert own == want and len(hashes) == len(want)
        same = {}
        assert all(same.setdefault(w, h) == h for w, h in zip(own, hashes, strict=True))
    long = " ".join(f"w{i % 700}" for i in range(3000)).encode()
    every = {}
    for size in (1 << 20, 900):
        every[size] = sorted((first + s, int(a)) for first, p in window_dedup.parses(long, size)
                             for s, a in enumerate(p.hashes(np.arange(p.sums.size - 35), 35)))
    assert every[900] == every[1 << 20]


# ----------------------------------------------------------------------------- 6, packed texts

def test_texts_parsed_together_are_parsed_alike(monkeypatch):
    import pyarrow as pa

    from salesmart.llm import suffix_dedup as sd
    rng = np.random.default_rng(6)
    texts = [bytes(rng.integers(97, 100, int(n)).astype(np.uint8)) for n in (100, 101, 350, 5000, 100, 2200, 140, 9000)]
    alone = [(i, int(g), int(c), int(lo), int(hi)) for i, x in enumerate(texts)
             for _, p in sd.parses(x) for g, c, lo, hi in zip(p.g, p.c1, p.lo, p.hi, strict=True)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([7] * len(texts)), pa.array(texts, pa.binary())],
                                      names=["doc", "h", "data"])

    def packed():
        for k in sd.packs(iter([rows])):
            at = k.text_of(k.parse.lo)
            yield from zip(k.doc[at].tolist(), k.parse.g.tolist(), k.parse.c1.tolist(),
                           (k.parse.lo - k.starts[at] + k.offset).tolist(), (k.parse.hi - k.starts[at] + k.offset).tolist(), strict=True)

    assert sorted(packed()) == sorted(alone)
    monkeypatch.setattr(sd, "PACK", 3000)  # some texts are longer than a pack, and than a block
    monkeypatch.setattr(sd, "BLOCK", 4000)
    windows = lambda found: sorted((i, g, w) for i, g, _, lo, hi in found for w in range(lo, hi + 1))
    assert windows(packed()) == windows(alone)
    assert [k.ends_text for k in sd.packs(iter([rows]))].count(False) == 3
