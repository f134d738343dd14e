"""Benchmark decontamination by size-partitioned MinHash containment search (method 5).

Finds short test items inside long documents: an item leaks into a document that contains at least
80 % of the item's distinct 5-word shingles (words: runs of ASCII letters, digits and non-ASCII
bytes, A-Z lower-cased, so that punctuation and line breaks do not hide a copy).

A document's own MinHash would drown a short item: at a Jaccard similarity of 0.005 no affordable
number of minima meets. So the sketch is taken of the item, and its length follows from the
partition its set size falls in (partitions by powers of two, as in LSH Ensemble): a document with
``ceil(0.8 n)`` of an item's n shingles must hold one of any ``n - ceil(0.8 n) + 1`` of them, hence
one of that many smallest hashes. The largest n of a partition gives the sketch length of all its
items, which makes the search complete. Documents are never sketched: each is hashed whole, once,
and a fixed-size bitmap of the items' shingle hashes keeps only rows that may matter. Candidate
pairs are verified by counting the item's shingles, compared as strings, in the document.

Null and empty texts, and items with fewer than five words, are handled as sets: an item of 1 to 4
words is one shingle of its whole sequence and matches only a document that is that sequence; an
item without words matches nothing. Rows with a null doc_id or item_id take no part (such documents
are kept). Repeated rows count once. Extra columns are ignored, and kept by :func:`drop_leaks`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import BITMAP_BITS, prepare, save
from salesmart.llm.textkernel import ALNUM, LOWER, hash_words, shingles, spans

WORDS = 5
CONTAINMENT = (80, 100)

_SCHEMA = "id long, h long, shingle binary"
_ARROW = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("shingle", pa.binary())])


def _shingle_rows(bitmap=None):
    """mapInArrow function: (id, text bytes) -> distinct (id, hash, shingle), those in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, strings = [], [], []
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not data:
                    continue
                buf = LOWER[np.frombuffer(data, dtype=np.uint8)]
                starts, ends = spans(buf, ALNUM)
                h = shingles(hash_words(buf, starts, ends), WORDS)
                if bitmap is not None:
                    slot = (h & np.uint64(BITMAP_BITS - 1)).astype(np.int64)
                    found = np.flatnonzero((bitmap.value[slot >> 6] >> (slot & 63)) & 1)
                else:
                    found = np.arange(h.size)
                seen = set()
                for i in found.tolist():
                    j = min(i + WORDS, starts.size)
                    s = b" ".join(buf[a:b].tobytes() for a, b in zip(starts[i:j], ends[i:j], strict=True))
                    if s not in seen:
                        seen.add(s)
                        ids.append(key)
                        hashes.append(int(h[i].view(np.int64)))
                        strings.append(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(strings, pa.binary())],
                schema=_ARROW)

    return run


def _bitmap(items: DataFrame):
    """Fixed-size bitmap of the shingle hashes (low bits), at most BITMAP_BITS / 64 rows to the driver."""
    slot = F.col("h").bitwiseAND(F.lit(BITMAP_BITS - 1))
    words = (items.select(slot.alias("s"))
             .select(F.shiftrightunsigned("s", 6).alias("w"), F.expr("shiftleft(1L, cast(s & 63 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    out = np.zeros(BITMAP_BITS // 64, dtype=np.int64)
    for batch in words.toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return items.sparkSession.sparkContext.broadcast(out)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_item (the item's shingles), n_shared, containment: every leaked pair."""
    spark = docs.sparkSession
    prepare(spark)
    num, den = CONTAINMENT
    bytes_of = lambda df, key: df.where(f"{key} is not null and text is not null").select(
        key, F.col("text").cast("binary").alias("data"))
    items = (bytes_of(benchmark, "item_id").mapInArrow(_shingle_rows(), _SCHEMA)
             .select(F.col("id").alias("item_id"), "h", "shingle").distinct())
    items = save(items, "leak-items")
    sizes = items.groupBy("item_id").agg(F.count("*").alias("n_item"))
    # sketch length by size partition: what the largest size of the partition needs
    part = F.floor(F.log2("n_item")).cast("int")
    top = F.pow(F.lit(2), part + 1) - 1
    length = F.least(F.col("n_item"), (top - F.ceil(top * num / den) + 1).cast("long"))
    ranked = (items.join(sizes, "item_id").withColumn("length", length)
              .withColumn("r", F.expr("row_number() over (partition by item_id order by h, shingle)")))
    sketch = save(ranked.where("r <= length").select("item_id", "shingle", "n_item"), "leak-sketch")
    hits = (bytes_of(docs, "doc_id").mapInArrow(_shingle_rows(_bitmap(items)), _SCHEMA)
            .select(F.col("id").alias("doc_id"), "shingle"))
    hits = save(hits.join(items.select("shingle").distinct(), "shingle", "left_semi").distinct(), "leak-hits")
    pairs = hits.join(sketch, "shingle").select("doc_id", "item_id", "n_item").distinct()
    shared = (pairs.join(items.select("item_id", "shingle"), "item_id")
              .join(hits, ["doc_id", "shingle"])
              .groupBy("doc_id", "item_id", "n_item").agg(F.count("*").alias("n_shared")))
    return (shared.where(F.col("n_shared") * den >= F.col("n_item") * num)
            .select("doc_id", "item_id", "n_item", "n_shared",
                    F.round(F.col("n_shared") / F.col("n_item"), 6).alias("containment")))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents of ``docs`` (all columns) into which no item leaks; null doc_ids stay."""
    bad = leaks(docs, benchmark).select(F.col("doc_id").alias("leak_id")).distinct()
    return docs.join(bad, docs["doc_id"] == bad["leak_id"], "left_anti")


def sketch_length(n: int) -> int:
    """Sketch length of an item with n shingles (the rule of :func:`leaks`, for tests)."""
    num, den = CONTAINMENT
    top = 2 ** (int(math.log2(n)) + 1) - 1
    return min(n, top - math.ceil(top * num / den) + 1)


#: DuckDB SQL of the query's rows: all shared shingles, as strings.
LEAKS_SQL = r"""
WITH d AS (SELECT DISTINCT doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w
           FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
b AS (SELECT DISTINCT item_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w
      FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
ds AS (SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
bs AS (SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT id, COUNT(*) AS n_item FROM bs GROUP BY id),
j AS (SELECT ds.id AS doc_id, bs.id AS item_id, COUNT(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_shared, round(n_shared / n_item, 6) AS containment
FROM j JOIN n ON n.id = j.item_id WHERE n_shared * 100 >= n_item * 80"""
