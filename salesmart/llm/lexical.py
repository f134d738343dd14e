"""Ranked lexical search for every benchmark item, by norm buckets and exact integer scores (method 12).

A document's impact vector has, for each term of the items, weight * saturated frequency; an item is the set of
its terms, so a score is the sum of a vector's entries at them. Vectors are ordered by length (Euclidean norm over
the items' terms) and scored in buckets of that order, the longest first. By Cauchy-Schwarz no document of a bucket
scores above sqrt(terms) * longest norm: below the item's 50th best score so far, the bucket is passed over. Inside,
the entries at the item's ``FOCUS`` heaviest terms and the norm of the rest bound each document again, and what
survives is scored in 64-bit integers. The longest ``HEAD`` vectors, or more, are scored first; their 50th best
scores start the search of all others. Bounds have a margin for rounding, so the ranking is exact.

Items are taken in blocks of about ``ITEM_TERMS`` terms, so that a block's terms and weights can be broadcast;
documents are read once a block. Null or termless documents count for nothing, termless items have no rows. Repeated
documents rows are documents of their own (a null doc_id ranks last among equal scores); repeated benchmark rows are
one item, rows of one item_id with different texts (null: no terms) have a ranking each. Very long texts are read
in pieces. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import discard, prepare, save
from salesmart.llm.textkernel import ALNUM, LOWER

TOP = 50
#: Vectors in a bucket, heaviest terms of an item that bound a vector, vectors scored before all others.
BUCKET, FOCUS, HEAD = 2048, 8, 4096
#: Terms of a block of items, repeats between items included; the block is broadcast.
ITEM_TERMS = 1 << 18
PIECE = 1 << 20
_TABLE = bytes(np.where(ALNUM, LOWER, 32).astype(np.uint8))
_MARGIN = 1 + 1e-9


def terms(data: bytes | None) -> Iterator[list[bytes]]:
    """A text's terms, in pieces: runs of ASCII letters, digits and all beyond ASCII, A-Z lower-cased."""
    rest, n = b"", len(data) if data else 0
    for at in range(0, n, PIECE):
        piece = rest + data[at: at + PIECE].translate(_TABLE)
        cut = len(piece) if at + PIECE >= n else piece.rfind(b" ") + 1
        rest = piece[cut:]
        yield piece[:cut].split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class Block:
    """Items of one block: ids of each one's terms, the heaviest first, and the weight of each term."""

    items: list[np.ndarray]
    weights: np.ndarray

    @classmethod
    def of(cls, items: list[list[int]], weights: np.ndarray) -> Block:
        ids = [np.array(x, dtype=np.int64) for x in items]
        return cls([x[np.argsort(-weights[x], kind="stable")] for x in ids], weights)


def impacts(block: Block, ids: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Entries of impact vectors: weight * saturated frequency, in integers."""
    return block.weights[ids] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


class Search:
    """Best documents of each item among the buckets seen so far, longest vectors first."""

    def __init__(self, block: Block, least: np.ndarray):
        self.block, self.least = block, least.copy()  # the score that a document must reach
        self.root = np.sqrt([x.size for x in block.items])
        none = np.empty(0, dtype=np.int64)
        self.best = [(none, none.astype(bool), none)] * len(block.items)

    def add(self, norm: np.ndarray, doc: np.ndarray, null: np.ndarray, row: np.ndarray, ids: np.ndarray,
            value: np.ndarray) -> None:
        """One bucket: norms falling; entries (row of the bucket, term, value)."""
        order = np.argsort(ids, kind="stable")
        ids, row, value = ids[order], row[order], value[order]
        at = np.searchsorted(ids, np.arange(self.block.weights.size + 1))
        for q in np.flatnonzero(self.root * norm[0] * _MARGIN >= self.least):
            own, least = self.block.items[q], self.least[q]
            score, square = np.zeros(norm.size, dtype=np.int64), np.zeros(norm.size)
            for t in own[:FOCUS]:
                r, v = row[at[t]: at[t + 1]], value[at[t]: at[t + 1]]
                score[r] += v
                square[r] += v.astype(float) ** 2
            rest = np.sqrt(max(own.size - FOCUS, 0) * np.maximum(norm**2 * _MARGIN - square, 0))
            likely = (score + rest) * _MARGIN >= least
            if not likely.any():
                continue
            for t in own[FOCUS:]:
                score[row[at[t]: at[t + 1]]] += value[at[t]: at[t + 1]]
            hit = np.flatnonzero(likely & (score > 0) & (score >= least))
            if hit.size:
                s, x, d = (np.concatenate(p) for p in zip(self.best[q], (score[hit], null[hit], doc[hit]), strict=True))
                first = np.lexsort((d, x, -s))[:TOP]
                self.best[q] = s[first], x[first], d[first]
                if first.size == TOP:
                    self.least[q] = max(least, int(s[first[-1]]))

    def rows(self) -> Iterator[pa.RecordBatch]:
        for q, (score, null, doc) in enumerate(self.best):
            if score.size:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(score.size, q)), pa.array(doc, mask=null),
                                                  pa.array(score)], names=["item", "doc_id", "score"])


def _items(benchmark: DataFrame) -> DataFrame:
    """item_id, words (distinct terms): one row for each different benchmark row that has terms."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [sorted({t for piece in terms(x) for t in piece}) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.binary()))],
                                             names=["item_id", "words"])

    kind = benchmark.schema["item_id"].dataType.simpleString()
    rows = benchmark.select("item_id", F.col("text").cast("binary").alias("data")).distinct()
    return rows.mapInArrow(split, f"item_id {kind}, words array<binary>").where("size(words) > 0")


def _counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms), ids and tf of the terms in the vocabulary: documents with terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            size, ids, tf = [], [], []
            for data in batch.column(1).to_pylist():
                n, own = 0, Counter()
                for piece in terms(data):
                    n += len(piece)
                    own.update(map(known.get, piece))
                own.pop(None, None)
                size.append(n)
                ids.append(list(own))
                tf.append(list(own.values()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                                              pa.array(tf, pa.list_(pa.int64()))], names=["doc_id", "n", "ids", "tf"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("data"))
            .mapInArrow(count, "doc_id long, n long, ids array<int>, tf array<long>").where("n > 0"))


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _norms(rows: DataFrame, block: Block) -> DataFrame:
    """With ``norm``, the length of the impact vector; vectors of no length go, as they score nothing."""
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lens = batch.column("ids").value_lengths().to_numpy(zero_copy_only=False)
            m = np.repeat(batch.column("m").to_numpy(), lens)
            value = impacts(shared.value, _flat(batch, "ids"), _flat(batch, "tf"), m).astype(float)
            square = np.bincount(np.repeat(np.arange(lens.size), lens), value**2, minlength=lens.size)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.sqrt(square))],
                                             names=[*batch.schema.names, "norm"])

    schema = "doc_id long, m long, ids array<int>, tf array<long>"
    return rows.mapInArrow(measure, f"{schema}, norm double").where("norm > 0")


def _best(vectors: DataFrame, block: Block, least: np.ndarray) -> DataFrame:
    """item, doc_id, score: each partition's best documents of each item that reach ``least``."""
    shared = vectors.sparkSession.sparkContext.broadcast((block, least))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, least = shared.value
        found, held, n = Search(own, least), [], 0

        def bucket() -> None:
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            lens = t.column("ids").value_lengths().to_numpy(zero_copy_only=False)
            ids, row = _flat(t, "ids"), np.repeat(np.arange(lens.size), lens)
            value = impacts(own, ids, _flat(t, "tf"), np.repeat(t.column("m").to_numpy(), lens))
            doc = t.column("doc_id")
            found.add(t.column("norm").to_numpy(), doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False),
                      row, ids, value)

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BUCKET:
                bucket()
                held, n = [], 0
        if n:
            bucket()
        yield from found.rows()

    # equal norms, as of copies, are dealt out by doc_id and by the place in the table
    order = [F.col("norm").desc(), F.col("doc_id"), F.col("place")]
    return (vectors.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*order)
            .sortWithinPartitions(*order).mapInArrow(search, "item long, doc_id long, score long"))


def _ranked(best: DataFrame, by: list[str]) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= TOP)


def _top(best: DataFrame) -> DataFrame:
    """The best of all partitions, in 64 parts of an item first."""
    parts = best.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    return _ranked(_ranked(parts, ["item", "part"]).drop("part", "rank"), ["item"])


def _head(vectors: DataFrame) -> float:
    """Norm from which on there are at least HEAD vectors; lengths are counted in steps of a quarter power of two."""
    steps = (vectors.groupBy(F.floor(4 * F.log2("norm")).alias("step")).agg(F.count("*").alias("n"))
             .orderBy(F.col("step").desc()))
    have = 0
    for step, n in steps.collect():  # at most some hundred steps
        have += n
        if have >= HEAD:
            return 2.0 ** (step / 4)
    return 0.0


def _search_block(docs: DataFrame, items: list[list[bytes]]) -> DataFrame:
    """item (index in ``items``), rank, doc_id, score."""
    vocabulary = {t: i for i, t in enumerate(sorted({t for x in items for t in x}))}
    counts = save(_counts(docs, vocabulary), "lexical-counts")
    n_docs, total = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for t, n in counts.select(F.explode("ids").alias("t")).groupBy("t").count().collect():  # at most the vocabulary
        df[t] = n
    weights = np.array([weight(n_docs, int(x)) if x else 0 for x in df], dtype=np.int64)
    block = Block.of([[vocabulary[t] for t in x] for x in items], weights)
    scaled = counts.select("doc_id", F.expr(f"50 + cast(50 * cast(n as decimal(38, 0)) * {n_docs} div {total or 1} as long)")
                           .alias("m"), "ids", "tf")
    vectors = save(_norms(scaled, block), "lexical-vectors")
    cut = _head(vectors)
    least = np.zeros(len(items), dtype=np.int64)
    head = save(_top(_best(vectors.where(F.col("norm") >= cut), block, least)), "lexical-head")
    for r in head.where(F.col("rank") == TOP).select("item", "score").collect():  # one row an item
        least[r["item"]] = r["score"]
    # below this length no vector reaches any item's score
    floor = float(np.min(least / np.sqrt([len(x) for x in items]))) / _MARGIN
    rest = vectors.where((F.col("norm") < cut) & (F.col("norm") >= floor))
    found = save(_top(head.drop("rank").unionByName(_best(rest, block, least))), "lexical-top")
    discard(counts, vectors, head)
    return found


def search(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """item_id, rank, doc_id, score: the TOP best documents of every item, score above 0."""
    spark = docs.sparkSession
    prepare(spark)
    rows = save(_items(benchmark), "lexical-items")
    total = rows.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = -(-total // ITEM_TERMS)
    kind = benchmark.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for i in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == i).toArrow()
        words = part.column("words").to_pylist()
        if words:
            names = spark.createDataFrame(pa.table({"item": pa.array(range(len(words)), pa.int64()),
                                                    "item_id": part.column("item_id")}), f"item long, item_id {kind}")
            out = out.unionByName(_search_block(docs, words).join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out


#: DuckDB SQL of the query's rows.
SEARCH_SQL = r"""
WITH low AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT r, doc_id, w, len(w) AS n FROM low WHERE len(w) > 0),
c AS (SELECT COUNT(*) AS nd, SUM(n) AS total FROM d),
tf AS (SELECT r, term, COUNT(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
wt AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(nd) + 2 AS DOUBLE) / (2 * COUNT(*) + 1))) AS BIGINT) AS w
       FROM tf, c GROUP BY term),
m AS (SELECT r, doc_id, 50 + CAST(50 * n * nd AS HUGEINT) // CAST(total AS HUGEINT) AS m FROM d, c),
items AS (SELECT row_number() OVER () AS k, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT DISTINCT k, item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM items),
s AS (SELECT k, item_id, r, doc_id, CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM q JOIN wt USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST) AS rank
           FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50"""
