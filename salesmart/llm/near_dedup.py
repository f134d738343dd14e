"""Near-duplicate documents with SetSketch registers (method 7).

A document's set is its distinct 5-word shingles (A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``).
Its sketch has ``REGISTERS`` exponentially spaced, truncated minima (Ertl's SetSketch): register i
is ``floor(1 - log_b(min_e x_i(e)))`` with x_i exponentially distributed. Equal registers witness a
shared minimum, so bands of registers are the locality-sensitive keys. A candidate pair is first
judged by the joint likelihood of its registers given both exact set sizes (only pairs five sigmas
below the limit go), then confirmed on the full shingle sets of both texts.

The limit is an argument: ``SIMILARITY`` (85/100) for the query, ``STAGE_SIMILARITY`` (80/100) for the
pipeline's stage. A lower limit takes more registers, so that a pair right at the limit shares no
band with a probability of at most ``MISS``.

No group is expanded into all its pairs. Documents of equal sets form a class with one
representative. In each bucket every member is first compared with the bucket's smallest member;
what that links becomes components. Members of buckets that still hold several components go
through an exact prefix filter on their shingles (rare ones first), which pairs only members of
different components, so that no link between different texts inside a bucket is lost.

Null or empty texts, and texts without words, have an empty set and link with nothing. Rows with
a null doc_id take no part: their component is null and they are kept. Rows that repeat a doc_id
share its component. Extra columns are ignored by :func:`components`, and kept by
:func:`drop_near_duplicates`. Very long texts are hashed in blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import bitmap_of, connected_components, maybe_in, prepare, save
from salesmart.llm.textkernel import mix, shingle_set

BAND, MISS = 4, 1e-5
BASE, RATE = 1.001, 20.0
SIMILARITY = (85, 100)
STAGE_SIMILARITY = (80, 100)


def n_registers(similarity: tuple[int, int]) -> int:
    """As many as miss a pair at the limit in all bands with a probability of at most MISS."""
    num, den = similarity
    return BAND * ceil(log(MISS) / log(1 - (num / den) ** BAND))


REGISTERS = n_registers(SIMILARITY)
_MOST = 1000
_SEED = mix(np.arange(1, 1 + _MOST, dtype=np.uint64))
_ODD = mix(np.arange(1001, 1001 + _MOST, dtype=np.uint64)) | np.uint64(1)
_KEY = mix(np.arange(5001, 5001 + _MOST, dtype=np.uint64)) | np.uint64(1)
_STEP = 4096

SKETCH = "doc_id long, n_shingles long, f1 long, f2 long, reg binary, bands array<long>"


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def registers(items: np.ndarray, count: int = REGISTERS) -> np.ndarray:
    """SetSketch of a set of 64-bit hashes; sketches of parts merge by element-wise maximum."""
    low = np.full(count, np.uint64(2**64 - 1))
    for i in range(0, items.size, _STEP):
        part = (items[i: i + _STEP][None, :] ^ _SEED[:count, None]) * _ODD[:count, None]
        part ^= part >> np.uint64(32)
        part *= np.uint64(0xD6E8FEB86659FD93)
        low = np.minimum(low, part.min(axis=1))
    x = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, 65535).astype(np.uint16)


def bands_of(reg: np.ndarray) -> np.ndarray:
    """One key for each band of ``BAND`` registers."""
    part = (reg.astype(np.uint64) + np.uint64(1)) * _KEY[:reg.size]
    return mix(part.reshape(-1, BAND).sum(axis=1, dtype=np.uint64) + np.arange(reg.size // BAND, dtype=np.uint64))


def _sketch(count: int) -> Batches:
    return lambda batches: _sketched(batches, count)


def _sketched(batches: Iterator[pa.RecordBatch], count: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()),
                        ("reg", pa.binary()), ("bands", pa.list_(pa.int64()))])
    for batch in batches:
        n, f1, f2, regs, bands = [], [], [], [], []
        for data in batch.column(1).to_pylist():
            items = shingle_set(data)
            n.append(items.size)
            f1.append(int(mix(items).sum(dtype=np.uint64).view(np.int64)))
            f2.append(int(mix(items ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
            reg = registers(items, count) if items.size else None
            regs.append(None if reg is None else reg.tobytes())
            bands.append([] if reg is None else bands_of(reg).view(np.int64).tolist())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(f1, pa.int64()),
                                          pa.array(f2, pa.int64()), pa.array(regs, pa.binary()),
                                          pa.array(bands, pa.list_(pa.int64()))], schema=schema)


def _likely(similarity: tuple[int, int]) -> Batches:
    return lambda batches: _likely_pairs(batches, similarity)


def _likely_pairs(batches: Iterator[pa.RecordBatch], similarity: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Pairs whose registers do not speak against the similarity (log-likelihood ratio under 12.5)."""
    num, den = similarity
    limit, count = num / den, n_registers(similarity)
    grid = np.linspace(0.0, 1.0, 101)[None, :]

    def share(x):
        return -np.log(np.maximum(1 - np.clip(x, 1e-9, 1) * (BASE - 1) / BASE, 1e-300)) / np.log(BASE)

    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, count)
                for c in ("reg_a", "reg_b"))
        na, nb = (batch.column(c).to_numpy().astype(float)[:, None] for c in ("n_a", "n_b"))
        up, down = ((a > b).sum(1), (a < b).sum(1))
        same = count - up - down
        u, v = na / (na + nb), nb / (na + nb)
        j = np.minimum(grid, np.minimum(u / v, v / u))
        p, q = share(u - v * j), share(v - u * j)
        log = (up[:, None] * np.log(p) + down[:, None] * np.log(q)
               + same[:, None] * np.log(np.maximum(1 - p - q, 1e-9)))
        best = log.max(1)
        above = np.where(j >= limit - 1e-9, log, -np.inf).max(1)
        yield batch.filter(pa.array(best - above <= 12.5)).select(["a", "b"])


def _confirm(similarity: tuple[int, int]) -> Batches:
    return lambda batches: _confirmed(batches, similarity)


def _confirmed(batches: Iterator[pa.RecordBatch], similarity: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Pairs with den * intersection >= num * union on the full sets."""
    num, den = similarity
    for batch in batches:
        keep, last, own = [], None, None
        for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True):
            if x != last:
                last, own = x, shingle_set(x)
            other = shingle_set(y)
            both = np.intersect1d(own, other, assume_unique=True).size
            keep.append(den * both >= num * (own.size + other.size - both) and both > 0)
        yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])


def _verified(pairs: DataFrame, reps: DataFrame, texts: DataFrame, similarity: tuple[int, int], name: str) -> DataFrame:
    """Candidate pairs (a, b) -> those confirmed."""
    num, den = similarity
    side = lambda s: reps.select(F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), F.col("reg").alias(f"reg_{s}"))
    sized = (pairs.join(side("a"), "a").join(side("b"), "b")
             .where(f"{den} * least(n_a, n_b) >= {num} * greatest(n_a, n_b)"))
    likely = save(sized.mapInArrow(_likely(similarity), "a long, b long"), f"{name}-likely")
    wanted = likely.select(F.explode(F.array("a", "b")).alias("doc_id"))
    found = maybe_in(texts, "doc_id", bitmap_of(wanted, "doc_id"))
    text = lambda s: found.select(F.col("doc_id").alias(s), F.col("data").alias(f"text_{s}"))
    full = likely.join(text("a"), "a").join(text("b"), "b")
    return save(full.mapInArrow(_confirm(similarity), "a long, b long").distinct(), f"{name}-links")


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, c, text) -> one row for each shingle of the set."""
    for batch in batches:
        for rep, c, data in zip(*(col.to_pylist() for col in batch.columns), strict=True):
            items = shingle_set(data)
            for i in range(0, items.size, _STEP):
                h = items[i: i + _STEP].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(h.size, x)) for x in (rep, c, items.size)] + [pa.array(h)],
                    names=["rep", "c", "n", "h"])


def _prefix_pairs(involved: DataFrame, texts: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs of different components that may reach the similarity, by an exact prefix filter.

    Shingles are ordered from rare to frequent. Two sets that reach the similarity share one of their
    first ``n - ceil(similarity * n) + 1`` shingles, at positions that leave room for enough common ones.
    Members of a large bucket that are merely alike differ in their rare shingles and form no pair.
    """
    num, den = similarity
    found = maybe_in(texts, "doc_id", bitmap_of(involved, "rep"))
    items = save(found.join(involved, found["doc_id"] == involved["rep"]).select("rep", "c", "data")
                 .mapInArrow(_items, "rep long, c long, n long, h long").distinct(), "near-items")
    often = items.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    ranked = (items.join(often, "h")
              .withColumn("r", F.expr("row_number() over (partition by rep order by df, h)"))
              .withColumn("shared", F.expr("count(*) over (partition by rep)"))
              .withColumn("r", F.expr("n - shared + r")))
    prefix = save(ranked.where(f"r <= n - ceil({num} * n / {den}) + 1").select("h", "rep", "c", "n", "r"),
                  "near-prefix")
    other = prefix.select("h", *[F.col(x).alias(f"{x}_b") for x in ("rep", "c", "n", "r")])
    room = f"{num + den} * (1 + least(n - r, n_b - r_b)) >= {num} * (n + n_b)"
    return (prefix.join(other, "h").where(f"rep < rep_b and c <> c_b and {room}")
            .select(F.col("rep").alias("a"), F.col("rep_b").alias("b")).distinct())


def components(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row for each row of ``docs``."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("data"))
    sketch = save(texts.mapInArrow(_sketch(n_registers(similarity)), SKETCH), "near-sketch")
    reps = save(sketch.where("n_shingles > 0 and doc_id is not null")
                .groupBy(F.col("n_shingles").alias("n"), "f1", "f2", "reg", "bands")
                .agg(F.min("doc_id").alias("rep")), "near-reps")
    rows = reps.select("rep", F.explode("bands").alias("key"))
    pivots = rows.groupBy("key").agg(F.min("rep").alias("p"), F.count("*").alias("k")).where("k > 1").drop("k")
    buckets = save(rows.join(pivots, "key"), "near-buckets")
    first = _verified(buckets.where("rep <> p").select(F.col("p").alias("a"), F.col("rep").alias("b")).distinct(),
                      reps, texts, similarity, "near-1")
    label = connected_components(first, "near-1")
    named = (buckets.join(label.select(F.col("node").alias("rep"), F.col("comp").alias("c")), "rep", "left")
             .join(label.select(F.col("node").alias("p"), F.col("comp").alias("pc")), "p", "left")
             .select("key", "rep", F.coalesce("c", "rep").alias("c"), F.coalesce("pc", "p").alias("pc")))
    mixed = named.where("c <> pc").select("key").distinct()
    involved = save(named.join(mixed, "key", "left_semi").select("rep", "c").distinct(), "near-open")
    rest = _prefix_pairs(involved, texts, similarity)
    second = _verified(rest, reps, texts, similarity, "near-2")
    comps = connected_components(first.unionByName(second), "near-2")
    classes = (reps.join(comps, reps["rep"] == comps["node"], "left")
               .select(F.col("n").alias("n_shingles"), "f1", "f2", F.coalesce("comp", "rep").alias("comp")))
    out = (sketch.select("doc_id", "n_shingles", "f1", "f2").join(classes, ["n_shingles", "f1", "f2"], "left")
           .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """The documents of ``docs`` (all columns), one of each group: the one with the smallest doc_id.

    A row that repeats a kept doc_id with the same text goes too; rows with a null doc_id stay.
    """
    gone = components(docs, similarity).where("not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    kept = docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
    return _first_rows(kept)


def _first_rows(docs: DataFrame) -> DataFrame:
    """Repeated rows of one doc_id collapse to one; checked first, as ids are unique as a rule."""
    repeated = (docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1"))
    repeated = save(repeated.select("doc_id"), "near-repeated")
    if repeated.isEmpty():
        return docs
    again = docs.join(repeated, "doc_id", "left_semi")
    single = again.groupBy("doc_id", "text").agg(
        *[F.first(c).alias(c) for c in docs.columns if c not in ("doc_id", "text")]).select(*docs.columns)
    return docs.join(repeated, "doc_id", "left_anti").unionByName(single)


#: DuckDB SQL of the query's rows: all pairs that share a shingle, on full sets.
COMPONENTS_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
l AS MATERIALIZED (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS k FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id
                        GROUP BY ALL) p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * k >= 85 * (na.n + nb.n - k)),
r AS (SELECT doc_id AS a, doc_id AS c FROM documents WHERE doc_id IS NOT NULL
      UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.a WHERE r.c < l.b),
m AS (SELECT a, MIN(c) AS c FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, coalesce(d.doc_id = m.c, true) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.a = d.doc_id"""
