"""Passages repeated anywhere, by a count-min prefilter and exact grouping (method 13).

A window is ``WINDOW`` consecutive words of one text. Every word covered by a window whose words also stand
anywhere else (another text, another row, another place of the same text) is removed; all copies go alike.

First pass: each partition fills a count-min sketch, and the sketches are merged chunk by chunk in a tree of
bounded groups. A window enters under its trigger, the leftmost ``GRAM``-word run of smallest hash in it:
windows with equal words have equal triggers at different places, so a trigger's count is at least the count
of each of its windows, and about eight windows share one entry. The estimate can only be too high.
Second pass: only windows whose trigger is estimated repeated are looked at, as phrases (windows in a row
under one trigger). Phrases are grouped exactly; one that stands twice repeats all its windows. Only triggers
with several different phrases need their windows one by one (third pass), grouped exactly again.

The sketch has about four counters an entry, from 2**20 to 2**26 a row, by the bytes of all texts. Beyond the
largest size it only estimates more windows as repeated; the exact groups are shuffled and lose nothing.
Windows and phrases are compared by two 64-bit hashes (trigger, and all words).

Null and empty texts have no words; texts under WINDOW words keep all. Rows of one doc_id (null too) are
separate texts, so a repeated row of enough words goes with its copies. Very long texts are parsed in blocks
that overlap by WINDOW - 1 words; a word of a megabyte or more counts as one word. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import bitmap_of, discard, prepare, save
from salesmart.llm.textkernel import BASE, INVERSE, NOT_SPACE, hash_words, mix, powers, spans

WINDOW, GRAM = 35, 20
#: Bytes of a text parsed at once.
BLOCK = 1 << 20
#: Rows of the sketch, and log2 of the least and most counters in a row.
DEPTH, LEAST_BITS, MOST_BITS = 2, 20, 26
#: Text bytes for one entry of the sketch, about: (WINDOW - GRAM + 2) / 2 words of six bytes.
BYTES_PER_ENTRY = 51
#: log2 of the counters in a chunk, and partitions whose chunks one group merges.
CHUNK_BITS, FAN_IN = 16, 64
_LAST = (1 << 63) - 1
_ROW = (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_blocks(data: bytes | None, size: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray]]:
    """(start, end, word hashes) of consecutive pieces of a text, cut between words."""
    at, n = 0, len(data) if data else 0
    while at < n:
        end = min(at + size, n)
        buf = np.frombuffer(data, dtype=np.uint8, count=end - at, offset=at)
        if end < n:
            gaps = np.flatnonzero(~NOT_SPACE[buf])
            if gaps.size:
                end = at + int(gaps[-1]) + 1
                buf = buf[: end - at]
            else:
                found = _SPACE.search(data, end)
                end = found.start() if found else n
        if end - at >= size and NOT_SPACE[buf].all():  # one word, however long
            digest = hashlib.blake2b(memoryview(data)[at:end], digest_size=8).digest()
            yield at, end, np.frombuffer(digest, dtype=np.uint64)
        else:
            starts, ends = spans(buf, NOT_SPACE)
            if starts.size:
                yield at, end, hash_words(buf, starts, ends)
        at = end


class Phrases:
    """Runs of windows under one trigger in a sequence of word hashes: trigger g, first and last window, hash c."""

    def __init__(self, words: np.ndarray):
        n = words.size
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(words * powers(BASE, n)[:n], out=self.sums[1:])
        gram = self.hashes(np.arange(n - GRAM + 1), GRAM)
        # the smallest hash in each window; its low bits give way to the place, so ties go left
        low = (gram >> np.uint64(24) << np.uint64(24)) | np.arange(gram.size, dtype=np.uint64)
        width, have = WINDOW - GRAM + 1, 1
        while have * 2 <= width:
            low = np.minimum(low[: low.size - have], low[have:])
            have *= 2
        if width > have:
            low = np.minimum(low[: low.size - (width - have)], low[width - have:])
        at = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
        self.lo = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
        self.hi = np.concatenate([self.lo[1:] - 1, [at.size - 1]])
        self.g = gram[at[self.lo]]
        self.c = self.hashes(self.lo, self.hi - self.lo + WINDOW)

    def hashes(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """Hash of ``size`` words from each start."""
        top = int(start.max()) if start.size else 0
        return mix((self.sums[start + size] - self.sums[start]) * powers(INVERSE, top)[start]
                   + np.asarray(size).astype(np.uint64))


def parses(data: bytes | None, size: int = BLOCK) -> Iterator[tuple[int, Phrases]]:
    """(index of the first word, phrases) of a text's overlapping blocks: every window is in one of them."""
    first, held = 0, np.empty(0, dtype=np.uint64)
    for _, _, words in word_blocks(data, size):
        held = np.concatenate([held, words])
        if held.size >= WINDOW:
            yield first, Phrases(held)
            first += held.size - (WINDOW - 1)
            held = held[-(WINDOW - 1):]


def _slots(g: np.ndarray, row: int, bits: int) -> np.ndarray:
    return ((g * np.uint64(_ROW[row])) >> np.uint64(64 - bits)).astype(np.int64)


def _sketch(bits: int, parse: Callable = parses) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """mapInArrow function: one partition's sketch of the triggers ``g`` that ``parse`` gives of each text,
    as the chunks of it that are not empty.

    A counter stops at two; a chunk is two bit planes, at least one and at least two.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((DEPTH, 1 << bits), dtype=np.uint8)
        held: list[np.ndarray] = []

        def add() -> None:
            keys = np.concatenate(held)
            held.clear()
            for row in range(DEPTH):
                slot, n = np.unique(_slots(keys, row, bits), return_counts=True)
                counts[row, slot] = np.minimum(counts[row, slot] + np.minimum(n, 2), 2)

        for batch in batches:
            for data in batch.column(0).to_pylist():
                for _, p in parse(data):
                    held.append(p.g)
                    if sum(x.size for x in held) > 1 << 18:
                        add()
        if held:
            add()
        part, chunk = TaskContext.get().partitionId(), 1 << min(CHUNK_BITS, bits)
        for row in range(DEPTH):
            for i in range(0, 1 << bits, chunk):
                piece = counts[row, i: i + chunk]
                if piece.any():
                    planes = np.packbits(np.stack([piece >= 1, piece >= 2]), axis=1, bitorder="little")
                    yield pa.RecordBatch.from_pylist([{"row": row, "chunk": i // chunk, "part": part,
                                                       "planes": zlib.compress(planes.tobytes(), 1)}], _CHUNK)

    return fill


_CHUNK = pa.schema([("row", pa.int32()), ("chunk", pa.int64()), ("part", pa.int64()), ("planes", pa.binary())])


def _merge(key: tuple, group: pa.Table) -> pa.Table:
    """Sum of the sketches' counters in one chunk, stopped at two; at most FAN_IN of them come together."""
    once = twice = None
    for planes in group.column("planes").to_pylist():
        a, b = np.frombuffer(zlib.decompress(planes), dtype=np.uint8).reshape(2, -1)
        once, twice = (a, b) if once is None else (once | a, twice | b | (once & a))
    row, chunk, part = (x.as_py() for x in key)
    planes = zlib.compress(np.concatenate([once, twice]).tobytes(), 1)
    return pa.Table.from_pylist([{"row": row, "chunk": chunk, "part": part, "planes": planes}], _CHUNK)


def sketch_bits(texts: DataFrame, bytes_per_entry: int = BYTES_PER_ENTRY) -> int:
    """log2 of the counters in a row of the sketch, by the bytes of all texts."""
    size = texts.agg(F.sum(F.length("data"))).first()[0] or 0
    return min(max((4 * size // bytes_per_entry).bit_length(), LEAST_BITS), MOST_BITS)


def repeated_triggers(texts: DataFrame, bits: int, parse: Callable = parses) -> np.ndarray:
    """The merged sketch as bits (row, slot): estimated at least two. At most DEPTH * 2**MOST_BITS bits."""
    chunks = save(texts.select("data").mapInArrow(_sketch(bits, parse), "row int, chunk long, part long, planes binary"),
                  "window-sketches")
    last = chunks.agg(F.max("part")).first()[0] or 0
    merged = chunks
    while True:  # sketches of FAN_IN partitions at a time, until one is left
        merged = (merged.withColumn("part", F.expr(f"part div {FAN_IN}")).groupBy("row", "chunk", "part")
                  .applyInArrow(_merge, "row int, chunk long, part long, planes binary"))
        last //= FAN_IN
        if not last:
            break
    out = np.zeros((DEPTH, (1 << bits) // 8), dtype=np.uint8)
    size = (1 << min(CHUNK_BITS, bits)) // 8
    for batch in merged.select("row", "chunk", "planes").toArrow().to_batches():
        for row, chunk, planes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            out[row, chunk * size: (chunk + 1) * size] = np.frombuffer(zlib.decompress(planes), dtype=np.uint8)[size:]
    discard(chunks)
    return out


def estimated(sketch: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Which triggers the sketch estimates as repeated."""
    bits = (sketch.shape[1] * 8).bit_length() - 1
    hit = np.ones(g.size, dtype=bool)
    for row in range(DEPTH):
        slot = _slots(g, row, bits)
        hit &= (sketch[row, slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
    return hit


def _in_bitmap(bitmap: np.ndarray, x: np.ndarray) -> np.ndarray:
    slot = (x & np.uint64(bitmap.size * 64 - 1)).astype(np.int64)
    return (bitmap[slot >> 6] >> (slot & 63)) & 1 == 1


def _low_bits(df: DataFrame, col: str, bits: int) -> np.ndarray:
    """Bitmap of the low bits of a hash column, at most ``2**bits / 64`` rows reach the driver."""
    words = (df.select(F.col(col).bitwiseAND(F.lit((1 << bits) - 1)).alias("s"))
             .select(F.shiftrightunsigned("s", 6).alias("w"), F.expr("shiftleft(1L, cast(s & 63 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    out = np.zeros((1 << bits) // 64, dtype=np.int64)
    for batch in words.toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out


def _packed(names: list[str], parts: Iterator[list[np.ndarray]], rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``rows`` rows from many small groups of columns."""
    held, n = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=names)

    for part in parts:
        held.append(part)
        n += part[0].size
        if n >= rows:
            yield batch()
            held, n = [], 0
    if n:
        yield batch()


def _text_hash() -> Column:
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.xxhash64(text, F.length(text))


def repeated(docs: DataFrame) -> DataFrame:
    """doc, h, spans: for each text with removed words the runs of words (array of start, end), unmerged."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), _text_hash().alias("h"),
                        F.col("text").cast("binary").alias("data"))
    # a window has at least WINDOW bytes and as many gaps less one
    texts = texts.where(F.length("data") >= 2 * WINDOW - 1)
    bits = sketch_bits(texts)
    sketch = spark.sparkContext.broadcast(repeated_triggers(texts, bits))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Phrases whose trigger is estimated repeated."""

        def rows() -> Iterator[list[np.ndarray]]:
            for batch in batches:
                for doc, h, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    for first, p in parses(data):
                        own = np.flatnonzero(estimated(sketch.value, p.g))
                        yield [p.g[own].view(np.int64), p.c[own].view(np.int64), np.full(own.size, doc),
                               np.full(own.size, h), p.lo[own] + first, p.hi[own] + first + WINDOW]

        yield from _packed(["g", "c", "doc", "h", "s", "e"], rows())

    places = save(texts.mapInArrow(likely, "g long, c long, doc long, h long, s long, e long"), "window-phrases")
    entries = save(places.groupBy("g", "c").agg(F.count("*").alias("n")), "window-entries")
    mixed = entries.groupBy("g").agg(F.count("*").alias("k")).where("k > 1").select("g")
    partial = save(entries.join(mixed, "g").select("c", "n"), "window-partial")
    whole = places.join(entries.where("n > 1").select("g", "c"), ["g", "c"]).select("doc", "h", "s", "e")
    shared = spark.sparkContext.broadcast(_low_bits(partial, "c", LEAST_BITS + 4))
    alone = spark.sparkContext.broadcast(_low_bits(partial.where("n = 1"), "c", LEAST_BITS + 4))

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows of phrases that share their trigger with a different one; a place only if the phrase stands once."""

        def rows() -> Iterator[list[np.ndarray]]:
            seen: set[int] = set()
            for batch in batches:
                for doc, h, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    for first, p in parses(data):
                        own = np.flatnonzero(estimated(sketch.value, p.g) & _in_bitmap(shared.value, p.c))
                        once = _in_bitmap(alone.value, p.c[own])
                        new = np.array([c not in seen for c in p.c[own].tolist()], dtype=bool)
                        own, once = own[once | new], once[once | new]
                        if len(seen) < 1 << 20:
                            seen.update(p.c[own].tolist())
                        size = (p.hi - p.lo + 1)[own]
                        start = np.repeat(p.lo[own] - np.cumsum(size) + size, size) + np.arange(size.sum())
                        once = np.repeat(once, size)
                        yield [np.repeat(p.g[own], size).view(np.int64), p.hashes(start, WINDOW).view(np.int64),
                               np.repeat(p.c[own], size).view(np.int64), np.full(start.size, doc), np.full(start.size, h),
                               np.where(once, start + first, -1)]

        yield from _packed(["g", "a", "c", "doc", "h", "s"], rows())

    windows = save(texts.mapInArrow(single, "g long, a long, c long, doc long, h long, s long"), "window-single")
    often = save(windows.groupBy("g", "a").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
                 .select("g", "a"), "window-often")
    part = (windows.where("s >= 0").join(often, ["g", "a"])
            .select("doc", "h", "s", (F.col("s") + WINDOW).alias("e")))
    # a text's spans are bounded by its length; rows that repeat it find the same ones
    out = save(whole.unionByName(part).groupBy("doc", "h").agg(F.collect_set(F.struct("s", "e")).alias("spans")),
               "window-spans")
    discard(places, entries, partial, windows, often)
    return out


def _flags(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of n words the spans cover."""
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, end, -1)
    return np.cumsum(step)[:n] > 0


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text (words kept, joined by one space), n_words, n_removed: one row for each row of ``docs``."""
    return _kept(docs, with_text=True)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of the words kept, joined by one space."""
    return _kept(docs, with_text=False)


def _kept(docs: DataFrame, with_text: bool) -> DataFrame:
    prepare(docs.sparkSession)
    found = repeated(docs)
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"),
                       F.coalesce("doc_id", F.lit(_LAST)).alias("place"), _text_hash().alias("row_h"))
    full = (rows.join(found, (rows["place"] == found["doc"]) & (rows["row_h"] == found["h"]), "left")
            .select("doc_id", "data", "spans"))

    def pieces(data: bytes, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
        """(words, words kept) of each block of a text."""
        first = 0
        for lo, hi, hashes in word_blocks(data):
            words, n = data[lo:hi].split(), hashes.size
            if start.size:
                near = (start < first + n) & (end > first)
                gone = _flags(np.maximum(start[near] - first, 0), np.minimum(end[near] - first, n), n)
                words = list(compress(words, ~gone))
            yield n, words
            first += n

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            own = batch.column(2)
            s, e = (own.values.field(i).to_numpy(zero_copy_only=False) for i in range(2))
            for data, has, i, j in zip(batch.column(1).to_pylist(), own.is_valid().to_pylist(),
                                       own.offsets.to_pylist(), own.offsets.to_pylist()[1:]):
                n = kept = 0
                text, sha = [], hashlib.sha256()
                for size, words in pieces(data, s[i:j] if has else s[:0], e[i:j] if has else e[:0]):
                    joined = b" ".join(words)
                    if words:
                        sha.update(b" " + joined if kept else joined)
                        text.append(joined)
                    n, kept = n + size, kept + len(words)
                out.append((n, n - kept, b" ".join(text).decode("utf-8", "replace") if with_text else sha.hexdigest()))
            n, removed, value = ([r[k] for r in out] for k in range(3))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(value, pa.string())],
                names=["doc_id", "n_words", "n_removed", "value"])

    out = full.mapInArrow(cut, "doc_id long, n_words long, n_removed long, value string")
    return out.withColumnRenamed("value", "text" if with_text else "kept_sha256")


#: DuckDB SQL of the query's rows: every window of every text.
WINDOWS_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
-- windows by their place; long texts are first cut into overlapping blocks
blocks AS (SELECT r, b, list_slice(w, b + 1, b + 256 + 34) AS w
           FROM (SELECT r, w, unnest(range(0, len(w), 256)) AS b FROM d)),
g AS MATERIALIZED (SELECT r, b + i AS p, md5_number(array_to_string(list_slice(w, i + 1, i + 35), ' ')) AS s
      FROM (SELECT r, b, w, unnest(range(0, least(256, len(w) - 34))) AS i FROM blocks)),
f AS (SELECT s FROM g GROUP BY s HAVING COUNT(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS q FROM g JOIN f USING (s)),
words AS (SELECT r, unnest(w) AS word, unnest(range(0, len(w))) AS q FROM d),
kept AS (SELECT r, COUNT(*) AS n, string_agg(word, ' ' ORDER BY q) AS t
         FROM words ANTI JOIN gone USING (r, q) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""
