"""Repeated 100-byte strings by prefix-free parsing (method 6).

Every byte covered by a ``MATCH``-byte string that also starts earlier (smaller doc_id, or same document
and earlier start) is removed. Texts are parsed by content: the trigger of a window of MATCH bytes is
the leftmost ``GRAM``-byte substring of smallest rolling hash in it. Windows in a row that share their
trigger form a phrase (their union of bytes); equal text gives equal triggers, so copies parse into
equal phrases wherever they stand, and phrases overlap enough that none of their windows is lost.

The dictionary holds each distinct phrase once with the first document that has it; the parse is
each document's sequence of phrases. Triggers are counted first, exactly: one that stands once in the corpus can
repeat nothing, and its phrase leaves dictionary and parse. Order in the corpus is settled on the dictionary: a phrase that
stands earlier as a whole repeats all its windows, however many copies there are. Only phrases that
share a trigger with a different phrase can share some windows: those dictionary entries, at their
first place, are expanded into their windows, whose first places are compared. Phrases and windows are equal if
two 64-bit hashes are, of the trigger and of all bytes.
Instead of one suffix array of the corpus, which would be a sequential object, the sorted order
needed (equal strings together, first place first) comes from grouped minima on these hashes.
Equal strings have equal triggers, so a large corpus is worked through in ranges of triggers, each with all texts:
what is shuffled at once, and the filters that are sent to the workers, are those of ``ROUND`` bytes of text.

Null and empty texts, and texts under MATCH bytes, keep all bytes. Documents with a null doc_id come
last and count as one place. Rows of one doc_id with different texts share their place: neither is
earlier than the other, but each has its own spans, as phrases and spans are kept by doc_id and a hash
of the text. Very long texts are parsed in blocks that overlap by MATCH - 1 bytes.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import BITMAP_BITS, discard, prepare, save
from salesmart.llm.textkernel import INVERSE, mix, powers, prefix_sums

MATCH, GRAM = 100, 40
BLOCK = 1 << 21
#: Above the sizes of phrases, for a run's start and size in one number.
SIZES = 1 << 12
#: Bytes of texts that are parsed together.
PACK = 1 << 19
#: Text bytes whose triggers are looked at in one round.
ROUND = 12 << 30
_LAST = (1 << 63) - 1


class Parse:
    """Phrases of texts that stand one after the other in a buffer: trigger hash g, first and last window, hash c1."""

    def __init__(self, buf: np.ndarray, ends: np.ndarray | None = None):
        """``ends``: where each text ends; windows that reach into the next one are none."""
        self.sums = prefix_sums(buf)
        n = buf.size
        gram = mix((self.sums[GRAM:] - self.sums[:-GRAM]) * powers(INVERSE, n)[: n - GRAM + 1])
        # the smallest hash in each window; its low bits give way to the place, so ties go left
        low = (gram >> np.uint64(24) << np.uint64(24)) | np.arange(gram.size, dtype=np.uint64)
        width, have = MATCH - GRAM + 1, 1
        while have * 2 <= width:
            low = np.minimum(low[: low.size - have], low[have:])
            have *= 2
        rest = width - have
        if rest:
            low = np.minimum(low[: low.size - rest], low[rest:])
        inside = np.arange(low.size)
        if ends is not None and ends.size > 1:
            over = np.zeros(low.size + 1, dtype=np.int64)
            np.add.at(over, np.maximum(ends[:-1] - MATCH + 1, 0), 1)
            np.add.at(over, ends[:-1], -1)
            inside = np.flatnonzero(np.cumsum(over)[:-1] == 0)
        at = (low[inside] & np.uint64((1 << 24) - 1)).astype(np.int64)
        cut = np.flatnonzero(np.diff(at))
        self.lo = inside[np.concatenate([[0], cut + 1])]
        self.hi = inside[np.concatenate([cut, [at.size - 1]])]
        self.g = gram[at[np.concatenate([[0], cut + 1])]]

    @cached_property
    def c1(self) -> np.ndarray:
        return self.hashes(self.lo, self.hi + MATCH)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hash of the bytes start..end."""
        top = int(start.max()) if start.size else 0
        return mix((self.sums[end] - self.sums[start]) * powers(INVERSE, top)[start] + (end - start).astype(np.uint64))


def parses(data: bytes | None) -> Iterator[tuple[int, Parse]]:
    """(offset, parse) of each block of a text; blocks overlap so that every window is in one."""
    n = len(data) if data else 0
    for at in range(0, max(n - MATCH + 1, 0), BLOCK):
        yield at, Parse(np.frombuffer(data[at: at + BLOCK + MATCH - 1], dtype=np.uint8))


class Pack(NamedTuple):
    """A parse of many texts, or of one block of a long one: their doc, h and start in the buffer, the block's offset."""
    parse: Parse
    doc: np.ndarray
    h: np.ndarray
    starts: np.ndarray
    offset: int
    ends_text: bool  # no more blocks of the last text follow

    def text_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, place, side="right") - 1


def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[Pack]:
    """(doc, h, data) rows, texts of MATCH bytes or more, packed by about PACK bytes."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def pack() -> Pack:
        doc, h, data = zip(*held, strict=True)
        ends = np.cumsum([len(x) for x in data])
        parse = Parse(np.frombuffer(b"".join(data), dtype=np.uint8), ends)
        return Pack(parse, np.array(doc), np.array(h), np.concatenate([[0], ends[:-1]]), 0, True)

    for batch in batches:
        for doc, h, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if len(data) > PACK:
                last = (len(data) - MATCH) // BLOCK * BLOCK
                for at, p in parses(data):
                    yield Pack(p, np.array([doc]), np.array([h]), np.zeros(1, dtype=np.int64), at, at == last)
                continue
            held.append((doc, h, data))
            size += len(data)
            if size > PACK:
                yield pack()
                held, size = [], 0
    if held:
        yield pack()


def _repeats(*keys: np.ndarray) -> np.ndarray:
    """Which places have the keys of an earlier one."""
    order = np.lexsort(keys[::-1])
    same = np.ones(max(order.size - 1, 0), dtype=bool)
    for k in keys:
        same &= k[order[1:]] == k[order[:-1]]
    out = np.zeros(order.size, dtype=bool)
    out[order[1:][same]] = True  # lexsort is stable: the first of equal ones comes first
    return out


def _in_round(g: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    return (g >> np.uint64(40)) % np.uint64(rounds) == np.uint64(turn)


def _has(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the filter: all of a key's bits are in one word (see :func:`_filter`)."""
    word = (keys & np.uint64(bitmap.size * 64 - 1)) >> np.uint64(6)
    bits = np.zeros(keys.size, dtype=np.uint64)
    for at in _PLACES:
        bits |= np.uint64(1) << (keys >> np.uint64(at) & np.uint64(63))
    return bitmap.view(np.uint64)[word.astype(np.int64)] & bits == bits


#: Where in a hash the places of its bits in a word stand.
_PLACES = (32, 38, 44, 50)


def _bits(n: int) -> int:
    """Bits of a filter for n hashes: 16 or more for each, by powers of two from BITMAP_BITS to 2**29 (64 MB).

    About one hash in a hundred passes by chance; what passes is grouped exactly.
    """
    return min(max(1 << (16 * n).bit_length(), BITMAP_BITS), 1 << 29)


def _filter(df: DataFrame, col: str) -> np.ndarray:
    """Membership filter of hashes: four bits for each, in one word of 64 by its low bits."""
    bits = _bits(df.count())
    places = " | ".join(f"shiftleft(1L, cast(shiftrightunsigned({col}, {at}) & 63 as int))" for at in _PLACES)
    words = (df.select(F.shiftrightunsigned(F.col(col).bitwiseAND(F.lit(bits - 1)), 6).alias("w"), F.expr(places).alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    out = np.zeros(bits // 64, dtype=np.int64)
    for batch in words.toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _batches(names: list[str], parts: Iterator[list[np.ndarray]], rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``rows`` rows from many small groups of columns."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += part[0].size
        if n >= rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=names)
            held, n = [], 0
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=names)


def _text_hash() -> Column:
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.xxhash64(text, F.length(text))


def _span(start: Column, size: Column) -> Column:
    """Start and size of a run in one number; no phrase is longer than twice MATCH."""
    return (start * SIZES + size).alias("span")


def _key(c1: np.ndarray, doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One hash of a phrase and the text that owns it (as in SQL: c1 ^ doc ^ h)."""
    return c1 ^ doc ^ h


def repeated(docs: DataFrame) -> DataFrame:
    """doc, h, spans: for each text with removed bytes its removed runs (array of :func:`_span`), unmerged."""
    texts = docs.select(F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), _text_hash().alias("h"),
                        F.col("text").cast("binary").alias("data"))
    texts = texts.where(F.length("data") >= MATCH)
    # phrases of one text; where several texts share the first place, each owns those that it holds
    several = save(texts.groupBy("doc").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo < hi")
                   .select("doc"), "phrase-several")
    rounds = -(-(texts.agg(F.sum(F.length("data"))).first()[0] or 1) // ROUND)
    found = [part for turn in range(rounds) for part in _round(texts, several, turn, rounds)]
    rows = found[0]
    for part in found[1:]:
        rows = rows.unionByName(part)
    # a text's spans are bounded by its length; rows that repeat it find the same ones
    spans = save(rows.groupBy("doc", "h").agg(F.collect_set("span").alias("spans")), "phrase-spans")
    discard(several, *found)
    return spans


def _round(texts: DataFrame, several: DataFrame, turn: int, rounds: int) -> tuple[DataFrame, DataFrame]:
    """doc, h, span: the removed phrases, and the removed windows of other phrases, under the triggers of one round."""
    spark = texts.sparkSession

    def triggers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Triggers of a pack, each twice if it stands there more than once."""

        def rows() -> Iterator[list[np.ndarray]]:
            for k in packs(batches):
                g, n = np.unique(k.parse.g[_in_round(k.parse.g, turn, rounds)], return_counts=True)
                yield [_signed(np.concatenate([g, g[n > 1]]))]

        yield from _batches(["g"], rows())

    # most triggers stand once: windows under them stand nowhere else
    counted = save(texts.mapInArrow(triggers, "g long").groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g"),
                   "trigger-repeated")
    often = spark.sparkContext.broadcast(_filter(counted, "g"))
    discard(counted)

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The parse without phrases whose trigger stands once; marked if the text has the phrase before."""

        def rows() -> Iterator[list[np.ndarray]]:
            seen = np.empty(0, dtype=np.uint64)
            for k in packs(batches):
                p = k.parse
                own = np.flatnonzero(_in_round(p.g, turn, rounds) & _has(often.value, p.g))
                text, c1 = k.text_of(p.lo[own]), p.c1[own]
                again = _repeats(text, c1) | np.isin(c1, seen)
                seen = seen[:0] if k.ends_text else np.union1d(seen, c1)
                move = k.offset - k.starts[text]
                yield [_signed(p.g[own]), _signed(c1), k.doc[text], k.h[text], p.lo[own] + move, p.hi[own] + move + MATCH, again]

        yield from _batches(["g", "c1", "doc", "h", "s", "e", "again"], rows())

    parse = save(texts.mapInArrow(phrases, "g long, c1 long, doc long, h long, s long, e long, again boolean"), "phrase-parse")
    often.destroy()
    # the dictionary: each such phrase, its first document and whether others have it
    once = parse.where("not again")
    entries = save(once.groupBy("g", "c1").agg(F.min(F.struct("doc", "h")).alias("own"), F.max("doc").alias("last"))
                   .select("g", "c1", F.col("own.doc").alias("first"), F.col("own.h").alias("h"), "last"),
                   "phrase-dictionary")
    common = save(entries.where("last > first").select("g", "c1", "first"), "phrase-common")
    mixed = entries.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g")
    partial = save(entries.join(mixed, "g").select("g", "c1", "first", "h"), "phrase-partial")
    discard(entries)
    owners = partial.select("c1", F.col("first").alias("doc"), "h")
    if not several.isEmpty():
        own = once.join(several, "doc", "left_semi").select("g", "c1", "doc", "h")
        owners = owners.unionByName(own.join(partial.select("g", "c1", "first"), ["g", "c1"]).where("doc = first")
                                    .select("c1", "doc", "h"))
    keys = save(owners.select(F.col("c1").bitwiseXOR(F.col("doc")).bitwiseXOR(F.col("h")).alias("k")), "phrase-owners")
    # a key too many in the filter only compares more windows
    owned = spark.sparkContext.broadcast(_filter(keys, "k"))
    discard(partial, keys)
    phrase = _span(F.col("s"), F.col("e") - F.col("s"))
    whole = save(once.join(common, ["g", "c1"]).where("first < doc").select("doc", "h", phrase)
                 .unionByName(parse.where("again").select("doc", "h", phrase)), "phrase-whole")
    discard(common, parse)

    def windows(repeated_hashes=None):
        """mapInArrow function: windows of the phrases that a text owns; all hashes, or the places of those in a bitmap.

        A place whose string stands earlier in the same document is marked.
        """

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
            done = np.empty(0, dtype=np.uint64)
            kept: list[tuple[np.ndarray, ...]] = []  # places in the texts of a pack, at most their length
            for k in packs(batches):
                p = k.parse
                own = np.flatnonzero(_in_round(p.g, turn, rounds))
                text = k.text_of(p.lo[own])
                own = own[_has(owned.value, _key(_signed(p.c1[own]), k.doc[text], k.h[text]).view(np.uint64))]
                own = own[~(_repeats(k.text_of(p.lo[own]), p.c1[own]) | np.isin(p.c1[own], done))]
                done = done[:0] if k.ends_text else np.union1d(done, p.c1[own])
                for i in range(0, own.size, 20_000):
                    r = own[i: i + 20_000]
                    size = (p.hi - p.lo + 1)[r]
                    start = np.repeat(p.lo[r] - np.cumsum(size) + size, size) + np.arange(size.sum())
                    a = p.hashes(start, start + MATCH)
                    if repeated_hashes is None:
                        yield [_signed(a)]
                    else:
                        hit = np.flatnonzero(_has(repeated_hashes.value, a))
                        at = k.text_of(start[hit])
                        kept.append((at, k.doc[at], k.h[at], start[hit] + k.offset - k.starts[at], _signed(a[hit]),
                                     _signed(np.repeat(p.g[r], size)[hit])))
                if kept and k.ends_text:
                    order = np.argsort(np.concatenate([x[3] for x in kept]), kind="stable")
                    at, doc, h, start, a, g = (np.concatenate(x)[order] for x in zip(*kept, strict=True))
                    kept.clear()
                    yield [doc, h, start, a, g, _repeats(at, a, g)]

        names = ["a"] if repeated_hashes is None else ["doc", "h", "s", "a", "g", "again"]
        return lambda batches: _batches(names, rows(batches))

    # most windows stand once: their hashes are counted first, places are only kept of the others
    twice = save(texts.mapInArrow(windows(), "a long").groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
                 .select("a"), "window-repeated")
    often_windows = spark.sparkContext.broadcast(_filter(twice, "a"))
    discard(twice)
    placed = save(texts.mapInArrow(windows(often_windows), "doc long, h long, s long, a long, g long, again boolean"),
                  "phrase-windows")
    owned.destroy()
    often_windows.destroy()
    single = placed.where("not again").select("doc", "h", "s", "a", "g")
    # one step at a time, so that the shuffled rows of one are gone before the next
    earliest = save(single.groupBy("a", "g").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
                    .where("last > first").select("a", "g", "first"), "window-earliest")
    window = _span(F.col("s"), F.lit(MATCH))
    later = save(single.join(earliest, ["a", "g"]).where("doc > first").select("doc", "h", window)
                 .unionByName(placed.where("again").select("doc", "h", window)), "window-later")
    discard(placed, earliest)
    return whole, later


def _merged(start: np.ndarray, end: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Maximal runs that the spans cover in a text of n bytes."""
    order = np.argsort(start)
    start, end = start[order], np.minimum(np.maximum.accumulate(end[order]), n)
    start, end = start[start < n], end[start < n]
    if not start.size:
        return []
    new = np.concatenate([[True], start[1:] > end[:-1]])
    return list(zip(start[new].tolist(), end[np.concatenate([new[1:], [True]])].tolist(), strict=True))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row for each row of ``docs``."""
    prepare(docs.sparkSession)
    spans = repeated(docs)
    place = F.coalesce("doc_id", F.lit(_LAST))
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"), place.alias("place"),
                       _text_hash().alias("row_h"))
    full = rows.join(spans, (rows["place"] == spans["doc"]) & (rows["row_h"] == spans["h"]), "left").select("doc_id", "data", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            own = batch.column(2)
            coded = own.values.to_numpy(zero_copy_only=False).astype(np.int64)
            own_start, own_end = coded // SIZES, coded // SIZES + coded % SIZES
            places = zip(batch.column(1).to_pylist(), own.is_valid().to_pylist(), own.offsets.to_pylist(),
                         own.offsets.to_pylist()[1:])
            for data, has, i, j in places:
                runs = _merged(own_start[i:j], own_end[i:j], len(data)) if has else []
                digest, at = hashlib.sha256(), 0
                for s, e in runs:
                    digest.update(data[at:s])
                    at = e
                digest.update(data[at:])
                out.append((len(data), sum(e - s for s, e in runs), len(runs), digest.hexdigest()))
            n, removed, count, sha = ([r[i] for r in out] for i in range(4))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()),
                 pa.array(sha, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return full.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


#: DuckDB SQL of the query's rows: every 100-byte string of every text.
REPEATS_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents),
-- 100-byte strings by their place; long texts are first cut into overlapping blocks
blocks AS (SELECT doc_id, b, substring(h, 2 * b + 1, 2 * (1024 + 99)) AS h
           FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2, 1024)) AS b FROM d)),
g AS MATERIALIZED (SELECT doc_id, b + i AS p, md5_number(substring(h, 2 * i + 1, 200)) AS s
      FROM (SELECT doc_id, b, h, unnest(range(0, least(1024, length(h) // 2 - 99))) AS i FROM blocks)),
f AS (SELECT s, MIN((doc_id, p)) AS first FROM g GROUP BY s HAVING COUNT(*) > 1),
c AS (SELECT doc_id, p FROM g JOIN f USING (s) WHERE (doc_id, p) > first),
e AS (SELECT doc_id, p, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 1 ELSE 0 END AS gap FROM c),
runs AS (SELECT doc_id, k, MIN(p) AS lo, MAX(p) + 100 AS hi
         FROM (SELECT *, SUM(gap) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM e) GROUP BY doc_id, k),
kept AS (SELECT doc_id, lo, hi, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY lo) AS before FROM runs),
t AS (SELECT doc_id, SUM(hi - lo) AS n_removed, COUNT(*) AS n_spans, MAX(hi) AS last,
             list((before, lo) ORDER BY lo) AS parts FROM kept GROUP BY doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(array_to_string(list_transform(parts, lambda x: substring(h, 2 * x[1] + 1, 2 * (x[2] - x[1]))), '')
                    || substring(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN t ON t.doc_id = d.doc_id"""
