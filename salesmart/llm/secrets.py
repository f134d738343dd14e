"""Secret scans with multipart credential linking (method 2, DataFrame functions only).

Base findings, leftmost and non-overlapping per kind: assignments of a value of 6 or more characters
to a password-like name (``assign``), access identifiers (``access``), long hexadecimal runs (``hex``).

Multipart linking adds weak candidates: opaque strings without a tell-tale name (``opaque``), key or
user identifiers (``ident``) and endpoints (``endpoint``). Alone they mean nothing. Parts belong to
a class (identifier: access, ident; secret: assign, hex, opaque; endpoint: endpoint). Identifier and
secret are complementary: an identifier or opaque string is reported if a part of the other class,
which does not overlap it, is near; no endpoint is needed. A candidate that a base finding covers is
reported already; it is listed again only if parts of both other classes are near. An endpoint is
complementary to a pair only: it is reported if an identifier and a secret are near.
Near is a gap of at most ``SCOPE`` code points between the end of one span and the start of the other,
or starts that are no farther apart. The interval join keys parts by document and bin of SCOPE code
points, once by their start and once by their end, and meets the bins around a candidate's start and end;
a bin is first reduced to the smallest and largest start and end of each class, which decides the test
exactly and keeps the join from making pairs. Base findings always stay.

Null texts count as empty; a document without findings has empty lists. Rows that repeat a doc_id are
told apart by their text; a repeated row gets the same result. Extra columns are ignored. Positions are code
points, the end is exclusive; spans are ``kind:start:end`` by start, then kind as listed in KINDS.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import prepare, save

SCOPE = 300
#: kind: (pattern, group whose length counts, least length, class)
BASE = {
    "assign": (r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, "secret"),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20, "identifier"),
    "hex": (r"[0-9a-f]{24,}", 0, 24, "secret"),
}
WEAK = {
    "opaque": (r"[A-Za-z0-9+/_-]{32,}={0,2}", 0, 32, "secret"),
    "ident": (r"""((?i)client_?id|key_?id|user_?name|user_?id|account|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@=-]+)""",
              2, 3, "identifier"),
    "endpoint": (r"""[a-z][a-z0-9+.]{1,9}://[^\x20\x09-\x0D"'<>]+""", 0, 8, "endpoint"),
}
KINDS = [*BASE, *WEAK]
CLASSES = ["identifier", "secret", "endpoint"]
_SPANS = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _found(text: Column, kind: str) -> Column:
    """Spans of one kind: the matches, placed by the lengths of what stands between them."""
    pattern, group, least, _ = (BASE | WEAK)[kind]
    between = F.transform(F.split(text, pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), F.length)
    value = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length)
    parts = F.arrays_zip(between.alias("b"), whole.alias("w"), value.alias("v"))
    empty = F.array().cast(_SPANS)
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + p["b"]
        end = begin + p["w"]
        span = F.array(F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                                F.lit(kind).alias("kind"), end.alias("end")))
        return F.struct(F.coalesce(end, begin).alias("at"),
                        F.when(p["v"] >= least, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    return F.when(text.rlike(pattern), F.aggregate(parts, start, step, lambda acc: acc["out"])).otherwise(empty)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_weak; one row for each row of ``docs``."""
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text, F.length(text)).alias("h"), text.alias("text"))
    found = save(rows.select("doc_id", "h", *[_found(F.col("text"), k).alias(k) for k in KINDS]), "secret-parts")
    # a repeated row finds the same: once is enough for linking
    every = F.concat(*KINDS)
    parts = (found.where(F.size(F.concat(*WEAK)) > 0).select("doc_id", "h", F.explode(every).alias("s"))
             .select("doc_id", "h", "s.*").distinct())
    kind_of = F.coalesce(*[F.when(F.col("kind") == k, F.lit(v[3])) for k, v in (BASE | WEAK).items()])
    bin_of = lambda c: F.floor(F.col(c) / SCOPE)
    parts = save(parts.withColumn("class", kind_of), "secret-rows")
    # each part at its start and at its end
    both = parts.select("doc_id", "h", "class", F.explode(F.array(
        F.struct(bin_of("start").alias("near"), F.col("start").alias("s"), F.lit(None).cast("int").alias("e")),
        F.struct(bin_of("end").alias("near"), F.lit(None).cast("int").alias("s"), F.col("end").alias("e")))).alias("x"))
    ends = [f(F.when(F.col("class") == c, F.col(f"x.{x}"))).alias(f"{w}_{x}_{c}")
            for c in CLASSES for x in ("s", "e") for w, f in (("lo", F.min), ("hi", F.max))]
    bins = both.groupBy(F.col("doc_id").alias("d"), F.col("h").alias("g"), F.col("x.near").alias("near")).agg(*ends)
    weak = parts.where(F.col("kind").isin(*WEAK)).withColumn("near_bin", F.explode(F.array_distinct(F.array(
        *[bin_of("start") + i for i in (-1, 0, 1)], *[bin_of("end") + i for i in (0, 1)]))))
    met = weak.join(bins, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g"))
                    & (F.col("near_bin") == F.col("near")))

    def any_of(tests: list[Column]) -> Column:
        return F.coalesce(F.max(reduce(lambda x, y: x | y, [F.coalesce(t, F.lit(False)) for t in tests])), F.lit(False))

    def apart(c: str) -> list[Column]:
        """A part of the class ends before, or starts after the candidate, with a gap of at most SCOPE."""
        return [*[F.col(f"{w}_s_{c}").between(F.col("end"), F.col("end") + SCOPE) for w in ("lo", "hi")],
                *[F.col(f"{w}_e_{c}").between(F.col("start") - SCOPE, F.col("start")) for w in ("lo", "hi")]]

    def beside(c: str) -> list[Column]:
        return [F.abs(F.col(f"{w}_s_{c}") - F.col("start")) <= SCOPE for w in ("lo", "hi")]

    keys = ["doc_id", "h", "start", "rank", "kind", "end", "class"]
    seen = met.groupBy(*keys).agg(*[any_of(apart(c)).alias(f"apart_{c}") for c in CLASSES],
                                  *[any_of(apart(c) + beside(c)).alias(f"has_{c}") for c in CLASSES])
    full = F.lit(True)
    for c in CLASSES:
        full = full & ((F.col("class") == c) | F.col(f"has_{c}"))
    pair = (((F.col("class") == "identifier") & F.col("apart_secret"))
            | ((F.col("class") == "secret") & F.col("apart_identifier")))
    known = found.select(F.col("doc_id").alias("d"), F.col("h").alias("g"), F.concat(*BASE).alias("base")).where(
        F.size("base") > 0).distinct()
    seen = seen.where(full | pair).withColumn("full", full).join(
        known, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")), "left").drop("d", "g")
    covered = F.coalesce(F.exists("base", lambda b: (b["start"] <= F.col("start")) & (b["end"] >= F.col("end"))), F.lit(False))
    linked = (seen.where(F.col("full") | ~covered).groupBy(F.col("doc_id").alias("d"), F.col("h").alias("g"))
              .agg(F.collect_list(F.struct("start", "rank", "kind", "end")).alias("weak")))
    base = F.array_sort(F.concat(*BASE))
    out = found.join(linked, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")), "left")
    added = F.coalesce("weak", F.array().cast(_SPANS))
    return out.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat(base, added))).alias("spans"), F.size(added).cast("long").alias("n_weak"))
