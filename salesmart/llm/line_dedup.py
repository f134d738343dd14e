"""Line dedup by a segment-partition edit join (method 3, DataFrame functions only).

A line repeats an earlier one if it is equal, whatever its length, or if few single-character edits lead
from one to the other: ``EDITS`` where both have ``LEAST`` characters or more, one where the shorter
has ``LEAST_ONE`` to ``LEAST - 1``, none below, where one edit makes another word.

Lines of ``LEAST`` characters or more are split into ``EDITS + 1`` segments; within that distance at least one segment
survives unchanged, near its place. So each line is indexed under its length and segments, and
probes, for each length it may match, the few substrings that the positions of a surviving segment
allow (multi-match-aware windows of PassJoin). Candidates whose counts of frequent letters differ by more than
``2 * EDITS`` go at once: an edit takes at most one character and brings one, so no true pair does. Of the rest go those
of which too few small parts of one line stand in the other, and what is left is verified with a banded bit-parallel edit
distance: one word holds the ``2 * EDITS + 1`` diagonals of the band.

A segment that many lines share is not paired at once, as its pairs grow with the square of the group: its lines are the
crowd, which is paired with the counts of letters at hand, so that few false pairs are written.
Which segments are frequent is told from every ``EVERY``-th line; a wrong guess costs time and loses no pair, as either
way is exact. A segment of ``MOST`` lines or more is not paired at all: its lines go on to :func:`near_in_groups`, which
narrows down the places of the edits until lines that share a key are within the distance as they are, so that a
grouped minimum is enough.

Lines are ordered by the smallest doc_id that holds them (null last), then by the line's text. A line
is removed from a document if it stands there already, if a smaller doc_id holds the same line, or
if any line earlier in that order is within the distance. This is judged on the input, not on what
is left. Blank lines (white space only) are never removed and never cause a removal.

For one edit, the shorter lines meet under themselves and themselves without one character: lines one
edit apart share such a key, and few distinct lines can share one, so there is no large group.

Null and empty texts have no line to remove. Rows of one doc_id are told apart by their text; a row
that repeats another is treated like it. Extra columns are ignored by :func:`repeats`, kept by
:func:`clean`, which drops documents that lose lines and have no other text left.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import BITMAP_BITS, prepare, save, unused

EDITS = 2
LEAST = 12
LEAST_ONE = 6
LETTERS = "etanorihsdlcumwf"
#: A segment held by ``OFTEN`` or more of every ``EVERY``-th line (about 24 lines) is left to the crowd, and one that ``MOST``
#: lines of the crowd hold to the groups.
EVERY, OFTEN, MOST = 8, 3, 512
#: Windows a line is first cut into where a segment is frequent, and parts compared before the edit distance.
CUTS, PARTS = 6, 8
#: Lengths that two edits in order add to the shorter line (0 replaced, 1 inserted, -1 deleted; a deletion before an
#: insertion is an insertion before a deletion, seen from the other line).
KINDS = [(0, 0), (1, -1), (0, 1), (1, 0), (1, 1)]
_LAST = (1 << 63) - 1


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(text, F.length(text)).alias("h"), F.split(text, "\n", -1).alias("lines"))


def _full(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\x0b\x0c")) != ""


def _key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _segment(length: Column, i: int) -> tuple[Column, Column]:
    """Start (from 0) and length of segment i of a line of the given length."""
    parts = EDITS + 1
    short = F.floor(length / parts).cast("int")
    n_short = F.lit(parts) - (length - short * parts)
    start = F.lit(i) * short + F.greatest(F.lit(0), F.lit(i) - n_short)
    return start.cast("int"), (short + F.when(F.lit(i) >= n_short, 1).otherwise(0)).cast("int")


def _index_key(i: int) -> Column:
    start, size = _segment(F.col("n"), i)
    return F.xxhash64(F.col("n"), F.substr(F.col("line"), start + 1, size))


def _windows(i: int) -> Column:
    """(less, shift) of the substrings where segment i of a line shorter by 0 to EDITS characters can have survived."""
    return F.array(*[F.struct(F.lit(less).alias("less"), F.lit(shift).alias("shift")) for less in range(EDITS + 1)
                     for shift in range(max(-i, less - (EDITS - i)), min(i, less + (EDITS - i)) + 1)])


def _probes(lines: DataFrame, i: int) -> DataFrame:
    """``lines`` (uid, line, n) -> less, key and the other columns: one row for each window inside the line.

    Windows are dealt out first, as one small expression for the key is compiled, and one for each window, which
    a lambda or a large array takes, is not.
    """
    dealt = lines.withColumn("w", F.explode(_windows(i))).select("*", "w.*")
    n = F.col("n") - F.col("less")
    start, size = _segment(n, i)
    dealt = dealt.withColumns({"m": n, "at": start + F.col("shift"), "size": size})
    dealt = dealt.where("at >= 0 and at + size <= n")
    key = F.xxhash64("m", F.substr("line", F.col("at") + 1, F.col("size")))
    return dealt.select(*[c for c in lines.columns if c not in ("line", "n")], "less", key.alias("key"))


def _count(line: Column, letter: str) -> Column:
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit("")))


def _letter_counts(line: Column) -> Column:
    """Counts of the frequent letters, four bits each: differences modulo 16 are never above the true ones."""
    out = F.lit(0).cast("long")
    for i, letter in enumerate(LETTERS):
        out = out.bitwiseOR(F.shiftleft(_count(line, letter).cast("long").bitwiseAND(F.lit(15)), 4 * i))
    return out


def _letters_apart(a: str, b: str) -> Column:
    total = F.lit(0)
    for i in range(len(LETTERS)):
        x, y = (F.shiftrightunsigned(F.col(c), 4 * i).bitwiseAND(F.lit(15)) for c in (a, b))
        total = total + F.least(F.abs(x - y), F.lit(16) - F.abs(x - y))
    return total


def within_edits(a: str, b: str) -> Column:
    """Whether at most EDITS edits lead from column a to b: band of 2 * EDITS + 1 diagonals in one word.

    Bit k of a word stands for row ``j - EDITS + k`` of column j; after each column the words are
    aligned to the next one, so the diagonal moves along with the band.
    """
    t, w = EDITS, (1 << (2 * EDITS + 1)) - 1
    first = ((1 << (t + 1)) - 1) << t
    same = " + ".join(f"if(get(x.p, j - {t} + {k}) = get(x.q, j), {1 << k}, 0)" for k in range(2 * t + 1))
    d0 = "(((((m & s.vp) + s.vp) ^ s.vp) | m | s.vn) & {w})".format(w=w)
    hp, hn = f"((s.vn | ~(d | s.vp)) & {w})", "(d & s.vp)"
    rest = f"(size(x.p) - {t})"
    bit = f"shiftright({{}}, {2 * t - 1} - (j - {rest})) & 1"
    move = (f"if(j < {rest}, 1 - (shiftright(d, {2 * t}) & 1), "
            f"({bit.format(hp)}) - ({bit.format(hn)}))")
    # `d` and `m` are named by one-element transforms: SQL lambdas have no let
    new = (f"named_struct('vp', ({hn} | ~(shiftright(d, 1) | {hp})) & {w}, "
           f"'vn', shiftright(d, 1) & {hp}, 'e', s.e + {move})")
    step = f"transform(array({same}), m -> transform(array({d0}), d -> {new})[0])[0]"
    walk = (f"aggregate(if(size(x.q) > 0, sequence(0, size(x.q) - 1), array()), "
            f"named_struct('vp', {first & w}, 'vn', 0, 'e', {t}), (s, j) -> {step}, s -> s.e <= {t})")
    # rows: the longer line, so that the walk reaches its last row; then at least `t` rows are needed
    pair = (f"named_struct('p', if(length({a}) >= length({b}), split({a}, ''), split({b}, '')), "
            f"'q', if(length({a}) >= length({b}), split({b}, ''), split({a}, '')))")
    long_enough = f"greatest(length({a}), length({b})) > {t}"
    fits = f"abs(length({a}) - length({b})) <= {t}"
    return F.expr(f"{fits} and ({a} = {b} or not {long_enough} or "
                  f"transform(array({pair}), x -> {walk})[0])")


def _trimmed(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cuts equal beginnings and ends, in eighths: edits lie between them."""
    def equal(side) -> Column:
        least = F.least(F.length(a), F.length(b))
        sizes = [F.floor(least * i / 8).cast("int") for i in (8, 7, 6, 5, 4, 3, 2, 1)]
        return F.coalesce(*[F.when(side(F.col(a), n) == side(F.col(b), n), n) for n in sizes], F.lit(0))

    df = df.withColumn("cut", equal(F.left))
    df = df.withColumns({c: F.substr(F.col(c), F.col("cut") + 1) for c in (a, b)})
    df = df.withColumn("cut", equal(F.right))
    return df.withColumns({c: F.left(F.col(c), F.length(c) - F.col("cut")) for c in (a, b)}).drop("cut")


def _members(rows: DataFrame, wanted: DataFrame, key: str, always: Column | None = None) -> DataFrame:
    """The rows whose key may be in ``wanted`` (or ``always``); the bitmap is a table of BITMAP_BITS / 64 rows at most."""
    slot = F.xxhash64(key).bitwiseAND(F.lit(BITMAP_BITS - 1))
    words = (wanted.select(slot.alias("s")).select(F.shiftrightunsigned("s", 6).alias("w"),
                                                   F.expr("shiftleft(1L, cast(s & 63 as int))").alias("bits"))
             .groupBy("w").agg(F.bit_or("bits").alias("bits")))
    hit = F.expr("coalesce(shiftright(bits, cast(s & 63 as int)) & 1, 0)") == 1
    return (rows.withColumn("s", slot).withColumn("w", F.shiftrightunsigned("s", 6))
            .join(F.broadcast(words), "w", "inner" if always is None else "left")
            .where(hit if always is None else always | hit).drop("w", "s", "bits"))


def _meet(lines: DataFrame, index: DataFrame, skip: DataFrame, i: int) -> DataFrame:
    """(a, b) of the lines that probe a key of ``index`` (uid, key); (a, null) of those that probe one of ``skip``.

    Where both have a ``bag``, the counts of their letters, lines that these tell apart are not paired.
    """
    # a frequent segment is one row without a line: each line that probes it, its own lines too, is met once
    index = index.join(skip, "key", "left_anti").unionByName(skip, allowMissingColumns=True)
    once = (F.col("other") < 0) | (F.col("uid") < F.col("other"))
    own = ["uid", "line", "n"]
    if "bag" in index.columns:
        once = once & (_letters_apart("bag", "other_bag") <= 2 * EDITS)
        lines, own = lines.withColumnRenamed("bag", "other_bag"), [*own, "other_bag"]
    # lines of one length probe each other, so one direction is enough; a longer line (negative) always counts
    other = F.when(F.col("less") > 0, -1 - F.col("uid")).otherwise(F.col("uid"))
    probe = _probes(lines.select(*own), i).withColumn("other", other).drop("uid", "less")
    met = probe.join(index, "key").where(F.col("uid").isNull() | once)
    line = F.when(F.col("other") < 0, -1 - F.col("other")).otherwise(F.col("other"))
    return met.select(F.when(F.col("uid") < line, F.col("uid")).otherwise(line).alias("a"),
                      F.when(F.col("uid") < line, line).otherwise(F.col("uid")).alias("b"))


def _near_in_crowd(crowd: DataFrame, often: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of ``crowd`` (uid, line, n, first) that share a segment of ``often``, and uid of those near an earlier one."""
    keys = [_index_key(i).alias(f"key_{i}") for i in range(EDITS + 1)]
    crowd = save(crowd.select("*", _letter_counts(F.col("line")).alias("bag"), *keys), "line-crowd")
    found = []
    for i in range(EDITS + 1):
        index = (crowd.select("uid", "bag", F.col(f"key_{i}").alias("key"))
                 .join(often, "key", "left_semi"))
        most = save(index.groupBy("key").count().where(F.col("count") >= MOST).select("key"), "line-most")
        found.append(save(_meet(crowd, index, most, i), f"line-crowd-pairs-{i}"))
    met = reduce(DataFrame.unionByName, found)
    grouped = met.where("b is null").select(F.col("a").alias("uid")).distinct()
    return met.where("b is not null"), near_in_groups(crowd, grouped)


def near_lines(lines: DataFrame) -> DataFrame:
    """uid of the lines (uid, line, n, first, key_0 and on) that an earlier line is within the distance of.

    One join for each segment, so that only its keys are on disk at a time.
    """
    found = []
    some = lines.where(F.pmod(F.xxhash64("uid"), F.lit(EVERY)) == 0)
    some = some.select(F.explode(F.array(*[f"key_{i}" for i in range(EDITS + 1)])).alias("key"))
    often = save(some.groupBy("key").count().where(F.col("count") >= OFTEN).select("key"), "line-often")
    for i in range(EDITS + 1):
        found.append(save(_meet(lines, lines.select("uid", F.col(f"key_{i}").alias("key")), often, i), f"line-pairs-{i}"))
    met = save(reduce(DataFrame.unionByName, found).distinct(), "line-pairs")
    pairs, crowd = met.where("b is not null"), met.where("b is null").select(F.col("a").alias("uid"))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("uid")).unionByName(crowd)
    some = save(_members(lines, ends, "uid").select("uid", "line", "n", "first"), "line-members")
    grouped = None
    if not crowd.isEmpty():
        more, grouped = _near_in_crowd(some.join(crowd.distinct(), "uid", "left_semi"), often)
        pairs = pairs.unionByName(more).distinct()
    side = lambda s: some.select(F.col("uid").alias(s), F.col("line").alias(f"line_{s}"),
                                 F.col("first").alias(f"first_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    later = F.when(F.struct("first_a", "line_a") > F.struct("first_b", "line_b"), F.col("a")).otherwise(F.col("b"))
    both = both.select(later.alias("uid"), F.col("line_a").alias("x"), F.col("line_b").alias("y"))
    # written, as a filter moved below the cuts would repeat their expressions many times
    middles = save(_trimmed(both, "x", "y"), "line-middles")
    apart = reduce(Column.__add__, [F.abs(_count(F.col("x"), c) - _count(F.col("y"), c)) for c in LETTERS])
    near = middles.where(apart <= 2 * EDITS).where(_parts_stand("x", "y")).where(within_edits("x", "y")).select("uid")
    return (near if grouped is None else near.unionByName(grouped)).distinct()


def _parts_stand(a: str, b: str) -> Column:
    """Whether all but EDITS of the parts of a stand in b, as those do that no edit touches."""
    n, a, b = F.length(a), F.col(a), F.col(b)
    total = F.lit(0)
    for k in range(PARTS):
        at, end = (F.floor(n * j / PARTS).cast("int") for j in (k, k + 1))
        total = total + F.contains(b, F.substr(a, at + 1, end - at)).cast("int")
    return total >= PARTS - EDITS


def _cell_key(cells: DataFrame) -> DataFrame:
    """``cells`` (with line, n) with ``key``: what an edit in each window, [a1, b1) and [a2, b2), leaves of the line.

    Windows count characters of the shorter line; in the longer one (``long``) what follows an edit has moved by its length.
    """
    after, last = F.when(F.col("long"), F.col("e1")).otherwise(0), F.when(F.col("long"), F.col("e1") + F.col("e2")).otherwise(0)
    parts = [F.substr("line", F.lit(1), F.col("a1")),
             F.substr("line", F.col("b1") + after + 1, F.greatest(F.col("a2") - F.col("b1"), F.lit(0))),
             F.substr("line", F.col("b2") + last + 1)]
    return cells.withColumn("key", F.xxhash64("m", "e1", "e2", "a1", "b1", "a2", "b2", *[F.xxhash64(p, F.length(p)) for p in parts]))


def _halves(a: str, b: str, e: str) -> Column:
    """Halves of a window; a window of one character is a place, unless a character comes in there: before it, or at the end."""
    half = F.floor((F.col(a) + F.col(b)) / 2).cast("int")
    win = lambda x, y: F.struct(x.alias("a"), y.alias("b"))
    a, b, e = F.col(a), F.col(b), F.col(e)
    gaps = F.when(b == F.col("m"), F.array(win(a, a), win(b, b))).otherwise(F.array(win(a, a)))
    return (F.when(b - a > 1, F.array(win(a, half), win(half, b))).when((b - a == 1) & (e == 1), gaps)
            .otherwise(F.array(win(a, b))))


def near_in_groups(lines: DataFrame, uids: DataFrame) -> DataFrame:
    """uid of those lines of ``uids`` that an earlier one of them is within the distance of, without pairs.

    Two lines within the distance agree but for two windows of the shorter one that hold an edit each. So a line is
    put under what is left of it for each two windows (they may be the same), as the shorter and as the longer of
    two; where two lines meet the windows are halved, until they are places. Lines that still share a key
    then are within the distance, whichever they are, and the earliest of a key decides for all others.
    """
    rows = save(lines.join(uids, "uid", "left_semi").select("uid", "line", "n", "first"), "line-grouped")
    widest = rows.agg(F.max("n")).first()[0]
    if widest is None:
        return rows.select("uid")
    kinds = F.array(*[F.struct(F.lit(e1).alias("e1"), F.lit(e2).alias("e2"), F.lit(long).alias("long"))
                      for e1, e2 in KINDS for long in ((False, True) if (e1, e2) != (0, 0) else (False,))])
    places = F.array(*[F.struct(F.lit(u).alias("u"), F.lit(v).alias("v")) for u in range(CUTS) for v in range(u, CUTS)])
    m = F.when(F.col("long"), F.col("n") - F.col("e1") - F.col("e2")).otherwise(F.col("n"))
    edge = lambda c, k: F.floor(F.col("m") * (F.col(c) + k) / CUTS).cast("int")
    cells = (rows.select("uid", "line", "n", F.explode(kinds).alias("kind")).select("uid", "line", "n", "kind.*").withColumn("m", m)
             .select("*", F.explode(places).alias("at")).select("*", "at.*")
             .withColumns({"a1": edge("u", 0), "b1": edge("u", 1), "a2": edge("v", 0), "b2": edge("v", 1)}))
    columns = ["uid", "e1", "e2", "long", "m", "a1", "b1", "a2", "b2", "key"]
    narrow = (widest // CUTS + 1).bit_length() + 1
    for step in range(narrow + 1):
        cells = save(_cell_key(cells).select(*columns), f"line-cells-{step}")
        # a key stays where two lines meet, one as the shorter and one as the longer, or either way if lengths stay
        meet = (cells.groupBy("key").agg(F.min("uid").alias("x"), F.max("uid").alias("y"), F.bool_or("long").alias("l"),
                                         F.bool_and("long").alias("s"), F.max("e1").alias("e"), F.max("e2").alias("f"))
                .where("x < y and ((e = 0 and f = 0) or (l and not s))").select("key"))
        cells = cells.join(meet, "key", "left_semi")
        if step < narrow:
            cells = (cells.drop("key").withColumn("w1", F.explode(_halves("a1", "b1", "e1")))
                     .withColumn("w2", F.explode(_halves("a2", "b2", "e2"))).where("w1.a <= w2.a")
                     .select("uid", "e1", "e2", "long", "m", F.col("w1.a").alias("a1"), F.col("w1.b").alias("b1"),
                             F.col("w2.a").alias("a2"), F.col("w2.b").alias("b2")).join(rows, "uid"))
    own = cells.join(rows, "uid").select("uid", "key", "long", ((F.col("e1") == 0) & (F.col("e2") == 0)).alias("alike"),
                                         F.struct("first", "line").alias("rank"))
    own = save(own, "line-places")
    least = own.groupBy("key").agg(F.min(F.when(~F.col("long"), F.col("rank"))).alias("shorter"),
                                   F.min(F.when(F.col("long"), F.col("rank"))).alias("longer"))
    against = F.when(F.col("long") | F.col("alike"), F.col("shorter")).otherwise(F.col("longer"))
    return own.join(least, "key").where(against < F.col("rank")).select("uid").distinct()


def near_short_lines(lines: DataFrame) -> DataFrame:
    """uid of the lines that an earlier line is within one edit of, one of both being shorter than LEAST."""
    short = lines.where(F.col("n").between(LEAST_ONE, LEAST))
    less = F.transform(F.sequence(F.lit(1), F.col("n")),
                       lambda i: F.concat(F.left("line", i - 1), F.substr(F.col("line"), i + 1)))
    keyed = save(short.select("uid", "line", "n", "first", F.explode(F.array_distinct(F.concat(F.array("line"), less)))
                              .alias("key")), "line-short")
    side = lambda s: keyed.select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("uid", "line", "n", "first")])
    return (side("a").join(side("b"), "key")
            .where((F.struct("first_a", "line_a") < F.struct("first_b", "line_b")) & (F.least("n_a", "n_b") < LEAST)
                   & (F.levenshtein("line_a", "line_b") <= 1))
            .select(F.col("uid_b").alias("uid")).distinct())


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, h, n_lines, n_removed, removed (line numbers from 0), for each row of ``docs``."""
    prepare(docs.sparkSession)
    rows = _rows(docs)
    order = F.coalesce("doc_id", F.lit(_LAST))
    held = rows.select(order.alias("doc"), F.explode(F.array_distinct("lines")).alias("line"))
    lines = (held.where(_full(F.col("line"))).groupBy("line").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
             .select(F.monotonically_increasing_id().alias("uid"), "line", F.length("line").alias("n"), "first", "last"))
    lines = save(lines.withColumns({f"key_{i}": _index_key(i) for i in range(EDITS + 1)}), "line-distinct")
    near = save(near_lines(lines.where(F.col("n") >= LEAST)).unionByName(near_short_lines(lines)).distinct(), "line-near")
    # a line that stands in one document only, and is near no other, can only repeat inside that document
    judged = save(lines.join(near.withColumn("near", F.lit(True)), "uid", "left").where("near or last > first")
                  .select(_key(F.col("line")).alias("k"), "first", "near"), "line-judged")
    full = F.filter("lines", _full)
    # counted before the lines are dealt out, as beside a generator it would be counted for each line
    marked = rows.withColumn("twice", F.size(F.array_distinct(full)) < F.size(full))
    at = (marked.select("doc_id", "h", order.alias("doc"), "twice", F.posexplode("lines").alias("pos", "line"))
          .where(_full(F.col("line"))))
    at = at.select("doc_id", "h", "doc", "twice", "pos", _key(F.col("line")).alias("k"))
    at = _members(at, judged, "k", F.col("twice"))
    per_doc = at.groupBy("doc_id", "h", "doc", "k").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    gone = (per_doc.join(judged, "k", "left")
            .withColumn("all", F.coalesce("near", F.lit(False)) | F.coalesce(F.col("doc") > F.col("first"), F.lit(False)))
            .where(F.col("all") | (F.size("at") > 1))
            .select("doc_id", "h", F.when(F.col("all"), F.col("at")).otherwise(F.expr("slice(at, 2, size(at))")).alias("at")))
    gone = (gone.groupBy(F.col("doc_id").alias("d"), F.col("h").alias("g"))
            .agg(F.sort_array(F.flatten(F.collect_list("at"))).alias("removed")))
    out = rows.select("doc_id", "h", F.size("lines").cast("long").alias("n_lines")).join(
        gone, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return out.select("doc_id", "h", "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))


def clean(docs: DataFrame) -> DataFrame:
    """The documents of ``docs`` without repeated lines: text and n_chars changed, other columns kept."""
    key, row, gone, own = (unused(docs, n) for n in ("line_doc", "line_row", "line_gone", "line_own"))
    cut = (repeats(docs).where("n_removed > 0").groupBy(F.col("doc_id").alias(key), F.col("h").alias(row))
           .agg(F.first("removed").alias(gone)))
    text = F.coalesce(docs["text"], F.lit(""))
    full = docs.withColumn(own, F.xxhash64(text, F.length(text)))
    full = full.join(cut, full["doc_id"].eqNullSafe(F.col(key)) & (F.col(own) == F.col(row)), "left")
    lines = F.split("text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    left = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    full = full.withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(left))
    full = full.where(F.col(gone).isNull() | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        full = full.withColumn("n_chars", F.when(F.col(gone).isNull(), F.col("n_chars")).otherwise(changed))
    return full.select(*docs.columns)
