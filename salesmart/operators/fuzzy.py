"""Best token-set match of every query among all candidates of its group (D-9, L-7, J-2), by an index.

Queries and candidates are reduced to distinct token sets; equal sets score alike. A pair's score is the largest
of three similarities, and each has an index that misses no pair at a given cutoff c:

* shared tokens against all tokens of one side (100 if it has no others): with n characters that side needs
  ``c n / (2 - c)`` characters of shared tokens, so one shared token is among its rarest ones, up to that length.
  These few tokens of one side meet all tokens of the other by equality (:func:`token_pairs`).
* both sides whole: insertions and deletions are at most ``(1 - c)`` of both lengths, and each changes at most
  three letter pairs (one letter). So the bags of pairs (letters, where c is too low for pairs) overlap by a
  known number, and the rarest elements of both sides up to that number share one (:func:`bag_pairs`).

Candidates met are bounded again by lengths, letter counts and edits (all sound) before they are scored. Cutoffs fall in
steps: a query whose best score reaches a step is settled, as every pair at that step has been met, and a query's
own best score serves as its cutoff meanwhile. So most queries never come to the low steps, where the index is wide.

All of it is joins by equality, aggregates and built-in functions. A pair met under several elements is scored under
the first of them only. Null texts and texts without tokens match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from salesmart.functions import similarity as sim
from salesmart.session import materialize

#: Steps of the cutoff, in per cent, above the cutoff itself.
STEPS = (85.0, 70.0, 50.0, 25.0)
#: Below this cutoff the overlap of letter pairs proves too little, and letters are used.
PAIRS_FROM = 69.0
#: FIXED VALUES: frequent letters, whose counts are compared (any choice is sound).
LETTERS = "aeionrtsldcumpbg"
_SLACK = 1e-6


def _letter_counts(text: Column) -> Column:
    """Counts of the frequent letters in either case, four bits each: modulo 16, differences are never above the true ones."""
    out = F.lit(0).cast("long")
    low = F.lower(text)
    for i, letter in enumerate(LETTERS):
        count = F.char_length(low) - F.char_length(F.replace(low, F.lit(letter), F.lit("")))
        out = out.bitwiseOR(F.shiftleft(count.cast("long").bitwiseAND(F.lit(15)), 4 * i))
    return out


def _letters_apart(a: Column, b: Column) -> Column:
    total = F.lit(0)
    for i in range(len(LETTERS)):
        x, y = (F.shiftrightunsigned(c, 4 * i).bitwiseAND(F.lit(15)) for c in (a, b))
        total = total + F.least(F.abs(x - y), F.lit(16) - F.abs(x - y))
    return total


def token_sets(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``ts`` (sorted distinct tokens), ``n`` (characters, joined by spaces) and ``letters``."""
    out = df.withColumn("ts", sim.token_set(F.col(text))).where(F.size("ts") > 0)
    joined = F.array_join("ts", " ")
    return out.withColumn("n", F.char_length(joined)).withColumn("letters", _letter_counts(joined))


def _elements(kind: str) -> Column:
    """Elements of a token set: its tokens, or its bag of letter pairs or letters, repeats numbered."""
    if kind == "tokens":
        return F.col("ts")
    if kind == "pairs":
        pair = "transform(sequence(0, char_length(t)), i -> substr(concat(' ', t, ' '), i + 1, 2))"
        bag = f"array_sort(flatten(transform(ts, t -> {pair})))"
    else:
        bag = "array_sort(filter(split(array_join(ts, ' '), ''), c -> c != ''))"
    # `b` is named by a one-element transform: SQL lambdas have no let
    numbered = "transform(b, (x, i) -> concat(x, cast(i + 2 - array_position(b, x) as string)))"
    return F.expr(f"transform(array({bag}), b -> {numbered})[0]")


def frequencies(rows: DataFrame, kind: str) -> DataFrame:
    """g, e, df: how many token sets of a group have the element."""
    return rows.select("g", F.explode(_elements(kind)).alias("e")).groupBy("g", "e").agg(F.count("*").alias("df"))


def by_rarity(rows: DataFrame, kind: str, often: DataFrame) -> DataFrame:
    """``rows`` with ``es``, their elements, the rarest first (in an order that is the same for all rows of a group)."""
    each = rows.select("g", "ts", F.explode(_elements(kind)).alias("e")).join(often, ["g", "e"], "left")
    es = F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "e")))
    es = each.groupBy("g", "ts").agg(F.transform(es, lambda x: x["e"]).alias("es"))
    return rows.join(es, ["g", "ts"])


def _head(kind: str, c: Column) -> Column:
    """How many of a row's elements ``es`` one of which any match at cutoff c shares."""
    share = c / (F.lit(200.0) - c)   # of n: the least characters in common, and the least length of the other side by n
    n = F.col("n")
    if kind == "tokens":
        # elements of which the ones before leave enough characters
        room = n - n * share + _SLACK
        before = F.transform("es", lambda _, i: F.aggregate(F.slice("es", F.lit(1), i), F.lit(0),
                                                            lambda acc, t: acc + F.char_length(t) + 1))
        return F.size(F.filter(before, lambda x: x <= room))
    both = n * (F.lit(1) + share)
    lost = (F.lit(1) - c / 100) * both
    overlap = (both + 2 - 3 * lost) / 2 if kind == "pairs" else (both - lost) / 2
    return F.least(F.size("es"), F.size("es") - F.ceil(overlap - _SLACK).cast("int") + 1)


def _posted(rows: DataFrame, part: Column, side: str) -> DataFrame:
    """One row for each of the first ``part`` elements, columns named by side."""
    cols = [F.col(x).alias(f"{side}_{x}") for x in rows.columns if x != "g"]
    return (rows.withColumn("head", F.slice("es", F.lit(1), part)).where(F.size("head") > 0)
            .select("g", *cols, F.col("head").alias(f"{side}_head"), F.explode("head").alias("e")))


def token_pairs(queries: DataFrame, candidates: DataFrame, cutoff: float) -> DataFrame:
    """Pairs (q_*, c_*) that share one of either side's rarest tokens: all that shared tokens bring to the cutoff."""
    c, every = F.lit(cutoff), F.size("es")
    head = _head("tokens", c)
    some = _posted(queries, head, "q").join(_posted(candidates, every, "c"), ["g", "e"])
    some = some.where(F.get(F.array_intersect("q_es", "c_ts"), F.lit(0)) == F.col("e"))
    rest = _posted(queries, every, "q").join(_posted(candidates, head, "c"), ["g", "e"])
    rest = rest.where(F.get(F.array_intersect("c_es", "q_ts"), F.lit(0)) == F.col("e"))
    out = some.unionByName(rest)
    # shared characters that the cutoff needs of one of the two
    shared = F.char_length(F.array_join(F.array_intersect("q_ts", "c_ts"), " "))
    return out.where((shared + _SLACK >= F.least("q_n", "c_n") * (c / (F.lit(200.0) - c))))


def bag_pairs(queries: DataFrame, candidates: DataFrame, kind: str, cutoff: float) -> DataFrame:
    """Pairs (q_*, c_*) whose whole similarity may reach the query's ``least``, which is at least the cutoff."""
    met = (_posted(queries, _head(kind, F.col("least")), "q")
           .join(_posted(candidates, _head(kind, F.lit(cutoff)), "c"), ["g", "e"])
           .where(F.get(F.array_intersect("q_head", "c_head"), F.lit(0)) == F.col("e")))
    total = F.col("q_n") + F.col("c_n")
    lost = (F.lit(1) - F.col("q_least") / 100) * total + _SLACK
    near = (F.abs(F.col("q_n") - F.col("c_n")) <= lost) & (_letters_apart(F.col("q_letters"), F.col("c_letters")) <= lost)
    only = [F.array_join(F.array_except(f"{x}_ts", f"{y}_ts"), " ") for x, y in (("q", "c"), ("c", "q"))]
    return met.where(near).where(F.levenshtein(*only) <= lost)


def best_matches(queries: DataFrame, candidates: DataFrame, cutoff: float, counts: dict | None = None) -> DataFrame:
    """Distinct (g, q) and (g, t, pos, hit) -> (g, q, score, hit): the best candidate with score >= cutoff > 0.

    On equal scores the smallest ``pos`` wins; ``pos`` is unique in a group. Null texts match nothing.
    ``counts`` gets the number of pairs that were scored, under ``pairs``.
    """
    asked = materialize(token_sets(queries, "q").select("g", "q", "ts", "n", "letters"), "fuzzy-queries")
    sets = token_sets(candidates, "t").groupBy("g", "ts", "n", "letters").agg(F.min(F.struct("pos", "hit")).alias("first"))
    sets = materialize(sets.join(asked.select("g").distinct(), "g", "left_semi"), "fuzzy-candidates")
    wanted = asked.select("g", "ts", "n", "letters").distinct()
    score = sim.token_set_score(F.col("q_ts"), F.col("c_ts"))
    first = F.min(F.struct((-F.col("score")).alias("less"), F.col("c_first.pos").alias("pos"), F.col("c_first.hit").alias("hit")))
    observed: list[Observation] = []

    def better(pairs: DataFrame, known: DataFrame | None) -> DataFrame:
        """g, ts, best: each query's best pair so far that reaches the cutoff, the first candidate on ties."""
        if counts is not None:
            observed.append(Observation())
            pairs = pairs.observe(observed[-1], F.count(F.lit(1)).alias("pairs"))
        new = pairs.withColumn("score", score).where(F.col("score") >= cutoff).groupBy("g", F.col("q_ts").alias("ts"))
        new = new.agg(first.alias("best"))
        if known is not None:
            new = known.unionByName(new).groupBy("g", "ts").agg(F.min("best").alias("best"))
        return materialize(new, "fuzzy-best")

    def waiting(step: float) -> DataFrame:
        """Queries that have no score of ``step`` or more yet, with the best they have."""
        have = best.select("g", "ts", (-F.col("best.less")).alias("score"))
        out = wanted.join(have, ["g", "ts"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
        return out.where(F.col("score") < step - _SLACK)

    often = materialize(frequencies(sets, "tokens"), "fuzzy-tokens")
    q, c = (materialize(by_rarity(x, "tokens", often), "fuzzy-by-token") for x in (wanted, sets))
    best = better(token_pairs(q, c, 100.0), None)
    if cutoff < 100:  # what one side contains is settled; the others meet all that shared tokens bring to the cutoff
        open_q = q.join(waiting(100.0).select("g", "ts"), ["g", "ts"], "left_semi")
        best = better(token_pairs(open_q, c, cutoff), best)
    settled, kind = 100.0, None
    for step in [*(s for s in STEPS if s > cutoff), cutoff]:
        if cutoff >= 100 or waiting(settled).isEmpty():
            break
        left = waiting(settled).withColumn("least", F.greatest("score", F.lit(step)) - _SLACK).drop("score")
        if kind != (kind := "pairs" if step >= PAIRS_FROM else "letters"):
            often = materialize(frequencies(sets, kind), f"fuzzy-{kind}")
            bags = materialize(by_rarity(sets, kind, often), f"fuzzy-by-{kind}")
        best, settled = better(bag_pairs(by_rarity(left, kind, often), bags, kind, step), best), step
    if counts is not None:
        counts["pairs"] = sum(o.get["pairs"] for o in observed)
    return (asked.join(best, ["g", "ts"])
            .select("g", "q", (-F.col("best.less")).alias("score"), F.col("best.hit").alias("hit")))
