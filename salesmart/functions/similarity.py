"""String similarity on the 0-100 scale (L-10): ratio, token-sort, token-set.

``ratio`` is the normalised Indel similarity, 100 * 2 * LCS / (len a + len b)
(100 when both strings are empty). ``token_sort_ratio`` compares the sorted
whitespace tokens, ``token_set_ratio`` compares token-set intersections and
differences. No case folding or other preprocessing is applied: callers
normalise first when they want to.

Everything is a Column of built-in functions (no Python worker). The length of
the longest common subsequence is the bit-parallel algorithm: the characters
of one string are bits, held in words of ``WORD`` bits so that a carry never
overflows a long; each character of the other string is one step over the words.
A null string gives a null score.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = 62
_ONES = (1 << WORD) - 1
#: What separates tokens: white space of any script, and the ASCII separators 1C to 1F.
SPACES = r"[\p{Z}\t-\r\x1c-\x1f\x85]+"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once (lambdas of SQL functions have no let)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tokens(text: Column) -> Column:
    """Tokens of a text in order, repeats included."""
    return F.filter(F.split(text, SPACES), lambda t: t != "")


def token_set(text: Column) -> Column:
    """Distinct tokens, sorted by code point."""
    return F.array_sort(F.array_distinct(tokens(text)))


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _masks(text: Column) -> Column:
    """Map from each character to the words whose bits mark its places."""
    def words(chars: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(chars), F.lit(1)), F.lit(WORD))

        def word(c: Column, start: Column) -> Column:
            bits = F.transform(F.slice(chars, start, F.lit(WORD)),
                               lambda x, i: F.when(x == c, F.call_function("shiftleft", F.lit(1).cast("long"), i))
                               .otherwise(F.lit(0).cast("long")))
            return F.aggregate(bits, F.lit(0).cast("long"), lambda acc, b: acc + b)

        return F.map_from_entries(F.transform(
            F.array_distinct(chars), lambda c: F.struct(c, F.transform(starts, lambda start: word(c, start)))))

    return _let(_chars(text), words)


def _lcs(masks: Column, n: Column, other: Column) -> Column:
    """Length of the longest common subsequence: characters of ``other`` walk over the words of a string of n."""
    last = F.call_function("div", F.greatest(n, F.lit(1)) - 1, F.lit(WORD)).cast("int")
    start = F.transform(F.sequence(F.lit(0), last), lambda _: F.lit(_ONES))

    def word(state: Column, old: Column, mask: Column) -> Column:
        total = old + old.bitwiseAND(mask) + state["carry"]
        new = total.bitwiseAND(F.lit(_ONES)).bitwiseOR(old.bitwiseAND(F.bitwise_not(mask)))
        return F.struct(F.concat(state["words"], F.array(new)).alias("words"),
                        F.shiftright(total, WORD).cast("long").alias("carry"))

    def step(words: Column, c: Column) -> Column:
        def moved(mask: Column) -> Column:
            first = F.struct(F.expr("cast(array() as array<bigint>)").alias("words"), F.lit(0).cast("long").alias("carry"))
            pairs = F.arrays_zip(words.alias("old"), mask.alias("mask"))
            return F.aggregate(pairs, first, lambda s, p: word(s, p["old"], p["mask"]), lambda s: s["words"])

        return _let(F.try_element_at(masks, c), lambda m: F.when(m.isNull(), words).otherwise(moved(m)))

    zeros = lambda words: F.aggregate(words, F.lit(0), lambda acc, w: acc + F.lit(WORD) - F.bit_count(w))
    return F.aggregate(_chars(other), start, step, zeros)


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence."""
    return _let(_masks(a), lambda m: _lcs(m, F.char_length(a), b))


def _similarity(distance: Column, total: Column) -> Column:
    return F.lit(100.0) * (F.lit(1) - distance / total)


def ratio(a: Column, b: Column) -> Column:
    return ratios(a, F.array(b))[0]


def ratios(a: Column, others: Column) -> Column:
    """``ratio`` with each string of an array."""
    def one(masks: Column, b: Column) -> Column:
        total = F.char_length(a) + F.char_length(b)
        return F.when(total == 0, F.lit(100.0)).otherwise(
            _similarity(total - 2 * _lcs(masks, F.char_length(a), b), F.greatest(total, F.lit(1))))

    return _let(_masks(a), lambda m: F.transform(others, lambda b: F.when(a.isNotNull() & b.isNotNull(), one(m, b))))


def sorted_tokens(text: Column) -> Column:
    return F.array_join(F.array_sort(tokens(text)), " ")


def token_sort_ratio(a: Column, b: Column) -> Column:
    return ratio(sorted_tokens(a), sorted_tokens(b))


def token_set_ratio(a: Column, b: Column) -> Column:
    return token_set_score(token_set(a), token_set(b))


def token_set_score(a: Column, b: Column) -> Column:
    """``token_set_ratio`` of two sorted token sets.

    The largest of three similarities: between the shared tokens followed by either side's own tokens, and
    between the shared tokens alone and each of the two.
    """
    only_a, only_b = (F.array_join(F.array_except(x, y), " ") for x, y in ((a, b), (b, a)))
    shared = F.array_join(F.array_intersect(a, b), " ")

    def score(p: Column) -> Column:
        n_a, n_b, both = (F.char_length(p[c]) for c in ("a", "b", "both"))
        gap = F.when(both > 0, F.lit(1)).otherwise(F.lit(0))
        whole_a, whole_b = both + gap + n_a, both + gap + n_b
        full = _similarity(n_a + n_b - 2 * lcs_length(p["a"], p["b"]), whole_a + whole_b)
        alone = F.greatest(_similarity(gap + n_a, both + whole_a), _similarity(gap + n_b, both + whole_b))
        # insertions and deletions are at least as many as edits: most pairs need no subsequence
        most = _similarity(F.levenshtein(p["a"], p["b"]), whole_a + whole_b)
        return (F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
                .when((both > 0) & ((n_a == 0) | (n_b == 0)), F.lit(100.0))
                .when(both == 0, full).when(most <= alone, alone).otherwise(F.greatest(full, alone)))

    return _let(F.struct(only_a.alias("a"), only_b.alias("b"), shared.alias("both")), score)
