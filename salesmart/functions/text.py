"""Text cleansing as native column expressions (L-1 ... L-3, L-5, L-8, L-9, L-16).

Everything here is built from ``pyspark.sql.functions`` and runs inside
whole-stage codegen; no Python runs per row.

Unaccenting: Spark has no transliteration function, so ``unaccent`` is a
``translate`` whose table is *generated by a rule* at import time - every
Latin letter (U+00C0..U+024F) whose canonical decomposition is an ASCII
letter plus combining marks maps to that letter - plus the few letters that
transliterate to something else (ligatures, sharp s, barred letters).
After unaccenting, anything that is not an ASCII word character or ASCII
whitespace counts as punctuation.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.sources.reference_data import (CLIENT_NAME_RULES, DEFAULT_ZONE_CODE, SPANISH_LOWER_WORDS,
                                              ZONE_ALIASES)

# FIXED VALUES: transliterations that are not "base letter + accent".
SPECIAL_TRANSLIT = [
    ("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"), ("ø", "o"), ("Ø", "O"),
    ("đ", "d"), ("Đ", "D"), ("ł", "l"), ("Ł", "L"), ("þ", "th"), ("Þ", "Th"), ("ð", "d"), ("Ð", "D"),
    ("ı", "i"),
]


def _accent_table() -> tuple[str, str]:
    src, dst = [], []
    for cp in range(0x00C0, 0x0250):
        ch = chr(cp)
        d = unicodedata.normalize("NFD", ch)
        if len(d) > 1 and d[0].isascii() and d[0].isalpha() and all(unicodedata.combining(x) for x in d[1:]):
            src.append(ch)
            dst.append(d[0])
    # one-letter transliterations join the translate table; longer ones stay replacements
    for a, b in SPECIAL_TRANSLIT:
        if len(b) == 1:
            src.append(a)
            dst.append(b)
    return "".join(src), "".join(dst)


ACCENTED, UNACCENTED = _accent_table()
MULTI_TRANSLIT = [(a, b) for a, b in SPECIAL_TRANSLIT if len(b) > 1]
WS = r"[ \t\n\x0B\f\r]"
NON_WORD = r"[^A-Za-z0-9_ \t\n\x0B\f\r]"


def unaccent(c: Column) -> Column:
    out = F.translate(c, ACCENTED, UNACCENTED)
    for a, b in MULTI_TRANSLIT:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def squeeze(c: Column) -> Column:
    """Collapse whitespace runs to one space and trim."""
    return F.regexp_replace(F.regexp_replace(c, WS + "+", " "), "^ | $", "")


def normalize_text(c: Column) -> Column:
    """trim -> unaccent -> lower -> punctuation to space -> squeeze; NULL -> ''."""
    s = F.coalesce(c, F.lit(""))
    s = F.lower(unaccent(F.regexp_replace(s, "^" + WS + "+|" + WS + "+$", "")))
    return squeeze(F.regexp_replace(s, NON_WORD, " "))


def lower_unaccent(c: Column) -> Column:
    """lower(unaccent(c)) - the warehouse's normalised name column (L-2)."""
    return F.lower(unaccent(c))


def _title_char(ch: Column) -> Column:
    """Title case of one character: upper case, except sharp s which titles as 'Ss'."""
    return F.when(ch == "ß", F.lit("Ss")).otherwise(F.upper(ch))


def title_case_spanish(c: Column) -> Column:
    """Capitalise words except the Spanish particles (not in first position).

    NULL or blank input is returned unchanged.
    """
    words = F.split(F.regexp_replace(F.lower(c), "^" + WS + "+|" + WS + "+$", ""), WS + "+")
    small = F.array(*[F.lit(w) for w in SPANISH_LOWER_WORDS])
    cap = F.transform(words, lambda w, i: F.when((i == 0) | ~F.array_contains(small, w),
                                                 F.concat(_title_char(F.substring(w, 1, 1)), F.substr(w, F.lit(2))))
                      .otherwise(w))
    blank = F.regexp_replace(c, "^" + WS + "+|" + WS + "+$", "") == ""
    return F.when(c.isNull() | blank, c).otherwise(F.array_join(cap, " "))


def clean_client_name(c: Column) -> Column:
    """Trim, squeeze spaces, expand the abbreviation list (case-insensitive, in order)."""
    s = F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""), r"(?U)\s+", " ")
    for pattern, repl in CLIENT_NAME_RULES:
        s = F.regexp_replace(s, "(?iU)" + pattern, repl)
    return F.regexp_replace(s, r"(?U)^\s+|\s+$", "")


def clean_tax_id(c: Column) -> Column:
    """Keep digits and dashes; valid when 9 or 11 digits remain, else NULL (L-9)."""
    kept = F.regexp_replace(F.trim(c), r"(?U)[^\d\-]", "")
    n = F.length(F.regexp_replace(kept, r"(?U)\D", ""))
    return F.when(c.isNull() | (F.trim(c) == ""), F.lit(None).cast("string")) \
        .when(n.isin(9, 11), kept).otherwise(F.lit(None).cast("string"))


def zone_code(c: Column) -> Column:
    """Zone alias -> zone code via a literal map; unknown or NULL -> CAP (L-5)."""
    m = F.create_map(*[x for a, z in ZONE_ALIASES for x in (F.lit(a), F.lit(z))])
    return F.when(c.isNull(), F.lit(DEFAULT_ZONE_CODE)) \
        .otherwise(F.coalesce(F.try_element_at(m, normalize_text(c)), F.lit(DEFAULT_ZONE_CODE)))


def truncate(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def first_existing(columns: list[str], *candidates: str) -> str | None:
    """Name of the first candidate column present (plan-time helper, L-18)."""
    return next((x for x in candidates if x in columns), None)
