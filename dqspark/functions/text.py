"""String predicates and transforms as built-in Spark column expressions.

Every function takes a column name or ``Column`` and returns a ``Column`` so
that rules stay inside whole-stage codegen.  Regular expressions are Java
translations of the Python patterns in ``constants``:

* ``(?U)`` gives Java the Unicode ``\\s``/``\\d`` classes Python uses for
  ``str`` patterns; Python's ``str.strip``/``\\s`` also treat U+001C..U+001F
  as whitespace, so the whitespace class adds them explicitly.
* ``(?d)`` makes ``$`` behave like Python's (only ``\\n`` ends a line).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dqspark.functions import constants as K

WS = r"[\s\x{1c}-\x{1f}]"
WS_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())   # what str.strip() removes


def java(pattern: str, flags: str = "dU") -> str:
    """The Java spelling of a Python pattern of ``constants``."""
    return f"(?{flags})" + pattern.replace(r"\s", WS)


J_MULTI_WS = java(K.MULTI_WS_PATTERN, "U")
J_EDGE_WS = java(r"^\s|\s$")
J_JUNK = java(K.JUNK_PATTERN)
J_JUNK_EXT = java(K.JUNK_EXT_PATTERN)
J_KEY = java(K.KEY_PATTERN)
J_PHONE = java(K.PHONE_PATTERN)
J_ZONE = java(K.ZONE_PATTERN, "idU")
J_ZERO_TYPO = K.ZERO_TYPO_PATTERN
J_ZERO_TYPO_FIX = K.ZERO_TYPO_PATTERN.replace("[A-Za-zÀ-ÿ]", "(?<=[A-Za-zÀ-ÿ])")
J_DIGIT = java(K.DIGIT_PATTERN, "U")
J_LETTER = K.LETTER_PATTERN
J_SIG_DIGIT = r"[0-9]"
J_SIG_LETTER = r"[A-Za-zÀ-ÿ]"
J_SPLIT_WS = java(r"\s+", "U")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ws_strip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def collapse_ws(c) -> Column:
    """Replace runs of two or more whitespace characters by one space."""
    return F.regexp_replace(_c(c), J_MULTI_WS, " ")


def normalize_ws(c) -> Column:
    """Strip, then collapse internal whitespace runs (a lone tab stays)."""
    return collapse_ws(ws_strip(c))


def has_edge_ws(c) -> Column:
    return _c(c).rlike(J_EDGE_WS)


def has_multi_ws(c) -> Column:
    return _c(c).rlike(J_MULTI_WS)


def has_corrupt_char(c) -> Column:
    return _c(c).contains(K.CORRUPT_CHAR)


def is_junk(c) -> Column:
    """Only separators/whitespace (base class); null stays null."""
    return _c(c).rlike(J_JUNK)


def is_junk_ext(c) -> Column:
    """Extended separator class (adds , ; :); no strip, so blanks are junk."""
    return _c(c).rlike(J_JUNK_EXT)


def is_invalid_name(c) -> Column:
    """Stripped value is junk or contains a digit; empty or null -> False."""
    s = ws_strip(c)
    return F.coalesce((s != "") & (s.rlike(J_JUNK) | s.rlike(J_DIGIT)), F.lit(False))


def is_junk_or_zero(c) -> Column:
    """Stripped value is junk or exactly ``0``; empty or null -> False."""
    s = ws_strip(c)
    return F.coalesce((s != "") & (s.rlike(J_JUNK) | (s == "0")), F.lit(False))


def is_disguised_null(c) -> Column:
    return ws_strip(F.upper(_c(c))).isin(list(K.DISGUISED_NULL_TOKENS))


def matches_key(c) -> Column:
    return _c(c).rlike(J_KEY)


def matches_phone(c) -> Column:
    return _c(c).rlike(J_PHONE)


def matches_zone(c) -> Column:
    return _c(c).rlike(J_ZONE)


def has_zero_typo(c) -> Column:
    return _c(c).rlike(J_ZERO_TYPO)


def fix_zero_typo(c) -> Column:
    return F.regexp_replace(_c(c), J_ZERO_TYPO_FIX, "O")


def shape_signature(c, keep_digit_class: bool = False) -> Column:
    """Shape of a value: digits -> ``N``, letters -> ``A``.

    The original replaced digits by ``N`` and then every letter (``N``
    included) by ``A``, so digits and letters end up alike; that is the
    default here.  ``keep_digit_class=True`` keeps ``N`` and ``A`` apart.
    """
    if keep_digit_class:
        return F.regexp_replace(
            F.regexp_replace(_c(c), J_SIG_LETTER, "A"), J_SIG_DIGIT, "N")
    return F.regexp_replace(_c(c), r"[0-9A-Za-zÀ-ÿ]", "A")


def token_sort(c) -> Column:
    """Whitespace tokens sorted by code point and joined with one space."""
    s = ws_strip(c)
    return F.when(s == "", F.lit("")).otherwise(
        F.array_join(F.array_sort(F.split(s, J_SPLIT_WS)), " "))


def not_in_catalog(c, catalog) -> Column:
    """Catalogue check; an empty/None catalogue disables it (always False)."""
    if not catalog:
        return F.lit(False)
    return ~_c(c).isin(list(catalog))
