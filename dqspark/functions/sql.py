"""The text predicates and transforms as functions of Spark SQL.

``register(spark)`` creates temporary SQL functions, which Catalyst inlines
like the column expressions of ``functions.text``.  Null gives what the column form gives.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from dqspark.functions import category
from dqspark.functions import constants as K
from dqspark.functions import text as tx


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _bodies() -> dict[str, tuple[str, str]]:
    """Return type and body (over the argument ``v``) by name, each after those it refers to."""
    def matches(pattern: str) -> tuple[str, str]:
        return "boolean", f"v rlike {literal(pattern)}"

    tokens = ", ".join(literal(t) for t in K.DISGUISED_NULL_TOKENS)
    letters_or_digits = literal("[0-9A-Za-zÀ-ÿ]")
    mapped, to, several = category.tables()
    long = ", ".join(literal(x) for pair in several.items() for x in pair)
    return {
        "ws_strip": ("string", f"btrim(v, {literal(tx.WS_CHARS)})"),
        "normalize_ws": ("string", f"regexp_replace(ws_strip(v), {literal(tx.J_MULTI_WS)}, ' ')"),
        "has_edge_ws": matches(tx.J_EDGE_WS),
        "has_multi_ws": matches(tx.J_MULTI_WS),
        "has_corrupt_char": ("boolean", f"contains(v, {literal(K.CORRUPT_CHAR)})"),
        "is_junk": matches(tx.J_JUNK),
        "is_junk_ext": matches(tx.J_JUNK_EXT),
        "is_invalid_name": ("boolean", "coalesce(ws_strip(v) <> '' and (ws_strip(v) rlike "
                                       f"{literal(tx.J_JUNK)} or ws_strip(v) rlike {literal(tx.J_DIGIT)}), false)"),
        "is_junk_or_zero": ("boolean", "coalesce(ws_strip(v) <> '' and (ws_strip(v) rlike "
                                       f"{literal(tx.J_JUNK)} or ws_strip(v) = '0'), false)"),
        "is_disguised_null": ("boolean", f"ws_strip(upper(v)) in ({tokens})"),
        "matches_key": matches(tx.J_KEY),
        "matches_phone": matches(tx.J_PHONE),
        "matches_zone": matches(tx.J_ZONE),
        "has_zero_typo": matches(tx.J_ZERO_TYPO),
        "fix_zero_typo": ("string", f"regexp_replace(v, {literal(tx.J_ZERO_TYPO_FIX)}, 'O')"),
        "shape_signature": ("string", f"regexp_replace(v, {letters_or_digits}, 'A')"),
        "token_sort": ("string", "case when ws_strip(v) = '' then '' else array_join(array_sort(split(ws_strip(v), "
                                 f"{literal(tx.J_SPLIT_WS)})), ' ') end"),
        "without_marks": ("string", f"translate(case when v rlike {literal('[' + ''.join(several) + ']')} then array_join(transform("
                                    f"regexp_extract_all(v, '(?s).', 0), c -> coalesce(element_at(map({long}), c), c)), '') "
                                    f"else v end, {literal(mapped)}, {literal(to)})"),
        "category_key": ("string", "btrim(regexp_replace(case when upper(ws_strip(v)) rlike '[^\\\\x00-\\\\x7f]' "
                                   "then without_marks(upper(ws_strip(v))) else upper(ws_strip(v)) end, '[^A-Z0-9]+', ' '))"),
    }


NAMES = tuple(_bodies())


def register(spark: SparkSession) -> None:
    """Create (or replace) the functions in the session."""
    for name, (kind, body) in _bodies().items():
        spark.sql(f"create or replace temporary function {name}(v string) returns {kind} return {body}")
