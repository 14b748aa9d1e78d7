"""DuckDB SQL fragments for the correctness oracle.

The fixed patterns are used as they are, but for the look-ahead, which RE2
lacks; RE2's ASCII ``\\s`` agrees with the Java patterns on the driver data
(it holds no exotic whitespace).
"""

from __future__ import annotations

from dqspark.functions import constants as K
from dqspark.sources.tables import DIRTY_COLUMNS, dirty_sql_for_duckdb

D = f"({dirty_sql_for_duckdb()})"
D_COLS = list(DIRTY_COLUMNS)


def lst(cols) -> str:
    return "[" + ", ".join(f"'{c}'" for c in cols) + "]"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def collapse(x: str) -> str:
    return rf"regexp_replace({x}, '\s{{2,}}', ' ', 'g')"


def junk(x: str) -> str:
    return f"regexp_matches({x}, '{K.JUNK_PATTERN}')"


def junk_ext(x: str) -> str:
    return f"regexp_matches({x}, '{K.JUNK_EXT_PATTERN}')"


def has_digit(x: str) -> str:
    return f"regexp_matches({x}, '{K.DIGIT_PATTERN}')"


def key_ok(x: str) -> str:
    return f"regexp_matches({x}, '{K.KEY_PATTERN}')"


def phone_ok(x: str) -> str:
    return f"regexp_matches({x}, '{K.PHONE_PATTERN}')"


def zone(x: str) -> str:
    return f"regexp_matches({x}, '{K.ZONE_PATTERN}', 'i')"


def zero_typo(x: str) -> str:
    return rf"regexp_matches({x}, '[A-Za-zÀ-ÿ]0([^0-9]|$)')"


def fix_zero_typo(x: str) -> str:
    once = rf"regexp_replace({x}, '([A-Za-zÀ-ÿ])0([^0-9]|$)', '\1O\2', 'g')"
    return rf"regexp_replace({once}, '([A-Za-zÀ-ÿ])0([^0-9]|$)', '\1O\2', 'g')"


def edge_ws(x: str) -> str:
    return rf"regexp_matches({x}, '^\s|\s$')"


def multi_ws(x: str) -> str:
    return f"regexp_matches({x}, '{K.MULTI_WS_PATTERN}')"


def signature(x: str) -> str:
    return rf"regexp_replace({x}, '[0-9A-Za-zÀ-ÿ]', 'A', 'g')"


def category_key(x: str) -> str:
    return (rf"{strip(rf'''regexp_replace(strip_accents(upper({strip(x)})), '[^A-Z0-9]+', ' ', 'g')''')}")


def vf(cols=None, src: str = D) -> str:
    cols = cols or D_COLS
    return (f"(select variable, list_position({lst(cols)}, variable) as pos, value, count(*) as n "
            f"from (select * from (select {', '.join(cols)} from {src}) "
            f"unpivot include nulls (value for variable in ({', '.join(cols)}))) "
            f"group by variable, value)")


def token_sort(x: str) -> str:
    s = strip(x)
    return rf"(case when {s} = '' then '' else array_to_string(list_sort(regexp_split_to_array({s}, '\s+')), ' ') end)"


def lcs(a: str, b: str) -> str:
    """Exact LCS length in DuckDB SQL (dynamic program as nested list_reduce)."""
    return (f"list_extract(list_reduce(list_transform(string_split({a}, ''), lambda ch: [unicode(ch)]), "
            f"lambda p, x: list_reduce(list_transform(range(1, length({b}) + 1), lambda j: [j]), "
            f"lambda q, j: list_append(q, case when x[1] = unicode(substr({b}, j[1], 1)) "
            f"then p[j[1]] + 1 else greatest(p[j[1] + 1], q[-1]) end), [0]), "
            f"list_resize([0], length({b}) + 1, 0)), -1)")


def _texts_sql(name, address, gcols, blocks, src) -> str:
    nn = " and ".join(f"{c} is not null" for c in (name, address, *blocks))
    text = f"upper({strip(name)}) || ' | ' || upper({strip(address)})"
    return f"(select *, {token_sort(text)} as ts from {src} t where {nn})"


def fuzzy_pairs_sql(name="name", address="address", blocks=("department", "municipality"),
                    diffs=("director", "sector"), t=95, src: str = D) -> str:
    gcols = [*blocks, *diffs]
    on = " and ".join(f"a.{c} is not distinct from b.{c}" for c in gcols)
    return f"""
with d as (select {', '.join(gcols)}, ts, count(*) as m from {_texts_sql(name, address, gcols, blocks, src)} x group by all),
p as (select {', '.join(f'a.{c}' for c in gcols)}, a.ts as ta, b.ts as tb, a.m as ma, b.m as mb
      from d a join d b on {on} and a.ts < b.ts
      where least(length(a.ts), length(b.ts)) * 200 >= {t} * (length(a.ts) + length(b.ts))),
u as (select distinct ta, tb from p),
s as (select ta, tb, {lcs('ta', 'tb')} as lcs from u)
select {', '.join(gcols)}, p.ta as text_1, p.tb as text_2,
       round_even(200.0 * s.lcs / (length(p.ta) + length(p.tb)), 1) as similarity,
       ma as rows_1, mb as rows_2, ma * mb as pairs
from p join s on p.ta = s.ta and p.tb = s.tb where 200 * s.lcs >= {t} * (length(p.ta) + length(p.tb))
union all
select {', '.join(gcols)}, ts, ts, 100.0, m, m, m * (m - 1) // 2 from d where m > 1
"""


def fuzzy_members_sql(key="code", name="name", address="address", blocks=("department", "municipality"),
                      diffs=("director", "sector"), src: str = D) -> str:
    gcols = [*blocks, *diffs]
    return f"select {key}, {', '.join(gcols)}, ts as text from {_texts_sql(name, address, gcols, blocks, src)} x"


def candidate_members_sql(key="code", name="name", address="address", blocks=("department", "municipality"),
                          diffs=("director", "sector"), src: str = D) -> str:
    gcols = [*blocks, *diffs]
    same = " and ".join(f"p.{c} is not distinct from x.{c}" for c in gcols)
    return f"""
with p as ({fuzzy_pairs_sql(name, address, blocks, diffs, src=src)})
select {key}, {name}, {address}, {', '.join(gcols)}, ts as text from {_texts_sql(name, address, gcols, blocks, src)} x
where exists (select 1 from p where {same} and x.ts in (p.text_1, p.text_2))
"""


def lev_prefilter_sql(name="name", address="address", blocks=("department", "municipality"),
                      diffs=("director", "sector"), t=95, src: str = D) -> str:
    gcols = [*blocks, *diffs]
    nn = " and ".join(f"{c} is not null" for c in (name, address, *blocks))
    text = f"upper({strip(name)}) || ' | ' || upper({strip(address)})"
    on = " and ".join([*(f"a.{c} = b.{c}" for c in blocks), *(f"a.{c} is not distinct from b.{c}" for c in diffs)])
    return f"""
with d as (select distinct {', '.join(gcols)}, {token_sort(text)} as ts from {src} t where {nn}),
p as (select {', '.join(f'a.{c}' for c in gcols)}, a.ts as ta, b.ts as tb, levenshtein(a.ts, b.ts) as lev
      from d a join d b on {on} and a.ts < b.ts)
select {', '.join(gcols)}, ta, tb, cast(lev as integer) as lev,
       round_even(200.0 * {lcs('ta', 'tb')} / (length(ta) + length(tb)), 1) as similarity
from p where lev <= floor((length(ta) + length(tb)) * {100 - t} / 100)
"""
