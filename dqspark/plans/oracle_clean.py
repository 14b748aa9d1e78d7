"""DuckDB oracle for the cleaning chain: one CTE per rule, same order."""

from __future__ import annotations

from dqspark.functions import constants as K
from dqspark.operators.clean import DIRTY_CONFIG, CleanConfig
from dqspark.plans import oracle as O

PH = K.PLACEHOLDER
TOKENS = "(" + ", ".join("'" + t.replace("'", "''") + "'" for t in K.DISGUISED_NULL_TOKENS) + ")"


def jz(x: str) -> str:
    s = O.strip(x)
    return f"coalesce({s} <> '' and ({O.junk(s)} or {s} = '0'), false)"


def chain(cfg: CleanConfig = DIRTY_CONFIG, cols=None, src: str = O.D):
    """Return (cte_sql, final_select_list, sweep_cols, fill_cols, text_cols)."""
    r = cfg.roles
    cols = list(cols or O.D_COLS)
    text = cols
    sweep = [c for c in text if c not in cfg.sweep_excluded()]
    fill = [c for c in text if c not in cfg.fill_excluded()]
    alias_in = ", ".join(f"'{k}'" for k in cfg.aliases)
    alias_case = " ".join(f"when '{k}' then '{v}'" for k, v in cfg.aliases.items())
    d, p, s, m = r.director, r.phone, r.supervisor, r.municipality
    dep = r.department
    ctes = [
        f"s0 as (select * from {src} t)",
        f"s1 as (select * replace (case when {d} is null or {jz(d)} then '{PH}' else {d} end as {d}), "
        f"{d} is null as m1_missing, {jz(d)} as m1_junk from s0)",
        f"s2 as (select * replace (case when {p} is null or not {O.phone_ok(p)} then '{PH}' else {p} end as {p}), "
        f"{p} is null as m2_missing, coalesce({p} is not null and not {O.phone_ok(p)}, false) as m2_bad from s1)",
        f"s3 as (select * replace (case when coalesce({O.zero_typo(s)}, false) then {O.fix_zero_typo(s)} "
        f"when {s} is null then '{PH}' else {s} end as {s}), {s} is null as m3_filled, "
        f"coalesce({O.zero_typo(s)}, false) as m3_typo from s2)",
        f"s3b as (select * replace (case when {jz(s)} then '{PH}' else {s} end as {s}), {jz(s)} as m3_junk from s3)",
        f"s4 as (select * replace (case when coalesce({O.zone(O.strip(m))}, false) then '{cfg.zone_replacement}' "
        f"else {m} end as {m}), coalesce({O.zone(O.strip(m))}, false) as m4_zone from s3b)",
        f"s5 as (select * replace (case upper({O.strip(dep)}) {alias_case} else {dep} end as {dep}), "
        f"coalesce(upper({O.strip(dep)}) in ({alias_in}), false) as m5_alias from s4)",
    ]
    m6 = {c: f"coalesce({c} is not null and ({O.junk_ext(c)} or upper({O.strip(c)}) in {TOKENS}) "
             f"and {c} <> '{PH}', false)" for c in sweep}
    rep6 = ", ".join(f"case when {m6[c]} then '{PH}' else {c} end as {c}" for c in sweep)
    extra6 = ", ".join(f"{m6[c]} as m6_{i}, case when {m6[c]} then {c} end as v6_{i}" for i, c in enumerate(sweep))
    ctes.append(f"s6 as (select * replace ({rep6}), {extra6} from s5)")
    rep7 = ", ".join(f"coalesce({c}, '{PH}') as {c}" for c in fill)
    extra7 = ", ".join(f"{c} is null as m7_{i}" for i, c in enumerate(fill))
    ctes.append(f"s7 as (select * replace ({rep7}), {extra7} from s6)")
    new = {c: f"case when {c} is null then null else {O.collapse(O.strip(c))} end" for c in text}
    rep8 = ", ".join(f"{new[c]} as {c}" for c in text)
    changed = " + ".join(f"cast(coalesce({c} is not null and {new[c]} <> {c}, false) as integer)" for c in text)
    ctes.append(f"s8 as (select * replace ({rep8}), {changed} as ws_changed from s7)")
    return ",\n".join(ctes), cols, sweep, fill, text


def clean_all_sql(cfg: CleanConfig = DIRTY_CONFIG, cols=None, src: str = O.D) -> str:
    ctes, cols, *_ = chain(cfg, cols, src)
    return f"with {ctes}\nselect {', '.join(cols)} from s8"


def transformation_log_sql(cfg: CleanConfig = DIRTY_CONFIG, cols=None, src: str = O.D) -> str:
    r = cfg.roles
    ctes, cols, sweep, fill, text = chain(cfg, cols, src)
    n = lambda m: f"count(*) filter (where {m})"
    counts = ", ".join([
        f"{n('m1_missing')} as n1_missing", f"{n('m1_junk')} as n1_junk",
        f"{n('m1_missing or m1_junk')} as n1_total",
        f"{n('m2_missing')} as n2_missing", f"{n('m2_bad')} as n2_bad",
        f"{n('m2_missing or m2_bad')} as n2_total",
        f"{n('m3_filled')} as n3_filled", f"{n('m3_typo')} as n3_typo", f"{n('m3_junk')} as n3_junk",
        f"{n('m4_zone')} as n4_zone", f"{n('m5_alias')} as n5_alias",
        *[f"{n(f'm6_{i}')} as n6_{i}" for i in range(len(sweep))],
        *[f"{n(f'm7_{i}')} as n7_{i}" for i in range(len(fill))],
        "cast(sum(ws_changed) as bigint) as n10_ws",
    ])
    ex = " union all ".join(
        f"select {i} as i, string_agg(v, ', ' order by v) as ex from "
        f"(select distinct v6_{i} as v from s8 where v6_{i} is not null order by v limit 5)"
        for i in range(len(sweep)))
    cols_ = "step, sub, variable, problem, action, affected, justification"
    rows = [
        f"select 1 as step, 0 as sub, '{r.director}' as variable, 'missing=' || n1_missing || ' no_content=' || n1_junk "
        f"as problem, 'set {PH}' as action, n1_total as affected, 'row kept' as justification from c",
        f"select 2, 0, '{r.phone}', 'missing=' || n2_missing || ' wrong_format=' || n2_bad, 'set {PH}', n2_total, "
        f"'row kept' from c",
        f"select 3, 0, '{r.supervisor}', 'typo=' || n3_typo || ' no_content=' || n3_junk || ' filled=' || n3_filled, "
        f"'0 to O, else set {PH}', n3_typo + n3_junk, 'spelling' from c",
        f"select 4, 0, '{r.municipality}', 'zone=' || n4_zone, 'set {cfg.zone_replacement}', n4_zone, "
        f"'unit is the municipality' from c",
        f"select 5, 0, '{r.department}', 'alias=' || n5_alias, 'set catalogue name', n5_alias, 'same entity' from c",
        *[f"select 6, {i}, '{col}', 'no_content=' || n6_{i} || ' e.g. ' || coalesce((select ex from e where i = {i}), ''), "
          f"'set {PH}', n6_{i}, 'no information' from c where n6_{i} > 0" for i, col in enumerate(sweep)],
        *[f"select 7, {i}, '{col}', 'missing=' || n7_{i}, 'set {PH}', n7_{i}, 'no empty cell' from c where n7_{i} > 0"
          for i, col in enumerate(fill)],
        f"select 8, 0, '{r.district}', 'shapes=' || n_signatures || ' off_main=' || off_pattern || ' main=' || most_common, "
        f"'none', 0, 'identifier' from dist",
        *[f"select 9, {i}, '{col}', 'none', '', 0, ''" for i, col in enumerate(cfg.no_issue_columns)],
        "select 10, 0, 'all text columns', 'cells=' || n10_ws, 'strip, one space for runs', n10_ws, 'spacing' from c",
    ]
    dist = (f"dist as (with sg as (select {O.signature(O.strip(r.district))} as signature, count(*) as n "
            f"from s0 where {r.district} is not null group by all) "
            f"select count(*) as n_signatures, arg_min(signature, (-n, signature)) as most_common, "
            f"sum(n) - max(n) as off_pattern from sg)")
    return (f"with {ctes},\nc as (select {counts} from s8),\ne as ({ex}),\n{dist}\n"
            f"select cast(step as integer) as step, cast(sub as integer) as sub, variable, problem, action, "
            f"cast(affected as bigint) as affected, justification from ("
            + "\nunion all ".join(rows) + f") t({cols_})")


def _fixed_sup(s: str) -> str:
    return (f"(case when coalesce({O.zero_typo(s)}, false) then {O.fix_zero_typo(s)} "
            f"when {s} is null then '{PH}' else {s} end)")


def rule_after_exprs(rule: str, cfg: CleanConfig = DIRTY_CONFIG) -> dict:
    """Column -> DuckDB expression of the value after one rule on raw input."""
    r = cfg.roles
    _, _, sweep, fill, text = chain(cfg)
    if rule == "placeholder_junk":
        d = r.director
        return {d: f"case when {d} is null or {jz(d)} then '{PH}' else {d} end"}
    if rule == "phone":
        p = r.phone
        return {p: f"case when {p} is null or not {O.phone_ok(p)} then '{PH}' else {p} end"}
    if rule == "zero_typo":
        f = _fixed_sup(r.supervisor)
        return {r.supervisor: f"case when {jz(f)} then '{PH}' else {f} end"}
    if rule == "zone":
        m = r.municipality
        return {m: f"case when coalesce({O.zone(O.strip(m))}, false) then '{cfg.zone_replacement}' else {m} end"}
    if rule == "alias":
        dep = r.department
        alias_case = " ".join(f"when '{k}' then '{v}'" for k, v in cfg.aliases.items())
        return {dep: f"case upper({O.strip(dep)}) {alias_case} else {dep} end"}
    if rule == "general_junk":
        return {c: f"case when coalesce({c} is not null and ({O.junk_ext(c)} or upper({O.strip(c)}) in {TOKENS}) "
                   f"and {c} <> '{PH}', false) then '{PH}' else {c} end" for c in sweep}
    if rule == "fill_missing":
        return {c: f"coalesce({c}, '{PH}')" for c in fill}
    if rule == "whitespace":
        return {c: f"case when {c} is null then null else {O.collapse(O.strip(c))} end" for c in text}
    raise KeyError(rule)


def rule_changes_sql(rule: str, cfg: CleanConfig = DIRTY_CONFIG) -> str:
    key = cfg.roles.key
    parts = [f"select {key} as key, '{c}' as variable, {c} as before, {e} as after from {O.D} t"
             for c, e in rule_after_exprs(rule, cfg).items()]
    return ("select * from (" + " union all ".join(parts) + ") x where before is distinct from after")
