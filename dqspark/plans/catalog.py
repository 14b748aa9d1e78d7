"""Registered queries: one Spark plan per operator, each with its DuckDB oracle.

Every query reads the driver tables (or the dirty registry Spark derives
from them) in full; none runs on fixed input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqspark.functions import constants as K
from dqspark.functions import sql as SQLF
from dqspark.functions import text as tx
from dqspark.functions.similarity import lcs_udf, similarity_from_lcs
from dqspark.functions.text import normalize_ws
from dqspark.operators import clean, consistency, dedupe, domain, profile, state, variants
from dqspark.plans import diagnosis, registry_flow
from dqspark.plans import oracle as O
from dqspark.plans import oracle_clean as OC
from dqspark.session import scratch_dir, written
from dqspark.sources import html as HTML
from dqspark.sources import ingest as ING
from dqspark.sources import landing as LND
from dqspark.sources.tables import DIRTY_ROLES as R
from dqspark.sources.sinks import export_verified
from dqspark.sources.tables import (REGISTRY_COLUMNS, REGISTRY_SQL, Roles, department_catalog, dirty_registry,
                                    dirty_sql_for_duckdb, full_registry, read_registry_csv, table)
from dqspark.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    if sql is not None:
        ORACLE[name] = sql.strip()

    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _vf(spark, sf_dir, write: bool = False):
    vf = profile.value_freq(dirty_registry(spark, sf_dir))
    return written(vf, "value-freq") if write else vf     # written: read by several branches of one plan


D, VF = O.D, O.vf()

# ---------------------------------------------------------------- A1 / A2
register("profile_shape", f"""
select 'rows' as metric, count(*) as value from {D}
union all select 'columns' as metric, cast({len(O.D_COLS)} as bigint) as value
""")(lambda spark, sf: profile.shape(dirty_registry(spark, sf)))

register("profile_types", f"""
select cast(row_number() over () as integer) as pos, column_name as variable,
       case column_type when 'VARCHAR' then 'string' when 'BIGINT' then 'bigint'
            when 'INTEGER' then 'int' when 'DOUBLE' then 'double' else lower(column_type) end as type,
       (select cast(coalesce(sum(n), 0) as bigint) from {VF} v where v.variable = column_name and value is not null) as present
from (describe {D})
""")(lambda spark, sf: profile.column_stats(dirty_registry(spark, sf)).select(
    "pos", "variable", "type", (F.col("rows") - F.col("missing")).alias("present")))

# ---------------------------------------------------------------- A3 / A4
register("profile_missing", f"""
select variable, pos, cast(sum(case when value is null then n else 0 end) as bigint) as missing,
       round(cast(sum(case when value is null then n else 0 end) as double) * 100 / sum(n), 2) as missing_pct
from {VF} v group by variable, pos
""")(lambda spark, sf: profile.missing(dirty_registry(spark, sf)))

register("profile_distinct", f"""
select variable, pos, count(value) as distinct_values from {VF} v group by variable, pos
""")(lambda spark, sf: profile.distinct_counts(_vf(spark, sf)))

# ---------------------------------------------------------------- A5 / A6
_DOC_COLS = ["lang", "source", "text"]


def _docs(spark, sf):
    return table(spark, sf, "documents").select(*_DOC_COLS)


def _by_loads(spark, sf):
    """The profile of the dirty registry as three loads: one put twice, and a fourth one taken out again."""
    d = dirty_registry(spark, sf)
    kept = state.ProfileState(spark, scratch_dir(spark, "profile-state"), d.columns)
    load = F.pmod(F.xxhash64(R.key), F.lit(3))
    for name, rows in (("0", load == 0), ("1", load == 1), ("2", load == 2), ("again", load == 0)):
        kept.put(name, d.where(rows))
    kept.put("1", d.where(load == 1))
    kept.remove("again")
    return kept


def q_profile_state(spark, sf):
    kept = _by_loads(spark, sf)
    return (kept.column_stats().select("variable", "pos", "rows", "missing")
            .join(profile.distinct_counts(kept.value_freq()).select("variable", "distinct_values"), "variable"))


register("profile_state", f"""
select variable, pos, cast(sum(n) as bigint) as rows,
       cast(sum(case when value is null then n else 0 end) as bigint) as missing, count(value) as distinct_values
from {VF} v group by variable, pos
""")(q_profile_state)


def q_distinct_sketches(spark, sf):
    """Distinct values by united sketches of the loads, against the exact counts: within 3 % (over three standard errors)."""
    kept = _by_loads(spark, sf)
    exact = profile.distinct_counts(kept.value_freq()).withColumnRenamed("distinct_values", "exact")
    return kept.distinct_approx().join(exact, ["variable", "pos"]).select(
        "variable", "pos", "exact", (F.abs(F.col("distinct_values") - F.col("exact")) <= 0.03 * F.col("exact")).alias("close"))


register("distinct_sketches", f"""
select variable, pos, count(value) as exact, true as close from {VF} v group by variable, pos
""")(q_distinct_sketches)


register("duplicate_count", """
select cast(coalesce(sum(n - 1), 0) as bigint) as duplicates
from (select lang, source, text, count(*) as n from documents group by lang, source, text)
""")(lambda spark, sf: profile.duplicate_count(_docs(spark, sf)))

register("duplicate_examples", """
with g as (select lang, source, text, count(*) as n from documents group by lang, source, text having count(*) > 1
           order by lang nulls last, source nulls last, text nulls last limit 10)
select lang, source, text from g, range(least(n, 10))
order by lang nulls last, source nulls last, text nulls last limit 10
""")(lambda spark, sf: profile.duplicate_examples(_docs(spark, sf)))

# ---------------------------------------------------------------- A11 / A12
register("profile_format", f"""
with v as (select * from {VF} x where value is not null),
a as (select variable, pos,
        cast(sum(case when {O.edge_ws('value')} then n else 0 end) as bigint) as edge_ws,
        cast(sum(case when {O.multi_ws('value')} then n else 0 end) as bigint) as multi_ws,
        cast(sum(case when contains(value, '{K.CORRUPT_CHAR}') then n else 0 end) as bigint) as corrupt,
        case when variable = '{R.phone}' then cast(sum(case when regexp_matches(value, '[A-Za-z]') then n else 0 end) as bigint) end as letters
      from v group by variable, pos),
e as (select variable, string_agg(value, ', ' order by value) as corrupt_examples
      from (select variable, value, row_number() over (partition by variable order by value) as rn
            from v where contains(value, '{K.CORRUPT_CHAR}')) where rn <= 5 group by variable)
select a.*, coalesce(e.corrupt_examples, '') as corrupt_examples from a left join e using (variable)
""")(lambda spark, sf: profile.format_issues(dirty_registry(spark, sf), phone_column=R.phone))

register("profile_letters", f"""
select '{R.phone}' as variable,
       cast(count(*) filter (where regexp_matches({R.phone}, '[A-Za-z]')) as bigint) as letters
from {D}
""")(lambda spark, sf: profile.letters_in_numeric(dirty_registry(spark, sf), R.phone))

# ---------------------------------------------------------------- P8
register("junk_values", f"""
select variable, value, n from {VF} v where {O.junk('value')}
""")(lambda spark, sf: _vf(spark, sf).where(tx.is_junk("value")).select("variable", "value", "n"))

# ---------------------------------------------------------------- A7 - A10


def _prep_sql(col: str, upper: bool) -> str:
    s = O.strip("value")
    if upper:
        s = f"upper({s})"
    return (f"(select variable, sv as value, cast(sum(n) as bigint) as n from "
            f"(select variable, {s} as sv, n from {VF} v where variable = '{col}' and value is not null) "
            f"where sv <> '' group by variable, sv)")


_SECTORS = "[" + ", ".join(f"'{s}'" for s in K.SECTORS) + "]"

register("domain_catalog", f"""
select variable, value, n from {_prep_sql(R.department, True)} p
where {O.junk('value')} or {O.has_digit('value')} or value not in (select r_name from region)
union all
select variable, value, n from {_prep_sql(R.sector, True)} p
where {O.junk('value')} or {O.has_digit('value')} or not list_contains({_SECTORS}, value)
""")


def _checks(spark, sf):
    C = domain.Check
    return [C(R.department, domain.CATEGORICAL, department_catalog(spark, sf)),
            C(R.sector, domain.CATEGORICAL, K.SECTORS),
            *[C(c, domain.NAME) for c in _NAME_COLS],
            C(R.key, domain.KEY), C(R.phone, domain.PHONE)]


_NAME_COLS = [R.supervisor, R.director, R.municipality]
QUERIES["domain_catalog"] = lambda spark, sf: domain.violations(_vf(spark, sf), _checks(spark, sf)[:2])

register("domain_names", " union all ".join(
    f"select variable, value, n from {_prep_sql(c, False)} p where {O.junk('value')} or {O.has_digit('value')}"
    for c in _NAME_COLS))(lambda spark, sf: domain.violations(_vf(spark, sf), _checks(spark, sf)[2:5]))

register("domain_code", f"""
select variable, value, n from {_prep_sql(R.key, False)} p where not {O.key_ok('value')} or {O.junk('value')}
""")(lambda spark, sf: domain.key_violations(_vf(spark, sf), R.key))

register("domain_phone", f"""
select variable, value, n from {_prep_sql(R.phone, False)} p where not {O.phone_ok('value')} or {O.junk('value')}
""")(lambda spark, sf: domain.phone_violations(_vf(spark, sf), R.phone))


DOMAIN_VARS = [R.department, R.sector, *_NAME_COLS, R.key, R.phone]
_VIOL = f"""viol as ({ORACLE['domain_catalog']} union all {ORACLE['domain_names']}
              union all {ORACLE['domain_code']} union all {ORACLE['domain_phone']}),
base as (select unnest({O.lst(DOMAIN_VARS)}) as variable, cast(unnest(range(1, {len(DOMAIN_VARS) + 1})) as integer) as pos)"""

register("domain_summary", f"""
with {_VIOL}
select base.variable, base.pos, coalesce(value, '{K.NONE_TEXT}') as value, coalesce(n, 0) as n
from base left join viol using (variable)
""")(lambda spark, sf: domain.report(domain.violations(_vf(spark, sf), _checks(spark, sf)), DOMAIN_VARS))

register("domain_counts", f"""
with {_VIOL}
select base.variable, base.pos, count(value) as invalid_values from base left join viol using (variable) group by all
""")(lambda spark, sf: domain.counts(domain.violations(_vf(spark, sf), _checks(spark, sf)), DOMAIN_VARS))

# ---------------------------------------------------------------- A13 / L5
_SHAPE_COLS = [R.key, R.district]

register("shape_signatures", f"""
select variable, pos, {O.signature(O.strip('value'))} as signature, cast(sum(n) as bigint) as n
from {VF} v where variable in ({', '.join(f"'{c}'" for c in _SHAPE_COLS)}) and value is not null
group by all
""")(lambda spark, sf: profile.shape_signatures(_vf(spark, sf), _SHAPE_COLS))

register("shape_profile", f"""
with v as (select variable, pos, {O.strip('value')} as sv, n from {VF} x
           where variable in ({', '.join(f"'{c}'" for c in _SHAPE_COLS)}) and value is not null),
s as (select variable, pos, {O.signature('sv')} as signature, sum(n) as n from v group by all),
m as (select variable, pos, count(*) as n_signatures, arg_min(signature, (-n, signature)) as most_common,
             sum(n) as total, max(n) as top from s group by variable, pos),
off as (select distinct v.variable, v.sv from v join m using (variable) where {O.signature('v.sv')} <> m.most_common),
e as (select variable, string_agg(sv, ', ' order by sv) as examples
      from (select variable, sv, row_number() over (partition by variable order by sv) as rn from off)
      where rn <= 5 group by variable)
select m.variable, m.pos, m.n_signatures, m.most_common, cast(m.total - m.top as bigint) as off_pattern,
       coalesce(e.examples, '') as examples
from m left join e using (variable)
""")(lambda spark, sf: profile.shape_profile(_vf(spark, sf, write=True), _SHAPE_COLS))

# ---------------------------------------------------------------- A14
def variants_sql(vf_sql: str) -> str:
    return f"""
with v as (select variable, pos, value, {O.category_key('value')} as key from {vf_sql} x where value is not null),
k as (select variable, key, count(*) as n_variants from v group by variable, key having count(*) > 1)
select variable, pos, key, n_variants, value from v join k using (variable, key)
"""


_VARIANTS_SQL = variants_sql(VF)
register("category_variants", _VARIANTS_SQL)(
    lambda spark, sf: variants.variant_groups(_vf(spark, sf, write=True)))

register("category_variant_summary", f"""
with g as ({_VARIANTS_SQL}),
k as (select variable, pos, key, row_number() over (partition by variable order by key) as rn
      from (select distinct variable, pos, key from g)),
s as (select variable, key, string_agg(value, ' | ' order by value) as s
      from (select g.*, row_number() over (partition by variable, key order by value) as vn from g) join k using (variable, key)
      where rn <= 5 and vn <= 5 group by variable, key)
select k.variable, k.pos, count(*) as groups,
       (select string_agg(s, '; ' order by key) from s where s.variable = k.variable) as examples
from k group by k.variable, k.pos
""")(lambda spark, sf: variants.variant_summary(variants.variant_groups(_vf(spark, sf, write=True))))

# ---------------------------------------------------------------- L4
register("top_examples", f"""
select variable, string_agg(value, ', ' order by value) as examples
from (select variable, value, row_number() over (partition by variable order by value) as rn
      from {VF} v where value is not null)
where rn <= 5 group by variable
""")(lambda spark, sf: profile.first_k_values(_vf(spark, sf), "variable", "value"))


# ---------------------------------------------------------------- C1 - C9

_RULE_QUERIES = {
    "clean_placeholder_junk": "placeholder_junk", "clean_phone": "phone",
    "clean_zero_typo": "zero_typo", "clean_zone_municipality": "zone", "clean_alias": "alias",
    "clean_general_junk": "general_junk", "clean_fill_missing": "fill_missing",
    "clean_whitespace": "whitespace",
}
for _q, _rule in _RULE_QUERIES.items():
    register(_q, OC.rule_changes_sql(_rule))(
        lambda spark, sf, _rule=_rule: clean.rule_changes(dirty_registry(spark, sf), _rule))


def cleaning(spark, sf) -> clean.Cleaning:
    return clean.Cleaning(dirty_registry(spark, sf), clean.DIRTY_CONFIG)


register("clean_all", OC.clean_all_sql())(lambda spark, sf: cleaning(spark, sf).cleaned)
register("transformation_log", OC.transformation_log_sql())(lambda spark, sf: cleaning(spark, sf).audit())



def clean_streamed(spark, sf) -> str:
    """Folder of the dirty registry cleaned as it lands: three arrivals, a run after each."""
    base = scratch_dir(spark, "clean-stream")
    df = written(dirty_registry(spark, sf), "clean-stream-rows")
    for arrival in range(3):
        df.where(F.pmod(F.xxhash64(*df.columns), F.lit(3)) == arrival).write.mode("append").parquet(f"{base}/source")
        incremental.clean_stream(spark, f"{base}/source", f"{base}/target", f"{base}/checkpoint", df.schema)
    return f"{base}/target"


register("stream_clean_all", OC.clean_all_sql())(
    lambda spark, sf: incremental.stream_cleaned(spark, clean_streamed(spark, sf)))
register("stream_transformation_log", OC.transformation_log_sql())(
    lambda spark, sf: incremental.stream_audit(spark, clean_streamed(spark, sf), dirty_registry(spark, sf).schema))


# ---------------------------------------------------------------- P8 - P16, A13, A14, J1 texts in SQL alone
def q_sql_functions(spark, sf):
    """Every value of the dirty registry through the functions, written in SQL alone."""
    SQLF.register(spark)
    return spark.sql("""
        select variable, value, is_junk(value) as junk, is_junk_ext(value) as junk_ext, is_invalid_name(value) as invalid_name,
               is_junk_or_zero(value) as junk_or_zero, is_disguised_null(value) as disguised, matches_key(value) as key,
               matches_phone(value) as phone, matches_zone(value) as zone, has_zero_typo(value) as zero_typo,
               fix_zero_typo(value) as zero_fixed, normalize_ws(value) as spaced, has_edge_ws(value) as edge,
               shape_signature(value) as shape, token_sort(value) as sorted, category_key(value) as category
        from {vf} where value is not null""", vf=_vf(spark, sf))


_S = O.strip("value")
register("sql_functions", f"""
select variable, value, {O.junk('value')} as junk, {O.junk_ext('value')} as junk_ext,
       {_S} <> '' and ({O.junk(_S)} or {O.has_digit(_S)}) as invalid_name,
       {_S} <> '' and ({O.junk(_S)} or {_S} = '0') as junk_or_zero,
       {O.strip('upper(value)')} in ({', '.join(f"'{t}'" for t in K.DISGUISED_NULL_TOKENS)}) as disguised,
       {O.key_ok('value')} as key, {O.phone_ok('value')} as phone, {O.zone('value')} as zone, {O.zero_typo('value')} as zero_typo,
       {O.fix_zero_typo('value')} as zero_fixed, {O.collapse(_S)} as spaced, {O.edge_ws('value')} as edge,
       {O.signature('value')} as shape, {O.token_sort('value')} as sorted, {O.category_key('value')} as category
from {VF} v where value is not null
""")(q_sql_functions)

# ---------------------------------------------------------------- J1 / J2

register("fuzzy_pairs", O.fuzzy_pairs_sql())(
    lambda spark, sf: dedupe.fuzzy_pairs(dirty_registry(spark, sf)))
register("fuzzy_members", O.fuzzy_members_sql())(
    lambda spark, sf: dedupe.fuzzy_members(dirty_registry(spark, sf)))
_COUNT_SQL = "select cast(coalesce(sum(pairs), 0) as bigint) as pairs from ({})"
register("fuzzy_pairs_count", _COUNT_SQL.format(O.fuzzy_pairs_sql()))(
    lambda spark, sf: dedupe.fuzzy_pairs_count(dirty_registry(spark, sf)))
register("fuzzy_lev_prefilter", O.lev_prefilter_sql())(
    lambda spark, sf: dedupe.lev_prefilter_pairs(dirty_registry(spark, sf)))
register("fuzzy_pairs_clean", O.fuzzy_pairs_sql(src=f"({OC.clean_all_sql()})"))(
    lambda spark, sf: dedupe.fuzzy_pairs(cleaning(spark, sf).cleaned))


def q_token_sort_similarity(spark, sf):
    """Per row: similarity between the record text before and after cleaning."""
    both = cleaning(spark, sf).staged.select(
        F.col(clean.raw(R.key)).alias(R.key), dedupe.record_text(clean.raw(R.name), clean.raw(R.address)).alias("t0"),
        *[F.col(x).alias(f"_{x}") for x in (R.name, R.address)])
    both = both.where(F.col("t0").isNotNull())
    both = both.select(R.key, tx.token_sort("t0").alias("a"),
                       tx.token_sort(dedupe.record_text(F.col(f"_{R.name}"), F.col(f"_{R.address}"))).alias("b"))
    return both.select(R.key, similarity_from_lcs(lcs_udf("a", "b"), F.length("a"), F.length("b"))
                       .alias("similarity"))


_CLEAN_CTES = OC.chain()[0]
register("token_sort_similarity", f"""
with {_CLEAN_CTES},
r as (select s0.{R.key} as k, {O.token_sort(f"upper({O.strip('s0.' + R.name)}) || ' | ' || upper({O.strip('s0.' + R.address)})")} as a
      from s0 where s0.{R.name} is not null and s0.{R.address} is not null),
c as (select row_number() over () as i, * from s0),
cc as (select row_number() over () as i, * from s8),
j as (select c.{R.key} as k, {O.token_sort(f"upper({O.strip('c.' + R.name)}) || ' | ' || upper({O.strip('c.' + R.address)})")} as a,
             {O.token_sort(f"upper({O.strip('cc.' + R.name)}) || ' | ' || upper({O.strip('cc.' + R.address)})")} as b
      from c join cc using (i) where c.{R.name} is not null and c.{R.address} is not null)
select k as {R.key}, case when length(a) + length(b) = 0 then 100.0 else round_even(200.0 * {O.lcs('a', 'b')} / (length(a) + length(b)), 1) end as similarity from j
""")(q_token_sort_similarity)

# ---------------------------------------------------------------- A15 / K5 / A18 / V1-V8

FLAGSHIP = "quality_before_after"


def diag_of(spark, sf, df=None) -> diagnosis.Diagnosis:
    return diagnosis.Diagnosis(df if df is not None else dirty_registry(spark, sf), R,
                               department_catalog=department_catalog(spark, sf))


_DUP_D = (f"select cast(coalesce(sum(n - 1), 0) as bigint) as duplicates from "
          f"(select count(*) as n from {D} t group by {', '.join(O.D_COLS)})")

_FINDINGS_SQL = f"""
with miss as ({ORACLE['profile_missing']}),
dup as ({_DUP_D}),
dom as ({ORACLE['domain_counts']}),
fmt as ({ORACLE['profile_format']}),
shp as ({ORACLE['shape_profile']}),
vs as ({ORACLE['category_variant_summary']}),
f as (
  select 1 as sec, 0 as pos, 0 as sub, 'null_cells ' || string_agg(variable, ',' order by missing desc, pos) as finding
    from miss where missing > 0 having count(*) > 0
  union all select 2, 0, 0, 'repeated_rows=' || duplicates from dup where duplicates > 0
  union all select 3, pos, 0, 'outside_domain ' || variable || '=' || invalid_values from dom where invalid_values > 0
  union all select 4, pos, 0, 'stray_whitespace ' || variable || '=' || (edge_ws + multi_ws) from fmt where edge_ws > 0 or multi_ws > 0
  union all select 4, pos, 1, 'letters_among_digits ' || variable || '=' || letters from fmt where letters > 0
  union all select 4, pos, 2, 'replacement_characters ' || variable || '=' || corrupt from fmt where corrupt > 0
  union all select 5, pos, 0, 'shapes ' || variable || '=' || n_signatures || ' off_main=' || off_pattern from shp where n_signatures > 1
  union all select 6, pos, 0, 'spelling_groups ' || variable || '=' || groups from vs),
f2 as (select * from f union all select 9, 0, 0, 'clean' where (select count(*) from f) = 0)
select cast(row_number() over (order by sec, pos, sub, finding) as integer) as ordinal, finding from f2
"""
register("findings", _FINDINGS_SQL)(lambda spark, sf: diag_of(spark, sf).findings())

register("tidy_report", f"""
with miss as ({ORACLE['profile_missing']}),
fmt as ({ORACLE['profile_format']}),
shp as ({ORACLE['shape_profile']}),
dom as ({ORACLE['domain_counts']}),
dv as ({ORACLE['domain_summary']}),
vs as ({ORACLE['category_variant_summary']}),
fin as ({_FINDINGS_SQL})
select 'a_shape' as section, '' as variable, metric, cast(value as varchar) as value from ({ORACLE['profile_shape']})
union all select 'b_types', variable, 'type', type from ({ORACLE['profile_types']})
union all select 'c_missing', variable, 'missing', cast(missing as varchar) from miss
union all select 'c_missing', variable, 'missing_pct', cast(missing_pct as varchar) from miss
union all select 'd_distinct', variable, 'distinct_values', cast(distinct_values as varchar) from ({ORACLE['profile_distinct']})
union all select 'e_duplicates', '', 'duplicates', cast(duplicates as varchar) from ({_DUP_D})
union all select 'f_domain', variable, 'invalid_values', cast(invalid_values as varchar) from dom
union all select 'f_domain', variable, 'invalid_value', value from dv where n > 0
union all select 'g_format', variable, 'edge_ws', cast(edge_ws as varchar) from fmt
union all select 'g_format', variable, 'multi_ws', cast(multi_ws as varchar) from fmt
union all select 'g_format', variable, 'corrupt', cast(corrupt as varchar) from fmt
union all select 'g_format', variable, 'letters', cast(letters as varchar) from fmt where letters is not null
union all select 'g_format', variable, 'corrupt_examples', corrupt_examples from fmt where corrupt_examples <> ''
union all select 'g_patterns', variable, 'n_signatures', cast(n_signatures as varchar) from shp
union all select 'g_patterns', variable, 'most_common', most_common from shp
union all select 'g_patterns', variable, 'off_pattern', cast(off_pattern as varchar) from shp
union all select 'g_patterns', variable, 'examples', examples from shp
union all select 'f_variants', variable, 'groups', cast(groups as varchar) from vs
union all select 'f_variants', variable, 'examples', examples from vs
union all select 'h_findings', '', 'finding_' || ordinal, finding from fin
""")(lambda spark, sf: diag_of(spark, sf).tidy_report())


def _metrics_sql(src: str, fuzzy_sql: str, errors_sql: str) -> str:
    vf = O.vf(src=src)
    k = len(O.D_COLS)
    return f"""
with v as (select * from {vf} x),
miss as (select variable, sum(case when value is null then n else 0 end) as missing from v group by variable),
m as (select sum(missing) as total, count(*) filter (where missing > 0) as with_na from miss),
r as (select count(*) as rows from {src} t),
fmt as (select variable, sum(case when value is not null and ({O.edge_ws('value')} or {O.multi_ws('value')}
               or contains(value, '{K.CORRUPT_CHAR}')) then n else 0 end) as bad from v group by variable),
vg as (select count(distinct (variable, key)) as groups from ({variants_sql(vf)}) g)
select 1 as ord, 'rows' as metric, cast(rows as varchar) as value from r
union all select 2, 'columns', '{k}'
union all select 3, 'missing cells', cast(total as varchar) || ' (' ||
  cast(case when rows > 0 then round(cast(total as double) * 100 / (rows * {k}), 2) else 0.0 end as varchar) || '%)' from m, r
union all select 4, 'columns with missing values', cast(with_na as varchar) from m
union all select 5, 'exact duplicates', cast(duplicates as varchar) from
  (select cast(coalesce(sum(n - 1), 0) as bigint) as duplicates from (select count(*) as n from {src} t group by {', '.join(O.D_COLS)}))
union all select 6, 'possible duplicates', cast(pairs as varchar) from ({fuzzy_sql})
union all select 7, 'columns with format issues', cast(count(*) filter (where bad > 0) as varchar) from fmt
union all select 8, 'columns with wrong type', '0'
union all select 9, 'category variant groups', cast(groups as varchar) from vg
union all select 10, 'errors corrected', cast(errors as varchar) from ({errors_sql})
"""


_CLEAN_SRC = f"({OC.clean_all_sql()})"
register("quality_before_after", f"""
with b as ({_metrics_sql(D, _COUNT_SQL.format(O.fuzzy_pairs_sql()), "select 0 as errors")}),
a as ({_metrics_sql(_CLEAN_SRC, _COUNT_SQL.format(O.fuzzy_pairs_sql(src=_CLEAN_SRC)),
                    f"select cast(sum(affected) as bigint) as errors from ({OC.transformation_log_sql()})")})
select cast(b.ord as integer) as ord, b.metric, b.value as before, a.value as after from b join a using (ord)
""")


def q_quality_before_after(spark, sf):
    raw = dirty_registry(spark, sf)
    # the cleaned table is written once; every "after" metric then starts
    # from that scan instead of re-running the rules
    c = cleaning(spark, sf)
    cleaned = c.materialize(scratch_dir(spark, "clean"))
    before = diag_of(spark, sf, raw).quality_metrics(dedupe.fuzzy_pairs_count(raw))
    after = diag_of(spark, sf, cleaned).quality_metrics(dedupe.fuzzy_pairs_count(cleaned),
                                                        c.errors_corrected())
    return diagnosis.before_after(before, after)


QUERIES["quality_before_after"] = q_quality_before_after

_AL = ", ".join(f"'{a}'" for a in clean.DIRTY_CONFIG.aliases)
register("validate_clean", f"""
with c as (select * from {_CLEAN_SRC} t),
v as (select * from {O.vf(src=_CLEAN_SRC)} x),
dup as (select cast(coalesce(sum(n - 1), 0) as bigint) as d from (select count(*) as n from c group by {', '.join(O.D_COLS)})),
edge as (select coalesce(sum(n) filter (where value is not null and {O.edge_ws('value')}), 0) as e from v),
cnt as (select count(*) filter (where {R.phone} is not null and not ({O.phone_ok(R.phone)} or {R.phone} = '{K.PLACEHOLDER}')) as bad_phone,
               count(*) filter (where coalesce({O.zone(R.municipality)}, false)) as zones,
               count(*) filter (where upper({R.department}) in ({_AL})) as alias_left,
               count(*) filter (where coalesce({O.zero_typo(R.supervisor)}, false)) as typo_left from c),
outside as (select upper({R.department}) as value, count(*) as n from c where {R.department} is not null
            and upper({R.department}) not in (select r_name from region) group by all),
o as (select count(*) as n from outside),
vk as (select distinct variable, pos, key from ({variants_sql(O.vf(src=_CLEAN_SRC))}) g),
vg as (select count(*) as groups, coalesce((select string_agg(variable, ',' order by pos) from (select distinct variable, pos from vk)), '') as names from vk)
select 1 as ord, 'unique_rows' as "check", d = 0 as ok, 'repeated=' || d as detail from dup
union all select 2, 'no_edge_whitespace', e = 0, 'cells=' || e from edge
union all select 3, 'phone_digits_or_placeholder', bad_phone = 0, 'other=' || bad_phone from cnt
union all select 4, 'department_in_catalogue', n = 0, 'outside=' || n from o
union all select 5, 'no_zone_as_municipality', zones = 0, 'zones=' || zones from cnt
union all select 6, 'text_columns_only', true, 'other='
union all select 7, 'single_spelling', groups = 0, 'groups=' || groups || ' columns=' || names from vg
union all select 8, 'no_alias_or_typo', alias_left = 0 and typo_left = 0, 'alias=' || alias_left || ' typo=' || typo_left from cnt
""")(lambda spark, sf: diagnosis.validate(written(cleaning(spark, sf).cleaned, "clean"), R, department_catalog(spark, sf),
                                          aliases=clean.DIRTY_CONFIG.aliases))

# V4 and V7 in full, on the table as it comes (the cleaned one has few left)
register("validation_values", f"""
select 4 as ord, '{R.department}' as variable, upper({R.department}) as value, count(*) as n from {D} t
where {R.department} is not null and upper({R.department}) not in (select r_name from region) group by all
union all select 7, variable, value, n_variants from ({_VARIANTS_SQL})
""")(lambda spark, sf: diagnosis.validation_values(dirty_registry(spark, sf), R, department_catalog(spark, sf)))

# ---------------------------------------------------------------- S1-S6, P1-P4, K3, U1, K4, P5, A16

EXPORT_HEADER = [("CODIGO", R.key), ("", None), ("DISTRITO", R.district), ("DEPARTAMENTO", R.department),
                 ("MUNICIPIO", R.municipality), ("ESTABLECIMIENTO", R.name), ("DIRECCION", R.address),
                 ("TELEFONO", R.phone), ("SUPERVISOR", R.supervisor), ("DIRECTOR", R.director),
                 ("SECTOR", R.sector), ("", None), ("", None)]
_REG = {c: h for h, c in EXPORT_HEADER if c}


def landing_of(spark, sf) -> ING.Landing:
    """The raw export files Spark derives from the registry, written to the
    shared folder (like files landing from the download step) and scanned."""
    path = scratch_dir(spark, "landing")
    LND.write_export(dirty_registry(spark, sf), path, EXPORT_HEADER, LND.file_group(F.col(R.department)), R.key)
    return LND.as_landing(spark, path)


def ingested(spark, sf) -> ING.Ingested:
    return ING.ingest(landing_of(spark, sf)).materialize(scratch_dir(spark, "ingested"))


_FILES_SQL = f"""
with g as (select *, regexp_replace({R.department}, ' CAPITAL$', '') as grp from {D} t),
sz as (select grp, cast(greatest(1, ceil(count(*) / {LND.ROWS_PER_FILE})) as integer) as nc from g group by grp),
r as (select g.*, 'export_' || replace(grp, ' ', '_') || '_' ||
        lpad(cast(('0x' || substr(md5(coalesce({R.key}, '')), 1, 8))::bigint % nc as varchar), 3, '0') || '.csv' as origin,
        coalesce({O.key_ok(O.strip(R.key))}, false) as valid
      from g join sz using (grp))
"""
_ALLTEXT = " || ';' || ".join(f"coalesce({c}, '')" for _, c in EXPORT_HEADER if c)

register("ingest_ledger", f"""{_FILES_SQL}
select origin,
  case when bool_or(contains({R.director}, '{K.CORRUPT_CHAR}')) then 'utf-8-sig'
       when bool_or(regexp_matches({_ALLTEXT}, '[^\\x00-\\x7F]')) then 'cp1252' else 'utf-8-sig' end as encoding,
  cast({LND.LEADING_LINES} as bigint) as lines_before,
  cast(count(*) + {LND.FOOTER_ROWS} as bigint) as rows_from_header,
  cast(count(*) filter (where not valid) + {LND.FOOTER_ROWS} as bigint) as rows_removed,
  cast(count(*) filter (where valid) as bigint) as rows_kept,
  cast({len(EXPORT_HEADER)} as bigint) as columns_original,
  cast({len(_REG)} as bigint) as columns_final,
  '{", ".join(f"Unnamed: {i}" for i, (h, c) in enumerate(EXPORT_HEADER) if not c)}' as unnamed_dropped,
  '{", ".join(sorted(set(K.REQUIRED_HEADERS) - set(_REG.values())))}' as required_missing,
  'ver columnas' as status,
  replace(replace(origin, '.csv', ''), ' ', '_') || '_new.csv' as output_file
from r group by origin
""")(lambda spark, sf: ingested(spark, sf).ledger)

register("strict_union", f"""{_FILES_SQL}
select {', '.join(f'{c} as "{h}"' for c, h in _REG.items())}, origin as origen from r where valid
""")(lambda spark, sf: ING.strict_union(ingested(spark, sf)))

register("union_ledger", f"""{_FILES_SQL}
select origin as file, cast(count(*) filter (where valid) as bigint) as rows,
       cast({len(_REG)} as bigint) as data_columns, true as schema_ok
from r group by origin
""")(lambda spark, sf: ING.union_ledger(ingested(spark, sf)))


def _united(spark, sf) -> DataFrame:
    return ING.strict_union(ingested(spark, sf))


register("file_review", f"""{_FILES_SQL}
select origin as file, cast(count(*) as bigint) as rows, cast({len(_REG)} as bigint) as columns,
  count(distinct {O.strip(R.department)}) as departments, count(distinct {O.strip(R.municipality)}) as municipalities,
  case when count(distinct {O.strip(R.department)}) = 1 then 'Correcto' else 'Revisar' end as status
from r where valid group by origin
""")(lambda spark, sf: ING.file_review(_united(spark, sf), "origen", _REG[R.department], _REG[R.municipality], len(_REG)))

register("file_values", f"""{_FILES_SQL}
select origin as file, '{_REG[R.department]}' as variable, {O.strip(R.department)} as value, count(*) as n
from r where valid and {R.department} is not null group by all
union all
select origin, '{_REG[R.municipality]}', {O.strip(R.municipality)}, count(*) from r where valid and {R.municipality} is not null group by all
""")(lambda spark, sf: ING.file_values(_united(spark, sf), "origen", _REG[R.department], _REG[R.municipality]))


def streamed(spark, sf) -> ING.Ingested:
    """The same export files, loaded as they land by the streaming reader."""
    path, base = scratch_dir(spark, "landing"), scratch_dir(spark, "stream")
    LND.write_export(dirty_registry(spark, sf), path, EXPORT_HEADER, LND.file_group(F.col(R.department)), R.key)
    incremental.ingest_stream(spark, path, f"{base}/out", f"{base}/checkpoint", "*", LND.ORIGIN)
    return incremental.ingested(spark, f"{base}/out")


register("stream_ingest_ledger", ORACLE["ingest_ledger"])(lambda spark, sf: streamed(spark, sf).ledger)
register("stream_ingest_union", ORACLE["strict_union"])(lambda spark, sf: ING.strict_union(streamed(spark, sf)))

# ---------------------------------------------------------------- S1, K1, K2, K8


def q_csv_round_trip(spark, sf):
    """Verified CSV export of the registry, read back with every column a string."""
    path = scratch_dir(spark, "registry-csv")
    export_verified(dirty_registry(spark, sf), path, fmt="csv")
    return read_registry_csv(spark, path)


register("csv_round_trip", f"select * from {D} t")(q_csv_round_trip)


def q_candidate_export(spark, sf):
    """The candidate-duplicates table as a verified export."""
    path = scratch_dir(spark, "candidates")
    export_verified(dedupe.fuzzy_pairs(dirty_registry(spark, sf)), path, fmt="parquet")
    return spark.read.parquet(path)


register("candidate_export", O.fuzzy_pairs_sql())(q_candidate_export)


def q_candidate_members(spark, sf):
    """The rows behind the exported candidates, with key, name and address for review."""
    path = scratch_dir(spark, "candidate-review")
    dedupe.export_candidates(dirty_registry(spark, sf), path)
    return spark.read.parquet(f"{path}/members")


register("candidate_members", O.candidate_members_sql())(q_candidate_members)

# ---------------------------------------------------------------- the whole flow on the 17 + 1 column layout
_R18 = Roles.registry()
_HEADER18 = [("CODIGO", "CODIGO"), ("", None), *((c, c) for c in REGISTRY_COLUMNS[1:]), ("", None), ("", None)]
_CLEAN18 = clean.CleanConfig(roles=_R18, aliases=clean.DIRTY_CONFIG.aliases, no_issue_columns=clean.NO_ISSUE_REGISTRY)
_D18 = f"""(with g as (select *, regexp_replace(DEPARTAMENTO, ' CAPITAL$', '') as grp
   from ({REGISTRY_SQL.format(dirty=dirty_sql_for_duckdb())}) t),
 sz as (select grp, cast(greatest(1, ceil(count(*) / {LND.ROWS_PER_FILE})) as integer) as nc from g group by grp)
 select {', '.join(REGISTRY_COLUMNS)}, 'export_' || replace(grp, ' ', '_') || '_' ||
   lpad(cast(('0x' || substr(md5(coalesce(CODIGO, '')), 1, 8))::bigint % nc as varchar), 3, '0') || '.csv' as origen
 from g join sz using (grp) where coalesce({O.key_ok(O.strip('CODIGO'))}, false))"""


def q_registry_flow(spark, sf):
    """``process_registry`` on derived export files; its transformation log."""
    base = scratch_dir(spark, "registry-flow")
    LND.write_export(full_registry(spark, sf), f"{base}/landing", _HEADER18, LND.file_group(F.col("DEPARTAMENTO")), "CODIGO")
    config = registry_flow.RegistryConfig(roles=_R18, clean=_CLEAN18, department_catalog=department_catalog(spark, sf))
    out = registry_flow.process_registry(spark, LND.as_landing(spark, f"{base}/landing"), f"{base}/out", config)
    return out["transformation_log"]


register("registry_flow", OC.transformation_log_sql(_CLEAN18, [*REGISTRY_COLUMNS, "origen"], _D18))(q_registry_flow)

register("filter_key_pattern", f"""
select * from {D} t where coalesce({O.key_ok(O.strip(R.key))}, false)
""")(lambda spark, sf: dirty_registry(spark, sf).where(F.coalesce(tx.matches_key(tx.ws_strip(R.key)), F.lit(False))))

# ---------------------------------------------------------------- S7


def pages_of(spark, sf):
    return LND.result_pages(table(spark, sf, "customer"), table(spark, sf, "nation"))


register("html_table_rows", """
with r as (select cast(c.c_nationkey as bigint) * 1000000000 + c.c_custkey // 100 as page_id,
       cast(row_number() over (partition by c.c_nationkey, c.c_custkey // 100 order by c.c_custkey) - 1 as integer) as row_idx,
       [cast(c.c_custkey as varchar), c.c_name, n.n_name, printf('%.2f', c.c_acctbal), c.c_mktsegment] as cells
       from customer c join nation n on c.c_nationkey = n.n_nationkey)
select page_id, row_idx, cast(unnest(range(0, 5)) as integer) as col_idx, unnest(cells) as cell from r
""")(lambda spark, sf: HTML.table_rows(pages_of(spark, sf))
     .select("page_id", "row_idx", F.posexplode("cells").alias("col_idx", "cell")))

register("html_options", """
with p as (select distinct cast(c_nationkey as bigint) * 1000000000 + c_custkey // 100 as page_id from customer)
select p.page_id, cast(row_number() over (partition by p.page_id order by n.n_nationkey) - 1 as integer) as option_idx,
       cast(n.n_nationkey as varchar) as value, n.n_name as text
from p, nation n where n.n_nationkey <> 0
""")(lambda spark, sf: HTML.option_pairs(pages_of(spark, sf)))


def q_html_spans(spark, sf):
    """Pages with spans, nested tables and no end tags, read by the SQL table function."""
    HTML.register_functions(spark)
    pages = LND.spanned_pages(table(spark, sf, "customer"), table(spark, sf, "nation"))
    return spark.sql("select p.page_id, t.row_idx, c.* from {pages} p, lateral html_table(p.html, 5) t, "
                     "lateral posexplode(t.cells) c(col_idx, cell)", pages=pages)


register("html_spans", """
with r as (select cast(c.c_nationkey as bigint) * 1000000000 + c.c_custkey // 100 as page_id,
       cast(row_number() over (partition by c.c_nationkey, c.c_custkey // 100 order by c.c_custkey) - 1 as integer) as row_idx,
       [n.n_name, cast(c.c_custkey as varchar), c.c_name, printf('%.2f', c.c_acctbal), c.c_mktsegment, c.c_mktsegment] as cells
       from customer c join nation n on c.c_nationkey = n.n_nationkey)
select page_id, row_idx, cast(unnest(range(0, 6)) as integer) as col_idx, unnest(cells) as cell from r
""")(q_html_spans)

# ---------------------------------------------------------------- P18 / U2

register("consistency_containment", f"""
select distinct {R.key}, {R.district} from {D} t
where {R.district} is not null and {R.key} is not null
  and not contains(upper({O.strip(R.key)}), upper({O.strip(R.district)}))
""")(lambda spark, sf: consistency.not_contained(dirty_registry(spark, sf), R.key, R.district, R.key))

# ---------------------------------------------------------------- A13 on driver text columns
register("shape_signatures_text", f"""
select 'url' as variable, {O.signature(O.strip('url'))} as signature, count(*) as n from pages where url is not null group by all
union all
select 'c_name', {O.signature(O.strip('c_name'))}, count(*) from customer where c_name is not null group by all
""")(lambda spark, sf: profile.shape_signatures(profile.value_freq(table(spark, sf, "pages").select("url")), ["url"])
     .unionByName(profile.shape_signatures(profile.value_freq(table(spark, sf, "customer").select("c_name")),
                                           ["c_name"])).drop("pos"))

# ---------------------------------------------------------------- S8

_CUT = "1998-01-01 00:00:00"


def _before_cut():
    # o_orderdate is TIMESTAMP_NTZ: compare with an NTZ literal, so the
    # session time zone plays no part
    return F.col("o_orderdate") < F.lit(_CUT).cast("timestamp_ntz")

_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]

register("incremental_anti_join", f"""
select {', '.join(_ORDER_COLS)} from orders o
where not exists (select 1 from orders l where l.o_orderdate < timestamp '{_CUT}' and l.o_orderkey = o.o_orderkey)
""")(lambda spark, sf: incremental.new_items(
    table(spark, sf, "orders").select(*_ORDER_COLS),
    table(spark, sf, "orders").where(_before_cut()), "o_orderkey"))


def q_incremental_stream_load(spark, sf):
    """Two arrivals of order files, two AvailableNow runs on one checkpoint:
    every order lands exactly once, with a row-local rule applied in flight."""
    base = scratch_dir(spark, "incremental")
    src, out, ckpt = f"{base}/source", f"{base}/target", f"{base}/checkpoint"
    orders = table(spark, sf, "orders").select(*_ORDER_COLS, "o_orderdate")
    first = orders.where(_before_cut()).drop("o_orderdate")
    second = orders.where(~_before_cut()).drop("o_orderdate")
    schema = first.schema
    rule = lambda s: s.withColumn("o_orderpriority", normalize_ws("o_orderpriority"))
    first.write.mode("append").parquet(f"{src}/batch=1")
    incremental.incremental_load(spark, src, out, ckpt, schema, transform=rule)
    second.write.mode("append").parquet(f"{src}/batch=2")
    incremental.incremental_load(spark, src, out, ckpt, schema, transform=rule)
    return spark.read.parquet(out).select(*_ORDER_COLS)


register("incremental_stream_load", f"""
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, {O.collapse(O.strip('o_orderpriority'))} as o_orderpriority
from orders
""")(q_incremental_stream_load)
