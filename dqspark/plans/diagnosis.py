"""Diagnosis, quality report and validations.

``Diagnosis`` takes row counts (missing, format) from one aggregate over the
table and everything about distinct values from one value-frequency frame,
which is written once to the shared folder.  All reports are long,
string-valued tables that union cleanly; nothing in them is cut: a section
that lists values has one row per value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqspark.functions import constants as K
from dqspark.functions import text as tx
from dqspark.operators import domain, profile, variants
from dqspark.session import written
from dqspark.sources.tables import Roles


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _s(c):
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


class Diagnosis:
    def __init__(self, df: DataFrame, roles: Roles, department_catalog=None,
                 sector_catalog=K.SECTORS, level_catalog=K.LEVELS,
                 shape_columns=None, persist: bool = True):
        self.df = df
        self.roles = roles
        self.columns = df.columns
        self.persist = persist
        self.department_catalog = department_catalog
        self.sector_catalog = sector_catalog
        self.level_catalog = level_catalog
        r = roles
        self.shape_columns = [c for c in (shape_columns or [r.key, r.district]) if c in self.columns]
        self.text_columns = profile.string_columns(df)

    @property
    def vf(self) -> DataFrame:
        """The value-frequency frame: every section that needs it reads one written table."""
        return self._kept("value-freq", lambda: profile.value_freq(self.df))

    # ------------------------------------------------------------ sections
    # Each section is built once per Diagnosis and the same DataFrame object
    # is reused by the findings, the tidy report and the quality metrics, so
    # one plan carries identical subtrees (exchange reuse) and the driver
    # analyses each section once.
    def _memo(self, name, build):
        cache = self.__dict__.setdefault("_sections", {})
        if name not in cache:
            cache[name] = build()
        return cache[name]

    def _kept(self, name, build):
        """A section that several others read: written once, so that a report's
        plan reads small tables instead of holding each section many times."""
        return self._memo(name, lambda: written(build(), name) if self.persist else build())

    def shape(self):
        return self._memo("shape", lambda: profile.shape(self.df))

    def stats(self):
        """Type, missing and format counts of all columns: one aggregate."""
        return self._kept("stats", lambda: profile.column_stats(self.df, self.roles.phone))

    def missing(self):
        return self._memo("missing", lambda: self.stats().select(
            "variable", "pos", "missing", profile.missing_pct()).orderBy(F.desc("missing"), "pos"))

    def distinct(self):
        return self._memo("distinct", lambda: profile.distinct_counts(self.vf))

    def duplicates(self):
        return self._kept("duplicates", lambda: profile.duplicate_count(self.df))

    def checks(self) -> list[domain.Check]:
        r, cols, C = self.roles, self.columns, domain.Check
        out = []
        for c, cat in ((r.department, self.department_catalog), (r.sector, self.sector_catalog),
                       (r.level, self.level_catalog), (r.status, None), (r.area, None)):
            if c and c in cols:
                out.append(C(c, domain.CATEGORICAL, cat))
        out += [C(c, domain.NAME) for c in (r.supervisor, r.director, r.municipality) if c in cols]
        if r.key in cols:
            out.append(C(r.key, domain.KEY))
        if r.phone in cols:
            out.append(C(r.phone, domain.PHONE))
        return out

    def violations(self) -> DataFrame:
        """All out-of-domain values of all checked columns, one pass."""
        return self._kept("violations", lambda: domain.violations(self.vf, self.checks()))

    def domain_variables(self) -> list[str]:
        return [c.column for c in self.checks()]

    def domain_counts(self):
        return self._kept("domain-counts", lambda: domain.counts(self.violations(), self.domain_variables()))

    def format_issues(self):
        return self._kept("format", lambda: profile.format_issues(self.df, stats=self.stats()))

    def shape_profile(self):
        return self._kept("shape-profile", lambda: profile.shape_profile(self.vf, self.shape_columns))

    def variant_keys(self):
        return self._kept("variant-keys", lambda: variants.variant_keys(self.vf, columns=self.text_columns))

    def variant_groups(self):
        return self._kept("variant-groups", lambda: variants.variant_groups(self.vf, columns=self.text_columns))

    def variant_summary(self):
        return self._kept("variant-summary", lambda: variants.variant_summary(self.variant_groups()))

    # ------------------------------------------------------------ findings
    def findings(self) -> DataFrame:
        """``(ordinal, finding)``: what the sections found, as ``code column=count`` lines in order (A15)."""
        spark = self.df.sparkSession

        def line(df, sec, sub, text, pos="pos"):
            p = F.col(pos) if isinstance(pos, str) else pos
            return df.select(F.lit(sec).alias("sec"), p.cast("int").alias("pos"), F.lit(sub).alias("sub"),
                             text.alias("finding"))

        def of(code, count):
            return F.concat(F.lit(code + " "), F.col("variable"), F.lit("="), _s(count))

        zero = F.lit(0)
        miss = self.missing().where(F.col("missing") > 0).agg(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct((-F.col("missing")).alias("m"), "pos", "variable"))),
            lambda s: s["variable"]), ",").alias("names")).where("names <> ''")
        fmt, shp = self.format_issues(), self.shape_profile()
        parts = [
            line(miss, 1, 0, F.concat(F.lit("null_cells "), F.col("names")), zero),
            line(self.duplicates().where("duplicates > 0"), 2, 0, F.concat(F.lit("repeated_rows="), _s("duplicates")), zero),
            line(self.domain_counts().where("invalid_values > 0"), 3, 0, of("outside_domain", "invalid_values")),
            line(fmt.where("edge_ws > 0 or multi_ws > 0"), 4, 0, of("stray_whitespace", F.col("edge_ws") + F.col("multi_ws"))),
            line(fmt.where("letters > 0"), 4, 1, of("letters_among_digits", "letters")),
            line(fmt.where("corrupt > 0"), 4, 2, of("replacement_characters", "corrupt")),
            line(shp.where("n_signatures > 1"), 5, 0, F.concat(of("shapes", "n_signatures"), F.lit(" off_main="),
                                                               _s("off_pattern"))),
            line(self.variant_summary(), 6, 0, of("spelling_groups", "groups")),
        ]
        found = _union(parts)
        # the list is bounded by a few lines per column, so it is put in order as one array
        ordered = found.agg(F.array_sort(F.collect_list(F.struct("sec", "pos", "sub", "finding"))).alias("a"))
        nothing = F.array(F.struct(F.lit(9).alias("sec"), zero.alias("pos"), zero.alias("sub"), F.lit("clean").alias("finding")))
        return ordered.select(F.posexplode(F.when(F.size("a") > 0, F.col("a")).otherwise(nothing)).alias("i", "r")).select(
            (F.col("i") + 1).cast("int").alias("ordinal"), F.col("r.finding").alias("finding"))

    # ------------------------------------------------------------ tidy report
    def tidy_report(self) -> DataFrame:
        """``(section, variable, metric, value)`` -- every section, strings only (K5)."""
        def rows(df, section, variable, pairs):
            structs = [F.struct(F.lit(m).alias("metric"), _s(v).alias("value")) for m, v in pairs]
            var = variable if not isinstance(variable, str) else F.col(variable)
            return (df.select(F.lit(section).alias("section"), var.alias("variable"),
                              F.explode(F.array(*structs)).alias("mv"))
                    .select("section", "variable", "mv.metric", "mv.value"))

        parts = [
            self.shape().select(F.lit("a_shape").alias("section"), F.lit("").alias("variable"),
                                F.col("metric"), _s("value").alias("value")),
            rows(self.stats(), "b_types", "variable", [("type", F.col("type"))]),
            rows(self.missing(), "c_missing", "variable",
                 [("missing", F.col("missing")), ("missing_pct", F.col("missing_pct"))]),
            rows(self.distinct(), "d_distinct", "variable", [("distinct_values", F.col("distinct_values"))]),
            rows(self.duplicates(), "e_duplicates", F.lit(""), [("duplicates", F.col("duplicates"))]),
            rows(self.domain_counts(), "f_domain", "variable", [("invalid_values", F.col("invalid_values"))]),
            rows(self.violations(), "f_domain", "variable", [("invalid_value", F.col("value"))]),
        ]
        fmt = self.format_issues()
        fmt_long = rows(fmt, "g_format", "variable",
                        [("edge_ws", F.col("edge_ws")), ("multi_ws", F.col("multi_ws")),
                         ("corrupt", F.col("corrupt")), ("letters", F.col("letters")),
                         ("corrupt_examples", F.when(F.col("corrupt_examples") != "", F.col("corrupt_examples")))])
        parts.append(fmt_long.where(F.col("value").isNotNull()))
        parts.append(rows(self.shape_profile(), "g_patterns", "variable",
                          [("n_signatures", F.col("n_signatures")), ("most_common", F.col("most_common")),
                           ("off_pattern", F.col("off_pattern")), ("examples", F.col("examples"))]))
        parts.append(rows(self.variant_summary(), "f_variants", "variable",
                          [("groups", F.col("groups")), ("examples", F.col("examples"))]))
        parts.append(self.findings().select(
            F.lit("h_findings").alias("section"), F.lit("").alias("variable"),
            F.concat(F.lit("finding_"), _s("ordinal")).alias("metric"), F.col("finding").alias("value")))
        return _union(parts)

    # ------------------------------------------------------------ A18
    def quality_metrics(self, possible_duplicates: DataFrame | None = None,
                        errors_corrected: DataFrame | None = None) -> DataFrame:
        """``(ord, metric, value)`` for the ten quality metrics."""
        spark = self.df.sparkSession
        k = len(self.columns)
        st = self.stats()
        shp = st.agg(F.coalesce(F.max("rows"), F.lit(0)).cast("bigint").alias("rows"))
        m = st.agg(F.sum("missing").alias("total"), F.count_if(F.col("missing") > 0).alias("with_na"))
        fmt = st.where("is_text").agg(
            F.count_if((F.col("edge_ws") > 0) | (F.col("multi_ws") > 0) | (F.col("corrupt") > 0)).alias("bad"))
        var = self.variant_keys().agg(F.count(F.lit(1)).alias("groups"))
        wrong = len(self.columns) - len(self.text_columns)
        pct = F.round(F.col("total").cast("double") * 100 / (F.col("rows") * k), 2)
        parts = [
            shp.select(F.lit(1).alias("ord"), F.lit("rows").alias("metric"), _s("rows").alias("value")),
            spark.createDataFrame([(2, "columns", str(k))], "ord int, metric string, value string"),
            m.withColumn("rows", shp.scalar()).select(
                F.lit(3).alias("ord"), F.lit("missing cells").alias("metric"),
                F.concat(_s("total"), F.lit(" ("), _s(F.when(F.col("rows") > 0, pct).otherwise(F.lit(0.0))),
                         F.lit("%)")).alias("value")),
            m.select(F.lit(4).alias("ord"), F.lit("columns with missing values").alias("metric"),
                     _s("with_na").alias("value")),
            self.duplicates().select(F.lit(5).alias("ord"), F.lit("exact duplicates").alias("metric"),
                                     _s("duplicates").alias("value")),
        ]
        if possible_duplicates is not None:
            parts.append(possible_duplicates.select(F.lit(6).alias("ord"), F.lit("possible duplicates")
                                                    .alias("metric"), _s(F.col(possible_duplicates.columns[0]))
                                                    .alias("value")))
        parts += [
            fmt.select(F.lit(7).alias("ord"), F.lit("columns with format issues").alias("metric"),
                       _s("bad").alias("value")),
            spark.createDataFrame([(8, "columns with wrong type", str(wrong))], "ord int, metric string, value string"),
            var.select(F.lit(9).alias("ord"), F.lit("category variant groups").alias("metric"),
                       _s("groups").alias("value")),
        ]
        if errors_corrected is not None:
            parts.append(errors_corrected.select(F.lit(10).alias("ord"), F.lit("errors corrected").alias("metric"),
                                                 _s(F.col(errors_corrected.columns[0])).alias("value")))
        else:
            parts.append(spark.createDataFrame([(10, "errors corrected", "0")], "ord int, metric string, value string"))
        return _union([p.select(F.col("ord").cast("int").alias("ord"), "metric", "value") for p in parts])


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(ord, metric, before, after)`` (K6)."""
    b = before.withColumnRenamed("value", "before")
    a = after.withColumnRenamed("value", "after")
    return b.join(a, ["ord", "metric"], "full_outer").orderBy("ord")


def _outside(df: DataFrame, roles: Roles, catalog) -> DataFrame:
    """``(value, n)``: upper-cased departments outside the catalogue."""
    deps = (df.where(F.col(roles.department).isNotNull()).groupBy(F.upper(roles.department).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))
    if isinstance(catalog, DataFrame):
        return deps.join(catalog.select(F.col(catalog.columns[0]).alias("value")).distinct(), "value", "left_anti")
    return deps.where(~F.col("value").isin(list(catalog or K.DEPARTMENTS)))


def validate(df: DataFrame, roles: Roles, department_catalog=None, placeholder: str = K.PLACEHOLDER,
             aliases=K.CAPITAL_ALIAS) -> DataFrame:
    """``(ord, check, ok, detail)``: post-conditions V1-V8 on a cleaned table.

    ``df`` should be a written table: it is read for the counts, for repeated
    rows and for distinct values.  ``validation_values`` lists the values
    behind V4 and V7.
    """
    spark = df.sparkSession
    r = roles
    text = profile.string_columns(df)
    diag = Diagnosis(df, roles, persist=False)
    ph = F.col(r.phone)
    edges = [F.count_if(F.coalesce(tx.has_edge_ws(c), F.lit(False))) for c in text]
    counts = df.agg(
        sum(edges[1:], edges[0]).cast("bigint").alias("edge"),
        F.count_if(ph.isNotNull() & ~(tx.matches_phone(ph) | (ph == placeholder))).alias("bad_phone"),
        F.count_if(F.coalesce(tx.matches_zone(r.municipality), F.lit(False))).alias("zones"),
        F.count_if(F.upper(F.col(r.department)).isin(list(aliases))).alias("alias_left"),
        F.count_if(F.coalesce(tx.has_zero_typo(r.supervisor), F.lit(False))).alias("typo_left"))
    outside = _outside(df, r, department_catalog).agg(F.count(F.lit(1)).alias("n"))
    # one name per column of the table at most
    var = diag.variant_keys().groupBy("variable", "pos").agg(F.count(F.lit(1)).alias("k")).agg(
        F.coalesce(F.sum("k"), F.lit(0)).alias("groups"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "variable"))), lambda s: s["variable"]), ",")
        .alias("names"))
    wrong = [c for c in df.columns if c not in text]

    def row(o, check, ok, detail):
        return (F.lit(o).alias("ord"), F.lit(check).alias("check"), ok.alias("ok"), detail.alias("detail"))

    def eq(name, c):
        return F.concat(F.lit(name + "="), _s(c))

    parts = [
        diag.duplicates().select(*row(1, "unique_rows", F.col("duplicates") == 0, eq("repeated", "duplicates"))),
        outside.select(*row(4, "department_in_catalogue", F.col("n") == 0, eq("outside", "n"))),
        spark.createDataFrame([(6, "text_columns_only", not wrong, "other=" + ",".join(wrong))],
                              "ord int, check string, ok boolean, detail string"),
        var.select(*row(7, "single_spelling", F.col("groups") == 0,
                        F.concat(eq("groups", "groups"), F.lit(" columns="), F.col("names")))),
        counts.select(F.explode(F.array(
            F.struct(*row(2, "no_edge_whitespace", F.col("edge") == 0, eq("cells", "edge"))),
            F.struct(*row(3, "phone_digits_or_placeholder", F.col("bad_phone") == 0, eq("other", "bad_phone"))),
            F.struct(*row(5, "no_zone_as_municipality", F.col("zones") == 0, eq("zones", "zones"))),
            F.struct(*row(8, "no_alias_or_typo", (F.col("alias_left") == 0) & (F.col("typo_left") == 0),
                          F.concat(eq("alias", "alias_left"), F.lit(" typo="), _s("typo_left")))))).alias("s")).select("s.*"),
    ]
    return _union([p.select(F.col("ord").cast("int").alias("ord"), "check", "ok", "detail") for p in parts])


def validation_values(df: DataFrame, roles: Roles, department_catalog=None) -> DataFrame:
    """``(ord, variable, value, n)``: every department outside the catalogue
    (V4, with its rows) and every spelling of a key with several (V7, with the
    key's spellings)."""
    vf = profile.value_freq(df, profile.string_columns(df))
    return (_outside(df, roles, department_catalog)
            .select(F.lit(4).alias("ord"), F.lit(roles.department).alias("variable"), "value", "n")
            .unionByName(variants.variant_groups(vf).select(F.lit(7).alias("ord"), "variable", "value",
                                                            F.col("n_variants").alias("n"))))
