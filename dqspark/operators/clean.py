"""Declarative cleaning rules with an audit log.

Rules run in a fixed order, each as a stage of its own: first the boolean
flags of the rows it concerns, as columns, then the new value, which refers to
the flags.  Later rules read the columns as the earlier ones left them, so
the number of regular expressions grows with the rules, not with what stood
before them, and nothing is materialised or shuffled between rules.

The audit log comes from one pass: every flag that is set becomes an event
``(mark, value)``, events are counted, and counts, examples and the district's
shapes are read from that small table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqspark.functions import constants as K
from dqspark.functions import text as tx
from dqspark.operators.profile import first_k_values, string_columns
from dqspark.session import written
from dqspark.sources.tables import Roles

AUDIT_COLUMNS = ("step", "sub", "variable", "problem", "action", "affected", "justification")
ALL_TEXT = "all text columns"
NO_ISSUE_REGISTRY = ("DIRECCION", "ESTABLECIMIENTO", "CODIGO", "STATUS", "DEPARTAMENTAL", "PLAN", "JORNADA",
                     "MODALIDAD", "NIVEL", "AREA", "SECTOR")


@dataclass
class CleanConfig:
    roles: Roles = field(default_factory=Roles)
    placeholder: str = K.PLACEHOLDER
    zone_replacement: str = K.ZONE_REPLACEMENT
    aliases: dict = field(default_factory=lambda: dict(K.CAPITAL_ALIAS))
    sweep_exclude: tuple | None = None   # default: key, district, name, phone, origin
    fill_exclude: tuple | None = None    # default: key, district, origin
    no_issue_columns: tuple = ()
    document_district: bool = True
    phone_strip_first: bool = False      # original: the phone rule does not strip

    def sweep_excluded(self) -> set:
        r = self.roles
        return set(self.sweep_exclude if self.sweep_exclude is not None
                   else (r.key, r.district, r.name, r.phone, r.origin))

    def fill_excluded(self) -> set:
        r = self.roles
        return set(self.fill_exclude if self.fill_exclude is not None
                   else (r.key, r.district, r.origin))


DIRTY_CONFIG = CleanConfig(aliases={"ASIA CAPITAL": "ASIA"},
                           no_issue_columns=("address", "name", "code", "sector"))


@dataclass
class Entry:
    """One line of the audit log; counts are named by the flags they count."""
    step: int
    sub: int
    variable: str
    problem: tuple              # (label, flag) pairs
    action: str
    affected: tuple             # flags whose counts add up
    justification: str
    optional: bool = False      # left out when nothing was affected
    examples: bool = False


def flag(step: int, name) -> str:
    return f"_{step}_{name}"


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


# --------------------------------------------------------------------- rules
# Each takes the frame as the earlier rules left it and returns it with its
# flags and new values, and its audit entries.
def rule_placeholder_junk(df: DataFrame, column: str, ph: str, step=1):
    """C1: null, or junk/'0' after strip -> placeholder."""
    missing, junk, total = (flag(step, n) for n in ("missing", "no_content", "total"))
    df = df.withColumns({missing: F.col(column).isNull(), junk: tx.is_junk_or_zero(column)})
    df = df.withColumn(total, F.col(missing) | F.col(junk))
    df = df.withColumn(column, F.when(F.col(total), F.lit(ph)).otherwise(F.col(column)))
    return df, [Entry(step, 0, column, (("missing", missing), ("no_content", junk)), f"set {ph}", (total,), "row kept")]


def rule_phone(df: DataFrame, column: str, ph: str, step=2, strip_first: bool = False):
    """C2: null, or not exactly 8 digits -> placeholder.  The original tests
    the raw value (no strip), so `` 22334455`` is replaced; ``strip_first``
    tests the stripped value instead, as the diagnosis does."""
    missing, bad, total = (flag(step, n) for n in ("missing", "wrong_format", "total"))
    tested = tx.ws_strip(column) if strip_first else F.col(column)
    df = df.withColumns({missing: F.col(column).isNull(), bad: _true(~tx.matches_phone(tested))})
    df = df.withColumn(total, F.col(missing) | F.col(bad))
    df = df.withColumn(column, F.when(F.col(total), F.lit(ph)).otherwise(F.col(column)))
    return df, [Entry(step, 0, column, (("missing", missing), ("wrong_format", bad)), f"set {ph}", (total,), "row kept")]


def rule_zero_typo(df: DataFrame, column: str, ph: str, step=3):
    """C3: null -> placeholder (not counted); letter-then-'0' -> 'O';
    then junk/'0' -> placeholder.  Affected = typos + junk."""
    filled, typo, junk = (flag(step, n) for n in ("filled", "typo", "no_content"))
    df = df.withColumns({filled: F.col(column).isNull(), typo: _true(tx.has_zero_typo(column))})
    df = df.withColumn(column, F.when(F.col(typo), tx.fix_zero_typo(column)).when(F.col(filled), F.lit(ph))
                       .otherwise(F.col(column)))
    df = df.withColumn(junk, tx.is_junk_or_zero(column))
    df = df.withColumn(column, F.when(F.col(junk), F.lit(ph)).otherwise(F.col(column)))
    return df, [Entry(step, 0, column, (("typo", typo), ("no_content", junk), ("filled", filled)),
                      f"0 to O, else set {ph}", (typo, junk), "spelling")]


def rule_zone(df: DataFrame, column: str, replacement: str, step=4):
    """C4: stripped value ``ZONA <n>`` -> the municipality that holds the zones."""
    zone = flag(step, "zone")
    df = df.withColumn(zone, _true(tx.matches_zone(tx.ws_strip(column))))
    df = df.withColumn(column, F.when(F.col(zone), F.lit(replacement)).otherwise(F.col(column)))
    return df, [Entry(step, 0, column, (("zone", zone),), f"set {replacement}", (zone,), "unit is the municipality")]


def rule_alias(df: DataFrame, column: str, aliases: dict, step=5):
    """C5: upper/stripped alias -> canonical catalogue value."""
    alias = flag(step, "alias")
    key = F.upper(tx.ws_strip(column))
    mapped = F.element_at(F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv]), key)
    df = df.withColumn(alias, _true(key.isin(list(aliases))))
    df = df.withColumn(column, F.when(F.col(alias), mapped).otherwise(F.col(column)))
    return df, [Entry(step, 0, column, (("alias", alias),), "set catalogue name", (alias,), "same entity")]


def rule_general_junk(df: DataFrame, columns: list[str], ph: str, step=6):
    """C6: separators-only (extended class) or a disguised null token, and not
    already the placeholder -> placeholder.  The replaced value stays in a
    column of its own, for the examples."""
    flags = {c: flag(step, i) for i, c in enumerate(columns)}
    df = df.withColumns({f: _true((tx.is_junk_ext(c) | tx.is_disguised_null(c)) & (F.col(c) != F.lit(ph)))
                         for c, f in flags.items()})
    df = df.withColumns({f + "_value": F.when(F.col(f), F.col(c)) for c, f in flags.items()}
                        | {c: F.when(F.col(f), F.lit(ph)).otherwise(F.col(c)) for c, f in flags.items()})
    return df, [Entry(step, i, c, (("no_content", flags[c]),), f"set {ph}", (flags[c],), "no information",
                      optional=True, examples=True) for i, c in enumerate(columns)]


def rule_fill_missing(df: DataFrame, columns: list[str], ph: str, step=7):
    """C7: remaining nulls -> placeholder."""
    flags = {c: flag(step, i) for i, c in enumerate(columns)}
    df = df.withColumns({f: F.col(c).isNull() for c, f in flags.items()})
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(ph)) for c in columns})
    return df, [Entry(step, i, c, (("missing", flags[c]),), f"set {ph}", (flags[c],), "no empty cell", optional=True)
                for i, c in enumerate(columns)]


def rule_whitespace(df: DataFrame, columns: list[str], step=10):
    """C9: strip and collapse whitespace runs in every text column; one total."""
    cells = flag(step, "cells")
    names = {c: flag(step, f"new_{i}") for i, c in enumerate(columns)}
    df = df.withColumns({n: tx.normalize_ws(c) for c, n in names.items()})
    changed = [_true(F.col(n) != F.col(c)).cast("int") for c, n in names.items()]
    df = df.withColumn(cells, sum(changed[1:], changed[0]) if changed else F.lit(0))
    df = df.withColumns({c: F.col(n) for c, n in names.items()}).drop(*names.values())
    return df, [Entry(step, 0, ALL_TEXT, (("cells", cells),), "strip, one space for runs", (cells,), "spacing")]


RULES = {
    "placeholder_junk": lambda df, cfg, cols: rule_placeholder_junk(df, cfg.roles.director, cfg.placeholder),
    "phone": lambda df, cfg, cols: rule_phone(df, cfg.roles.phone, cfg.placeholder, strip_first=cfg.phone_strip_first),
    "zero_typo": lambda df, cfg, cols: rule_zero_typo(df, cfg.roles.supervisor, cfg.placeholder),
    "zone": lambda df, cfg, cols: rule_zone(df, cfg.roles.municipality, cfg.zone_replacement),
    "alias": lambda df, cfg, cols: rule_alias(df, cfg.roles.department, cfg.aliases),
    "general_junk": lambda df, cfg, cols: rule_general_junk(
        df, [c for c in cols if c not in cfg.sweep_excluded()], cfg.placeholder),
    "fill_missing": lambda df, cfg, cols: rule_fill_missing(
        df, [c for c in cols if c not in cfg.fill_excluded()], cfg.placeholder),
    "whitespace": lambda df, cfg, cols: rule_whitespace(df, cols),
}


def raw(column: str) -> str:
    """Name under which a stage keeps the original value of a column."""
    return f"_raw_{column}"


def counted_events(events: DataFrame) -> DataFrame:
    """Counts of events, or of counts of their parts, by mark and value."""
    return events.groupBy("mark", "value").agg(F.sum("n").alias("n"))


# --------------------------------------------------------------------- driver
class Cleaning:
    """``Cleaning(df, config)`` -> ``.cleaned`` frame and ``.audit()`` log.

    ``staged`` holds the cleaned columns, the original ones under ``raw`` and
    all flags; what isn't used of it isn't computed.
    """

    def __init__(self, df: DataFrame, config: CleanConfig = DIRTY_CONFIG):
        self.df = df
        self.config = config
        text = string_columns(df)
        staged, self.entries = df.withColumns({raw(c): F.col(c) for c in text}), []
        for rule in RULES.values():
            staged, entries = rule(staged, config, text)
            self.entries += entries
        self.staged = staged
        self._observed = None

    @property
    def cleaned(self) -> DataFrame:
        return self.staged.select(*self.df.columns)

    def materialize(self, folder: str) -> DataFrame:
        """Write the cleaned table (Parquet) and read it back.

        The flag counts ride along as an ``Observation`` of the same write:
        no second pass over the input; the one observed row is kept.
        """
        spark = self.df.sparkSession
        obs = Observation("cleaning_audit")
        aggs = self._count_aggs()
        self.staged.observe(obs, *aggs).select(*self.df.columns).write.mode("overwrite").parquet(f"{folder}/cleaned")
        row, names = obs.get, self._counted()
        schema = T.StructType([T.StructField(n, T.LongType()) for n in names])
        self._observed = spark.createDataFrame([tuple(int(row[n] or 0) for n in names)], schema)
        return spark.read.parquet(f"{folder}/cleaned")

    def _counted(self) -> list[str]:
        return list(dict.fromkeys(f for e in self.entries for f in (*(f for _, f in e.problem), *e.affected)))

    def _count_aggs(self) -> list[Column]:
        types = dict(self.staged.dtypes)
        return [F.coalesce(F.sum(F.col(f).cast("int")), F.lit(0)).cast("bigint").alias(f) if types[f] == "int"
                else F.count_if(F.col(f)).alias(f) for f in self._counted()]

    def counts(self) -> DataFrame:
        """One row: every flag's count -- observed during ``materialize`` when
        that ran, otherwise one aggregate over the input."""
        return self._observed if self._observed is not None else self.staged.agg(*self._count_aggs())

    def errors_corrected(self) -> DataFrame:
        """A19: the sum of every audit row's affected count, one aggregate."""
        flags = [F.col(f) for e in self.entries for f in e.affected]
        return self.counts().select(sum(flags[1:], flags[0]).cast("bigint").alias("errors_corrected"))

    def event_list(self) -> Column:
        """The events ``(mark, value, n)`` of a row of ``staged``: its flags, the replaced
        value (C6) and the district's shape (C8)."""
        types, out = dict(self.staged.dtypes), []
        values = {e.affected[0] for e in self.entries if e.examples}

        def event(mark: str, value: Column, n: Column) -> Column:
            return F.struct(F.lit(mark).alias("mark"), value.cast("string").alias("value"), n.cast("bigint").alias("n"))

        for f in self._counted():
            n = F.col(f) if types[f] == "int" else F.col(f).cast("int")
            value = F.col(f + "_value") if f in values else F.lit(None)
            out.append(F.when(n > 0, event(f, value, n)))
        district = self.config.roles.district
        if self.config.document_district and district in self.df.columns:
            shape = tx.shape_signature(tx.ws_strip(raw(district)))
            out.append(F.when(F.col(raw(district)).isNotNull(), event("shape", shape, F.lit(1))))
        return F.filter(F.array(*out), lambda e: e.isNotNull())

    def events(self) -> DataFrame:
        """``(mark, value, n)``: how often each event occurs."""
        return counted_events(self.staged.select(F.explode(self.event_list()).alias("e")).select("e.*"))

    def audit(self, k: int = K.EXAMPLES_K, events: DataFrame | None = None) -> DataFrame:
        """``(step, sub, variable, problem, action, affected, justification)``.

        The input is read once, for the events (or not at all, if they are
        given); marks are bounded by the rules, so they are gathered to one map.
        """
        cfg = self.config
        events = written(self.events() if events is None else events, "clean-events")
        per_mark = events.groupBy("mark").agg(
            F.sum("n").alias("n"), F.count("value").alias("kinds"), F.max("n").alias("most"),
            F.min_by("value", F.struct((-F.col("n")).alias("m"), F.col("value").alias("v"))).alias("main"))
        shown = first_k_values(events.where("mark <> 'shape'"), "mark", "value", k=k)
        marks = per_mark.join(shown, "mark", "left").agg(F.map_from_entries(F.collect_list(F.struct(
            "mark", F.struct("n", "kinds", "most", "main", "examples")))).alias("of"))

        def n(f: str) -> Column:
            return F.coalesce(F.col("of")[f]["n"], F.lit(0))

        def labelled(pairs) -> Column:
            return F.concat_ws(" ", *[F.concat(F.lit(f"{label}="), n(f).cast("string")) for label, f in pairs])

        def line(step, sub, variable, problem, action, affected, why) -> Column:
            return F.struct(F.lit(step).alias("step"), F.lit(sub).alias("sub"), F.lit(variable).alias("variable"),
                            problem.alias("problem"), F.lit(action).alias("action"),
                            affected.cast("bigint").alias("affected"), F.lit(why).alias("justification"))

        lines = []
        for e in self.entries:
            affected = sum((n(f) for f in e.affected[1:]), n(e.affected[0]))
            problem = labelled(e.problem)
            if e.examples:
                problem = F.concat(problem, F.lit(" e.g. "), F.coalesce(F.col("of")[e.affected[0]]["examples"], F.lit("")))
            row = line(e.step, e.sub, e.variable, problem, e.action, affected, e.justification)
            lines.append(F.when(affected > 0, row) if e.optional else row)
        r = cfg.roles
        if cfg.document_district and r.district in self.df.columns:
            shape = F.col("of")["shape"]
            lines.append(line(8, 0, r.district, F.concat(
                F.lit("shapes="), F.coalesce(shape["kinds"], F.lit(0)).cast("string"), F.lit(" off_main="),
                F.coalesce(shape["n"] - shape["most"], F.lit(0)).cast("string"), F.lit(" main="),
                F.coalesce(shape["main"], F.lit(""))), "none", F.lit(0), "identifier"))
        lines += [line(9, i, c, F.lit("none"), "", F.lit(0), "") for i, c in enumerate(cfg.no_issue_columns)]
        return (marks.select(F.explode(F.filter(F.array(*lines), lambda s: s.isNotNull())).alias("r")).select("r.*")
                .orderBy("step", "sub"))


def errors_corrected(audit: DataFrame) -> DataFrame:
    """A19: sum of affected rows over the audit log."""
    return audit.agg(F.coalesce(F.sum("affected"), F.lit(0)).cast("bigint").alias("errors_corrected"))


def rule_changes(df: DataFrame, rule: str, config: CleanConfig = DIRTY_CONFIG) -> DataFrame:
    """Apply one rule alone to ``df``: ``(key, variable, before, after)`` of changed cells."""
    text = string_columns(df)
    staged, _ = RULES[rule](df.withColumns({raw(c): F.col(c) for c in text}), config, text)
    pairs = [F.struct(F.lit(c).alias("variable"), F.col(raw(c)).alias("before"), F.col(c).alias("after")) for c in text]
    return (staged.select(F.col(raw(config.roles.key)).alias("key"), F.explode(F.filter(
        F.array(*pairs), lambda p: ~p["before"].eqNullSafe(p["after"]))).alias("p")).select("key", "p.*"))
