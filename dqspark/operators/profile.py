"""Column profiling: count aggregates and the value-frequency frame.

Counts of rows with some property (missing, stray whitespace, letters ...) are
one aggregate over the table, a row per partition in the shuffle.  What needs
distinct values (distinct counts, signatures, domains, variants) reads the
frame ``(variable, value, multiplicity)`` of ``value_freq``: one scan and one
partially aggregated shuffle, written once per diagnosis (``plans.diagnosis``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from dqspark.functions import constants as K
from dqspark.functions import text as tx


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in set(exclude)]


def _pos(columns: list[str]) -> Column:
    """1-based position of ``variable`` in ``columns`` (pure expression)."""
    return F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("variable")).cast("int")


def value_freq(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(variable, pos, value, n)``: multiplicity of every value, nulls included."""
    cols = list(columns or df.columns)
    projected = df.select([F.col(c).cast("string").alias(c) for c in cols])
    long = projected.unpivot([], cols, "variable", "value")
    return (long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("pos", _pos(cols)))


def shape(df: DataFrame) -> DataFrame:
    """Rows and columns as ``(metric, value)``."""
    return (df.agg(F.count(F.lit(1)).alias("rows"))
            .select(F.expr(f"stack(2, 'rows', rows, 'columns', cast({len(df.columns)} as bigint))"
                           " as (metric, value)")))


def _per_column(df: DataFrame, cols: list[str], measures: dict) -> DataFrame:
    """``(variable, pos, <measure>...)`` from one aggregate; measures map a
    name to a function of (column, column name)."""
    text = df.select([F.col(c).cast("string").alias(c) for c in cols])
    row = text.agg(*[make(F.col(c), c).cast("bigint").alias(f"{m}_{i}")
                     for i, c in enumerate(cols) for m, make in measures.items()])
    structs = [F.struct(F.lit(c).alias("variable"), F.lit(i + 1).alias("pos"),
                        *[F.col(f"{m}_{i}").alias(m) for m in measures]) for i, c in enumerate(cols)]
    return row.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def column_stats(df: DataFrame, phone_column: str | None = None) -> DataFrame:
    """``(variable, pos, type, rows, missing, edge_ws, multi_ws, corrupt, letters, is_text)``
    of every column in one pass; ``letters`` only for the phone column."""
    cols, types = df.columns, dict(df.dtypes)
    stats = _per_column(df, cols, {
        "rows": lambda c, _: F.count(F.lit(1)),
        "missing": lambda c, _: F.count_if(c.isNull()),
        "edge_ws": lambda c, _: F.count_if(tx.has_edge_ws(c)),
        "multi_ws": lambda c, _: F.count_if(tx.has_multi_ws(c)),
        "corrupt": lambda c, _: F.count_if(tx.has_corrupt_char(c)),
        "letters": lambda c, name: F.count_if(c.rlike(tx.J_LETTER)) if name == phone_column
        else F.max(F.lit(None).cast("bigint")),
    })
    kind = F.element_at(F.create_map(*[F.lit(x) for c in cols for x in (c, types[c])]), F.col("variable"))
    return stats.withColumn("type", kind).withColumn("is_text", F.col("type") == "string")


def missing(df: DataFrame) -> DataFrame:
    """Missing count and percent (2 decimals) per column, most missing first."""
    counted = _per_column(df, df.columns, {"missing": lambda c, _: F.count_if(c.isNull()),
                                           "rows": lambda c, _: F.count(F.lit(1))})
    return counted.select("variable", "pos", "missing", missing_pct()).orderBy(F.desc("missing"), "pos")


def missing_pct() -> Column:
    return F.round(F.col("missing").cast("double") * 100 / F.col("rows"), 2).alias("missing_pct")


def distinct_counts(vf: DataFrame) -> DataFrame:
    """Exact distinct non-null values per column."""
    return (vf.groupBy("variable", "pos").agg(F.count("value").alias("distinct_values"))
            .orderBy("pos"))


def _row_key(df: DataFrame, cols: list[str], digest: bool) -> list[Column]:
    """Grouping key of a whole row: one SHA-256 digest of its string columns
    (32 bytes are held and travel instead of whole texts; each text is preceded
    by its length and a null stands apart, so no two rows are written alike),
    other columns as they are."""
    types = dict(df.dtypes)
    texts = [c for c in cols if types[c] == "string"] if digest else []
    plain = [F.col(c) for c in cols if c not in texts]
    if not texts:
        return plain
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in texts]
    return [F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256)).alias("_row_digest"), *plain]


def distinct_counts_approx(df: DataFrame, rsd: float = 0.01, columns: list[str] | None = None) -> DataFrame:
    """Approximate distinct non-null values per column (HyperLogLog++, relative
    standard deviation ``rsd``): one pass with map-side sketches and no
    value-level shuffle, for when exact counts are not required."""
    cols = list(columns or df.columns)
    row = df.agg(*[F.approx_count_distinct(F.col(c), rsd).alias(c) for c in cols])
    stacked = row.select(F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("pos"), F.lit(c).alias("variable"), F.col(c).alias("distinct_values"))
        for i, c in enumerate(cols)])).alias("s"))
    return stacked.select("s.variable", "s.pos", "s.distinct_values").orderBy("pos")


def duplicate_count(df: DataFrame, exclude=(), digest: bool = True) -> DataFrame:
    """Rows minus distinct rows over all columns (null equals null)."""
    cols = [c for c in df.columns if c not in set(exclude)]
    groups = df.groupBy(*_row_key(df, cols, digest)).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint")
                      .alias("duplicates"))


def duplicate_examples(df: DataFrame, k: int = K.DUPLICATE_EXAMPLES_K, exclude=(),
                       digest: bool = True) -> DataFrame:
    """First ``k`` rows (ordered by every column, nulls last) of duplicated groups.

    Duplicated groups are found on digests; only their rows are then
    grouped on the real values and ordered.  Members of a group are
    identical, so only the ``k`` first groups can contribute; each is
    repeated ``least(n, k)`` times, never ``n`` times.
    """
    cols = [c for c in df.columns if c not in set(exclude)]
    order = [F.col(c).asc_nulls_last() for c in cols]
    if digest:
        keys = _row_key(df, cols, True)
        dkeys = [f"_d{i}" for i in range(len(keys))]
        keyed = df.select(*cols, *[c.alias(d) for c, d in zip(keys, dkeys, strict=True)])
        dup = keyed.groupBy(*dkeys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).drop("_n")
        cond = None
        for d in dkeys:
            c = F.col(f"k.{d}").eqNullSafe(F.col(f"g.{d}"))
            cond = c if cond is None else cond & c
        df = keyed.alias("k").join(dup.alias("g"), cond, "left_semi").select(*cols)
    groups = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1).orderBy(*order).limit(k))
    rep = groups.withColumn("_r", F.explode(F.array_repeat(F.lit(1), F.least(F.col("n"), F.lit(k)).cast("int"))))
    return rep.select(*cols).orderBy(*order).limit(k)


def first_k_values(frame: DataFrame, group: str, value: str, k: int = K.EXAMPLES_K,
                   sep: str = ", ", out: str = "examples") -> DataFrame:
    """``(group, out)``: the ``k`` smallest distinct values per group, joined.

    The window carries a ``rank <= k`` filter, which Spark plans as a
    partial ``WindowGroupLimit`` before the shuffle, so a group with
    millions of values sends only ``k`` per map partition.
    """
    d = frame.select(group, value).where(F.col(value).isNotNull()).distinct()
    w = Window.partitionBy(group).orderBy(F.col(value))
    top = d.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    return (top.groupBy(group)
            .agg(F.array_join(F.array_sort(F.collect_list(value)), sep).alias(out)))


def corrupt_examples(df: DataFrame, columns: list[str], k: int = K.EXAMPLES_K) -> DataFrame:
    """``(variable, corrupt_examples)``; only values with U+FFFD enter the shuffle."""
    long = df.select(*columns).unpivot([], columns, "variable", "value").where(tx.has_corrupt_char("value"))
    return first_k_values(long, "variable", "value", k=k, out="corrupt_examples")


def format_issues(df: DataFrame, phone_column: str | None = None, stats: DataFrame | None = None) -> DataFrame:
    """Per text column: rows with edge whitespace, with whitespace runs, with
    U+FFFD, letters in the phone column, and 5 corrupt examples."""
    stats = stats if stats is not None else column_stats(df, phone_column)
    return (stats.where("is_text").select("variable", "pos", "edge_ws", "multi_ws", "corrupt", "letters")
            .join(corrupt_examples(df, string_columns(df)), "variable", "left")
            .withColumn("corrupt_examples", F.coalesce("corrupt_examples", F.lit("")))
            .orderBy("pos"))


def letters_in_numeric(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.lit(column).alias("variable"), F.count_if(F.col(column).rlike(tx.J_LETTER)).alias("letters"))


def shape_signatures(vf: DataFrame, columns: list[str], keep_digit_class: bool = False) -> DataFrame:
    """``(variable, signature, n)`` over stripped non-null values."""
    v = vf.where(F.col("variable").isin(columns) & F.col("value").isNotNull())
    sig = tx.shape_signature(tx.ws_strip("value"), keep_digit_class)
    return (v.groupBy("variable", "pos", sig.alias("signature"))
            .agg(F.sum("n").cast("bigint").alias("n")))


def shape_profile(vf: DataFrame, columns: list[str], keep_digit_class: bool = False,
                  k: int = K.EXAMPLES_K) -> DataFrame:
    """Signatures per column, the most common (ties: smallest), rows off it
    and ``k`` off-pattern examples."""
    sigs = shape_signatures(vf, columns, keep_digit_class)
    summary = sigs.groupBy("variable", "pos").agg(
        F.count(F.lit(1)).alias("n_signatures"),
        F.min_by("signature", F.struct((-F.col("n")).alias("m"), F.col("signature").alias("s")))
        .alias("most_common"),
        F.sum("n").alias("_total"))
    # ``summary`` has one row per profiled column (a bound known from the
    # arguments): broadcast it, so no column's values meet in one task
    best = F.broadcast(summary.select("variable", "most_common"))
    top_n = (sigs.alias("s").join(best.alias("m"),
                                  (F.col("s.variable") == F.col("m.variable"))
                                  & (F.col("s.signature") == F.col("m.most_common")))
             .select(F.col("s.variable").alias("variable"), F.col("s.n").alias("_top")))
    v = vf.where(F.col("variable").isin(columns) & F.col("value").isNotNull())
    stripped = v.select("variable", tx.ws_strip("value").alias("sv"), "n")
    off = (stripped.join(best, "variable")
           .where(tx.shape_signature("sv", keep_digit_class) != F.col("most_common")))
    ex = first_k_values(off, "variable", "sv", k=k, out="examples")
    return (summary.join(top_n, "variable")
            .select("variable", "pos", F.col("n_signatures").cast("bigint").alias("n_signatures"),
                    "most_common", (F.col("_total") - F.col("_top")).cast("bigint").alias("off_pattern"))
            .join(ex, "variable", "left")
            .withColumn("examples", F.coalesce("examples", F.lit("")))
            .orderBy("pos"))
