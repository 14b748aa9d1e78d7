"""Ingest messy delimited exports into rows with lineage and a per-file ledger.

Files are read as lines by the ``raw_export`` source, so a file is spread over
as many tasks as it has byte ranges.  A line's place is (start of its range, its
byte, part of the line): places compare within a file, with no sort.

* encoding: aggregates over a file's lines (all valid UTF-8? any byte that
  cp1252 leaves undefined? the marker word anywhere?) choose the first of the
  candidate encodings that decodes the whole file; a file without the marker
  isn't decoded.  cp1252 is Latin-1 with its C1 range translated;
* lines are split further at the other line breaks Python knows;
* in files with a line of odd quotes, lines inside an open quote are joined to
  their record: the quotes of each range are counted, the sums of the ranges
  before tell whether a range begins inside a quote, and each range then goes on
  alone; a file whose last quote stays open is an error;
* the header is the line with all marker words at the smallest place;
* header and body cells come from one expression for any width; the per-file
  header becomes the keys of a ``map`` so files of different widths coexist;
* unnamed columns go, names are normalised, rows are kept whose key matches
  the key pattern.

A failing file becomes an ``Error: ...`` ledger row; the others go on.
"""

from __future__ import annotations

from dataclasses import dataclass
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dqspark.functions import constants as K
from dqspark.functions import text as tx
from dqspark.session import written
from dqspark.sources import raw_export

# Python str.splitlines() boundaries beside \\n, \\r and \\r\\n, at which the text reader splits
OTHER_BREAKS = "[\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"
UNDEFINED = "[" + "".join(chr(b) for b in range(0x80, 0xA0) if not bytes([b]).decode("cp1252", "ignore")) + "]"
C1 = "".join(chr(b) for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore"))
C1_CP1252 = "".join(bytes([ord(c)]).decode("cp1252") for c in C1)
BOM = "\ufeff"


@dataclass
class Landing:
    """Raw files: ``files`` (origin) and ``lines`` (origin, start, nr, raw)."""
    files: DataFrame
    lines: DataFrame


def read_landing(spark: SparkSession, folder: str, glob: str = "*.csv", pattern: str = raw_export.ORIGIN,
                 split: int | None = None) -> Landing:
    """All matching files of a folder; error if none."""
    # names alone: empty files have no lines but a ledger row
    names = sorted({origin for _, origin, _ in raw_export.listed(folder, glob, pattern)})
    if not names:
        raise FileNotFoundError(f"no {glob} files in {folder}; run the export/download step first")
    return Landing(spark.createDataFrame([(n,) for n in names], "origin string"),
                   raw_export.load(spark, folder, glob, pattern, split))


def _odd_quotes(line: Column) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit('"')))) % 2 == 1


def cells(line: Column | str, sep: str = ";") -> Column:
    """Cells of a delimited line as an array; quotes respected and removed, empty cells null."""
    if sep in "\\^$.|?*+()[]{}":
        raise ValueError("the separator must be a plain character")
    line = F.col(line) if isinstance(line, str) else line
    found = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(f'{sep}(?:"(?:[^"]++|"")*+")?[^{sep}]*'), F.lit(0))

    def clean(cell: Column) -> Column:
        body = F.substring(cell, 2, 1 << 30)
        quoted = body.startswith('"') & body.endswith('"') & (F.length(body) >= 2)
        inner = F.replace(body.substr(F.lit(2), F.length(body) - 2), F.lit('""'), F.lit('"'))
        return F.nullif(F.when(quoted, inner).otherwise(body), F.lit(""))
    return F.transform(found, clean)


def normalize_name(c: Column) -> Column:
    """strip, upper, whitespace runs -> ``_``."""
    return F.regexp_replace(F.upper(tx.ws_strip(c)), tx.J_SPLIT_WS, "_")


@dataclass
class Ingested:
    rows: DataFrame     # (origin, data map<string,string>) of kept rows of good files
    ledger: DataFrame   # one row per file
    columns: DataFrame  # (origin, columns array<string>) final columns of good files

    def materialize(self, folder: str) -> "Ingested":
        """Write rows, ledger and column lists once (Parquet) and read them
        back: later steps start from a scan, and lineage is cut."""
        spark = self.rows.sparkSession
        for name in ("rows", "ledger", "columns"):
            getattr(self, name).write.mode("overwrite").parquet(f"{folder}/{name}")
        return Ingested(*(spark.read.parquet(f"{folder}/{n}") for n in ("rows", "ledger", "columns")))


def file_encodings(landing: Landing, marker: str = K.ENCODING_MARKER) -> DataFrame:
    """``(origin, encoding)`` per file; encoding null if none of the candidates holds the marker."""
    text, latin = F.col("raw").cast("string"), F.decode("raw", "ISO-8859-1")
    valid = F.is_valid_utf8(text)
    seen = F.upper(F.when(valid, text).otherwise(latin)).contains(marker)
    stats = landing.lines.groupBy("origin").agg(
        F.bool_and(valid).alias("utf8"), F.bool_or(latin.rlike(UNDEFINED)).alias("undefined"),
        F.bool_or(seen).alias("marked"))
    encoding = F.when(F.col("marked"), F.when(F.col("utf8"), K.ENCODINGS[0])
                      .when(F.col("undefined"), K.ENCODINGS[3]).otherwise(K.ENCODINGS[2]))
    return landing.files.join(stats, "origin", "left").select("origin", encoding.alias("encoding"))


def decoded_lines(landing: Landing, encodings: DataFrame) -> DataFrame:
    """``(origin, at, line)`` of the files with an encoding; ``at`` orders the lines of a file."""
    latin = F.decode("raw", "ISO-8859-1")
    utf8 = F.col("raw").cast("string")
    begins = F.col("nr") == 0
    text = (F.when(F.col("encoding") == K.ENCODINGS[0],
                   F.when(begins & utf8.startswith(BOM), utf8.substr(F.lit(2), F.length(utf8))).otherwise(utf8))
            .when(F.col("encoding") == K.ENCODINGS[2], F.translate(latin, C1, C1_CP1252)).otherwise(latin))
    return (landing.lines.join(encodings.where("encoding is not null"), "origin")
            .select("origin", "start", "nr", F.posexplode(F.split(text, OTHER_BREAKS)).alias("part", "line"))
            .select("origin", F.struct("start", "nr", "part").alias("at"), "line"))


def whole_records(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines inside an open quote joined (with ``\\n``) to the line that opened it; files (origin) with a quote left open.

    Only files with a line of odd quotes are touched, those left open are
    taken out.  Windows run within one range of a file; what a range needs of the
    ranges before it, their parity and the place of the last record, comes from a
    row per range.
    """
    odd = _odd_quotes(F.col("line")).cast("int")
    touched = lines.where(odd == 1).select("origin").distinct()
    plain = lines.join(touched, "origin", "left_anti")
    own = lines.join(touched, "origin", "left_semi").withColumn("start", F.col("at.start")).withColumn("odd", odd)
    before = Window.partitionBy("origin").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    counted = own.groupBy("origin", "start").agg(F.sum("odd").alias("odds"))
    sums = counted.select("origin", "start", "odds", F.coalesce(F.sum("odds").over(before), F.lit(0)).alias("outside"))
    sums = written(sums, "ingest-quotes")
    unclosed = sums.groupBy("origin").agg(F.sum("odds").alias("odds")).where("odds % 2 = 1").select("origin")
    order = Window.partitionBy("origin", "start").orderBy("at")
    inside = (F.col("outside") + F.coalesce(F.sum("odd").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) % 2 == 1
    marked = (own.join(sums.drop("odds"), ["origin", "start"]).join(unclosed, "origin", "left_anti")
              .withColumn("begins", F.when(~inside, F.col("at"))))
    marked = written(marked.withColumn("record", F.last("begins", True).over(order)).drop("odd", "outside"), "ingest-quoted")
    last = marked.groupBy("origin", "start").agg(F.max("begins").alias("last"))
    carried = last.select("origin", "start", F.last("last", True).over(before).alias("carried"))
    joined = (marked.join(carried, ["origin", "start"]).withColumn("record", F.coalesce("record", "carried"))
              .groupBy("origin", "record").agg(F.array_join(F.transform(
                  F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n").alias("line")))
    return plain.unionByName(joined.withColumnRenamed("record", "at")), unclosed


def ingest(landing: Landing, sep: str = ";", key: str = "CODIGO", markers=K.HEADER_MARKERS,
           required=K.REQUIRED_HEADERS, marker: str = K.ENCODING_MARKER) -> Ingested:
    # tables that several later steps read are written once
    files = written(file_encodings(landing, marker), "ingest-files")
    lines = written(decoded_lines(landing, files), "ingest-lines")
    unclosed = None
    if not lines.where(_odd_quotes(F.col("line"))).isEmpty():
        lines, unclosed = whole_records(lines)
        lines = written(lines, "ingest-records")
    upper = F.upper("line")
    is_header = F.lit(True)
    for m in markers:
        is_header = is_header & upper.contains(m)
    header = lines.where(is_header).groupBy("origin").agg(F.min(F.struct("at", "line")).alias("h"))

    # repeated header names get ".1", ".2", ... like the CSV reader the
    # original used (and so never collide as map keys)
    def dedupe_names(names: Column) -> Column:
        earlier = lambda n, i: F.size(F.filter(F.slice(names, 1, i), lambda m: m == n))
        return F.transform(names, lambda n, i: F.when(earlier(n, i) > 0, F.concat(n, F.lit("."), earlier(n, i).cast("string")))
                           .otherwise(n))

    unnamed = lambda n: F.lower(tx.ws_strip(n)).startswith("unnamed")
    # one row per file
    hdr = (header.select("origin", F.col("h.at").alias("h"), cells(F.col("h.line"), sep).alias("names"))
           .withColumn("names", F.transform("names", lambda n, i: F.coalesce(n, F.concat(F.lit("Unnamed: "), i.cast("string")))))
           .withColumn("names", dedupe_names(F.col("names")))
           .select("origin", "h", F.size("names").alias("n_header"),
                   F.transform("names", lambda n: ~unnamed(n)).alias("keepmask"),
                   F.transform(F.filter("names", lambda n: ~unnamed(n)), normalize_name).alias("kept"),
                   F.filter("names", unnamed).alias("unnamed"))
           .withColumn("has_key", F.array_contains("kept", key)))
    hdr = written(hdr, "ingest-headers")

    body = (lines.join(hdr.select("origin", "h", "n_header", "keepmask", "kept"), "origin")
            .withColumn("after", F.col("at") > F.col("h"))
            .withColumn("cells", cells(F.col("line"), sep))
            .withColumn("nf", F.size("cells"))
            .withColumn("counted", F.col("after") & (F.col("line").contains(sep) | (tx.ws_strip("line") != ""))))
    values = F.transform(F.slice("cells", F.lit(1), F.col("n_header")),
                         lambda v: F.when(v.isin(list(K.PANDAS_NA_STRINGS)), None).otherwise(v))
    padded = F.concat(values, F.array_repeat(F.lit(None).cast("string"), F.greatest(F.col("n_header") - F.col("nf"), F.lit(0))))
    body = body.withColumn("data", F.map_from_arrays(
        F.col("kept"), F.filter(padded, lambda v, i: F.element_at(F.col("keepmask"), i + 1))))
    keyval = tx.ws_strip(F.try_element_at(F.col("data"), F.lit(key)))
    body = body.withColumn("valid", F.col("counted") & F.coalesce(keyval.rlike(tx.J_KEY), F.lit(False)))
    # cells are parsed once: counts, bad lines and rows all read the written body
    body = written(body.select("origin", "at", "h", "n_header", "nf", "after", "counted", "valid",
                               F.when(F.col("valid"), F.col("data")).alias("data")), "ingest-body")

    wide = F.col("counted") & (F.col("nf") > F.col("n_header"))
    stats = body.groupBy("origin").agg(
        F.count_if(F.col("at") < F.col("h")).alias("lines_before"),
        F.count_if("counted").alias("rows_from_header"),
        F.count_if(F.col("counted") & ~F.col("valid")).alias("rows_removed"),
        F.count_if("valid").alias("rows_kept"),
        F.min(F.when(wide, F.col("at"))).alias("bad_at"),
        F.max(F.when(wide, F.col("nf"))).alias("bad_nf"))
    stats = written(stats, "ingest-stats")
    bad = stats.where("bad_at is not null").select("origin", "bad_at")
    bad_line = (body.join(bad, "origin").groupBy("origin")
                .agg((F.count_if(F.col("after") & (F.col("at") <= F.col("bad_at"))) + 1).alias("bad_line")))
    ledger = (files.join(hdr, "origin", "left").join(stats, "origin", "left").join(bad_line, "origin", "left"))
    ledger = (ledger.withColumn("open", F.lit(None)) if unclosed is None
              else ledger.join(unclosed.withColumn("open", F.lit(True)), "origin", "left"))
    error = (F.when(F.col("encoding").isNull(), F.concat(F.lit("Error: could not decode "), F.col("origin")))
             .when(F.col("open").isNotNull(), F.lit("Error: a quote is left open"))
             .when(F.col("h").isNull(), F.lit("Error: header line not found"))
             .when(F.col("bad_nf").isNotNull(), F.format_string(
                 "Error: Expected %d fields in line %d, saw %d", F.col("n_header"), F.col("bad_line"), F.col("bad_nf")))
             .when(~F.col("has_key"), F.lit(f"Error: '{key}'")))
    req = F.array(*[F.lit(r) for r in sorted(required)])
    missing_req = F.array_join(F.array_sort(F.array_except(req, F.col("kept"))), ", ")
    status = F.coalesce(error, F.when(missing_req == "", F.lit("Correcto")).otherwise(F.lit("ver columnas")))
    ok = error.isNull()
    out_name = F.concat(F.regexp_replace(F.regexp_replace(F.regexp_replace("origin", r"\.[^.]*$", ""), " ", "_"),
                                         r"[()]", ""), F.lit("_new.csv"))

    def when_ok(c, cast=None):
        c = F.when(ok, c)
        return c.cast(cast) if cast else c

    ledger = ledger.select(
        "origin",
        when_ok(F.col("encoding")).alias("encoding"),
        *[when_ok(F.coalesce(n, F.lit(0)), "bigint").alias(n)
          for n in ("lines_before", "rows_from_header", "rows_removed", "rows_kept")],
        when_ok(F.col("n_header"), "bigint").alias("columns_original"),
        when_ok(F.size("kept"), "bigint").alias("columns_final"),
        when_ok(F.array_join("unnamed", ", ")).alias("unnamed_dropped"),
        when_ok(missing_req).alias("required_missing"),
        status.alias("status"),
        when_ok(out_name).alias("output_file"))
    ledger = written(ledger, "ingest-ledger")
    good = ledger.where(~F.col("status").startswith("Error")).select("origin")
    return Ingested(rows=body.where("valid").join(good, "origin", "left_semi").select("origin", "data"), ledger=ledger,
                    columns=hdr.join(good, "origin", "left_semi").select("origin", F.col("kept").alias("columns")))


def strict_union(ing: Ingested, origin_column: str = "origen") -> DataFrame:
    """Union all good files under the first file's ordered column list.

    Raises ``ValueError`` naming the first file whose columns differ, like
    the original.  The comparison runs in Spark against the first file's
    column list (one broadcast row); only that list and, on failure, one
    offending file name reach the driver.
    """
    first = ing.columns.orderBy("origin").limit(1).collect()
    if not first:
        raise FileNotFoundError("no ingested files to unite")
    reference = list(first[0]["columns"])
    ref = F.array(*[F.lit(c) for c in reference])
    bad = ing.columns.where(F.col("columns") != ref).orderBy("origin").limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0]['origin']} has a different structure")
    return ing.rows.select(*[F.element_at("data", c).alias(c) for c in reference],
                           F.col("origin").alias(origin_column))


def union_ledger(ing: Ingested) -> DataFrame:
    """``(file, rows, data_columns, schema_ok)`` against the first file's columns."""
    cols = ing.columns
    # the first file's column list is one value: a scalar subquery
    ref = cols.orderBy("origin").limit(1).select("columns").scalar()
    counts = ing.rows.groupBy("origin").agg(F.count(F.lit(1)).alias("rows"))
    return (cols.withColumn("ref", ref).join(counts, "origin", "left")
            .select(F.col("origin").alias("file"), F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
                    F.size("columns").cast("bigint").alias("data_columns"),
                    (F.col("columns") == F.col("ref")).alias("schema_ok")))


def file_review(rows: DataFrame, origin: str, department: str, municipality: str,
                n_columns: int) -> DataFrame:
    """Per file: rows, columns, distinct departments and municipalities
    (stripped), status ``Correcto`` iff one department.

    Without the department column the status says so; without the
    municipality column the count is 0.  ``file_values`` lists the values.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    for name, column in (("departments", department), ("municipalities", municipality)):
        aggs.append(F.countDistinct(tx.ws_strip(column)).alias(name) if column in rows.columns
                    else F.max(F.lit(None if name == "departments" else 0).cast("bigint")).alias(name))
    status = (F.when(F.col("departments") == 1, F.lit("Correcto")).otherwise(F.lit("Revisar")) if department in rows.columns
              else F.lit(f"column {department} missing"))
    return rows.groupBy(origin).agg(*aggs).select(
        F.col(origin).alias("file"), F.col("rows").cast("bigint").alias("rows"),
        F.lit(n_columns).cast("bigint").alias("columns"), "departments", "municipalities", status.alias("status"))


def file_values(rows: DataFrame, origin: str, department: str, municipality: str) -> DataFrame:
    """``(file, variable, value, n)``: every distinct department and municipality of each file."""
    cols = [c for c in (department, municipality) if c in rows.columns]
    long = rows.select(F.col(origin).alias("file"), *[tx.ws_strip(c).alias(c) for c in cols]) \
        .unpivot(["file"], cols, "variable", "value")
    return long.where("value is not null").groupBy("file", "variable", "value").agg(F.count(F.lit(1)).alias("n"))
