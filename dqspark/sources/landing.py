"""Raw export files and result pages derived from the driver tables by Spark.

``write_export`` writes a registry frame the way the registry's web export
looks, as real files: leading report lines, a ``;``-separated header with
unnamed columns, data rows, footer rows, and cp1252 bytes (UTF-8 with BOM when
a value of the file isn't representable in cp1252).

Files hold about ``rows_per_file`` data rows: a group's rows are dealt to
chunks by a hash of the key, so no file grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqspark.sources.ingest import C1, C1_CP1252

LEADING_LINES = 26
FOOTER_ROWS = 5
ROWS_PER_FILE = 5000


def quote_field(c: Column) -> Column:
    """CSV quoting for ``;``-separated output; null -> empty field."""
    needs = c.rlike('[;"\\r\\n]')
    quoted = F.concat(F.lit('"'), F.regexp_replace(c, '"', '""'), F.lit('"'))
    return F.coalesce(F.when(needs, quoted).otherwise(c), F.lit(""))


def beyond_cp1252(text: Column) -> Column:
    """Whether a text has characters that cp1252 lacks."""
    return F.coalesce(text.rlike(f"[^\\x00-\\x7f\\xa0-\\xff{C1_CP1252}]"), F.lit(False))


def as_cp1252(text: Column) -> Column:
    """The cp1252 bytes of a text, as the raw line the text writer puts out."""
    return F.encode(F.translate(text, C1_CP1252, C1), "ISO-8859-1").cast("string")


def file_group(department: Column) -> Column:
    """Files are per region: an alias department lands in its region's file."""
    return F.regexp_replace(department, " CAPITAL$", "")


def chunk_of(key: Column, chunks: Column) -> Column:
    """Chunk of a row: the first 8 digits of the key's digest."""
    digits = F.conv(F.substring(F.md5(F.coalesce(key, F.lit("")).cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(digits, chunks).cast("int")


def write_export(df: DataFrame, folder: str, header: list[tuple[str, str | None]], group: Column, key: str,
                 rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write ``<folder>/<origin>/<origin>``, one export file per group and chunk.

    ``header`` lists ``(header cell, source column or None)``; a ``None``
    source is an unnamed, empty column.
    """
    g = df.select(group.alias("_g"), F.col(key).alias("_k"),
                  F.concat_ws(";", *[quote_field(F.col(c)) if c else F.lit("") for _, c in header]).alias("line"))
    sizes = g.groupBy("_g").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / rows_per_file)).cast("int").alias("_nc"))
    rows = g.join(sizes, "_g")
    name = F.format_string("export_%s_%03d.csv", F.regexp_replace("_g", " ", "_"), chunk_of(F.col("_k"), F.col("_nc")))
    data = rows.select(name.alias("origin"), "_g", F.lit(1).alias("sec"), F.col("_k").alias("o"), "line")
    files = data.groupBy("origin").agg(F.first("_g").alias("_g"), F.count(F.lit(1)).alias("n"),
                                       F.bool_or(beyond_cp1252(F.col("line"))).alias("utf8"))
    first = F.concat(F.lit("REPORT;"), F.col("_g"))
    head = [first, *[F.lit("")] * 3, *[F.lit(f";;listing line {i}") for i in range(4, LEADING_LINES)],
            F.lit(";".join(h for h, _ in header))]
    foot = [F.concat(F.lit("Total;"), F.col("n").cast("string")), F.lit("Generated by the registry export;;"),
            F.lit(";;;"), F.lit("Page 1 of 1"), F.lit("End of report")]
    around = files.select("origin", F.explode(F.array(*[
        F.struct(F.lit(sec).alias("sec"), F.lit(f"{i:03d}").alias("o"), t.alias("line"))
        for sec, part in ((0, head), (2, foot)) for i, t in enumerate(part)])).alias("s")).select("origin", "s.*")
    lines = around.unionByName(data.select("origin", "sec", "o", "line")).join(files.select("origin", "utf8"), "origin")
    bom = F.when((F.col("sec") == 0) & (F.col("o") == "000"), F.lit("\ufeff")).otherwise(F.lit(""))
    raw = F.when(F.col("utf8"), F.concat(bom, F.col("line"))).otherwise(as_cp1252(F.col("line")))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (lines.repartition(n, "origin").sortWithinPartitions("origin", "sec", "o")
     .select("origin", raw.alias("value")).write.option("lineSep", "\r\n").partitionBy("origin").text(folder))


ORIGIN = "origin=([^/]*)/"


def as_landing(spark, folder: str):
    """The written export as ``ingest.Landing``: a file is named by its folder."""
    from dqspark.sources.ingest import read_landing
    return read_landing(spark, folder, "*", ORIGIN)


def _html_escape(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")


def result_pages(customer: DataFrame, nation: DataFrame, rows_per_page: int = 100) -> DataFrame:
    """``(page_id, html)``: search-result pages rendered from the customer table.

    Each page holds at most ``rows_per_page`` customers of one nation, a
    3-column summary table before the 5-column result table, and a form
    ``<select>`` of nations (with a caption option and value ``0``).  The
    option list comes from the nation dimension (one row, 25 options).
    """
    cells = [F.col("c_custkey").cast("string"), F.col("c_name"), F.col("n_name"),
             F.format_string("%.2f", F.col("c_acctbal")), F.col("c_mktsegment")]
    row_html = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), _html_escape(c), F.lit("</td>")) for c in cells],
                        F.lit("</tr>"))
    page_id = (F.col("c_nationkey").cast("bigint") * 1_000_000_000 + F.floor(F.col("c_custkey") / rows_per_page))
    rows = (customer.join(nation.select("n_nationkey", "n_name"), customer.c_nationkey == nation.n_nationkey)
            .select(page_id.alias("page_id"), "c_custkey", row_html.alias("r")))
    opts = nation.agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("n_nationkey", F.concat(
            F.lit('<option value="'), F.col("n_nationkey").cast("string"), F.lit('">'), _html_escape(F.col("n_name")),
            F.lit("</option>")).alias("o")))), lambda s: s["o"]), "").alias("options"))
    body = rows.groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "r"))), lambda s: s["r"]), "")
        .alias("trs"))
    header = "".join(f"<th>{h}</th>" for h in ("CODIGO", "NOMBRE", "DEPARTAMENTO", "SALDO", "SEGMENTO"))
    html = F.concat(
        F.lit('<html><body><form><select name="dep"><option value="">SELECCIONE UN DEPARTAMENTO</option>'),
        opts.scalar(), F.lit("</select></form>"),
        F.lit("<table><tr><th>Resumen</th><th>Total</th><th>Pagina</th></tr><tr><td>registros</td><td>"),
        F.col("n").cast("string"), F.lit("</td><td>1</td></tr></table>"),
        F.lit(f"<table><thead><tr>{header}</tr></thead><tbody>"), F.col("trs"),
        F.lit("</tbody></table></body></html>"))
    # the option list is one value, attached as a scalar subquery
    return body.select("page_id", html.alias("html"))


def spanned_pages(customer: DataFrame, nation: DataFrame, rows_per_page: int = 100) -> DataFrame:
    """``(page_id, html)``: the same results as hand-written pages show them.

    No end tags of rows and cells, the nation once for all rows of its page
    (``rowspan``), the segment over two columns, the name in a nested table.
    """
    cells = [F.col("c_custkey").cast("string"),
             F.concat(F.lit("<table><tr><td>"), _html_escape(F.col("c_name")), F.lit("</table>")),
             F.format_string("%.2f", F.col("c_acctbal"))]
    row_html = F.concat(*[x for c in cells for x in (F.lit("<td>"), c)], F.lit("<td colspan=2>"), _html_escape(F.col("c_mktsegment")))
    page_id = (F.col("c_nationkey").cast("bigint") * 1_000_000_000 + F.floor(F.col("c_custkey") / rows_per_page))
    rows = (customer.join(nation.select("n_nationkey", "n_name"), customer.c_nationkey == nation.n_nationkey)
            .select(page_id.alias("page_id"), "n_name", "c_custkey", row_html.alias("r")))
    body = rows.groupBy("page_id", "n_name").agg(F.array_sort(F.collect_list(F.struct("c_custkey", "r"))).alias("rs"))
    return body.select("page_id", F.concat(
        F.lit("<table><tr><th>DEPARTAMENTO<th>CODIGO<th>NOMBRE<th>SALDO<th colspan=2>SEGMENTO<tbody><tr><td rowspan="),
        F.size("rs").cast("string"), F.lit(">"), _html_escape(F.col("n_name")),
        F.array_join(F.transform("rs", lambda s: s["r"]), "<tr>"), F.lit("</table>")).alias("html"))
