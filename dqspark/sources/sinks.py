"""Export with round-trip verification: shape and content of what is read back must be those written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def content_digest(schema: T.StructType, fmt: str = "csv") -> Column:
    """Aggregate over rows that doesn't depend on their order: the sum of 64-bit row hashes, repeats counted.

    Hashes skip nulls, so the places of nulls are hashed too; maps are hashed as sorted entries.
    CSV can't tell an empty text from null, there both are null.
    """
    cols = [F.col(f"`{f.name}`") for f in schema.fields]
    if fmt == "csv":
        cols = [F.nullif(c, F.lit("")) if isinstance(f.dataType, T.StringType) else c for c, f in zip(cols, schema.fields)]
    values = [F.array_sort(F.map_entries(c)) if isinstance(f.dataType, T.MapType) else c for c, f in zip(cols, schema.fields)]
    row = F.xxhash64(*values, *[c.isNull() for c in cols])
    return F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))


def _reader(spark: SparkSession, fmt: str):
    reader = spark.read.format(fmt)
    return reader.option("header", True).option("multiLine", True).option("escape", '"') if fmt == "csv" else reader


def verify_export(spark: SparkSession, path: str, schema: T.StructType, rows: int, digest, fmt: str = "csv") -> None:
    """Raise ``ValueError`` unless ``path`` holds ``rows`` rows of ``schema`` with this digest.

    CSV values are read as the types written, so what its text can't carry
    (microseconds of timestamps, say) counts as changed.
    """
    names = _reader(spark, fmt).load(path).columns
    if len(names) != len(schema):
        raise ValueError(f"shape changed on export: expected {(rows, len(schema))}; got {len(names)} columns")
    # empty CSV values may be null, whatever the schema says
    free = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    back = _reader(spark, fmt).schema(free).load(path)
    got = back.agg(F.count(F.lit(1)).alias("rows"), content_digest(free, fmt).alias("digest")).first()
    if got["rows"] != rows:
        raise ValueError(f"shape changed on export: expected {(rows, len(schema))}; got {(got['rows'], len(names))}")
    if got["digest"] != digest:
        raise ValueError(f"content changed on export: {rows} rows as written, but other values")


def export_verified(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> tuple[int, int]:
    """Write ``df`` (CSV with header, or Parquet) and check what is read back.

    Row count and content digest come from an ``Observation`` on the write
    itself (no extra scan); the re-read is one scan.  Raises ``ValueError``
    when rows, columns or values differ.  Returns ``(rows, columns)``.
    """
    obs = Observation("export")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), content_digest(df.schema, fmt).alias("digest"))
    writer = observed.write.mode(mode)
    if fmt == "csv":
        # values keep their edge whitespace; quotes are doubled, as readers expect
        (writer.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))
    else:
        writer.parquet(path)
    written = obs.get
    verify_export(df.sparkSession, path, df.schema, written["rows"], written["digest"], fmt)
    return written["rows"], len(df.columns)
