import pytest
from pyspark.sql import functions as F

from dqspark.streaming import incremental


def test_available_now_loads_each_file_once(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    a = spark.range(0, 50).withColumn("s", F.lit(" a  b "))
    a.write.parquet(f"{src}/b=1")
    incremental.incremental_load(spark, src, out, ckpt, a.schema)
    spark.range(50, 80).withColumn("s", F.lit("c")).write.parquet(f"{src}/b=2")
    incremental.incremental_load(spark, src, out, ckpt, a.schema)
    incremental.incremental_load(spark, src, out, ckpt, a.schema)   # nothing new
    res = spark.read.parquet(out)
    assert res.count() == 80 and res.select("id").distinct().count() == 80


def test_new_items_anti_join(spark):
    cand = spark.range(10).withColumnRenamed("id", "k")
    ledger = spark.range(5).withColumnRenamed("id", "k")
    assert sorted(r.k for r in incremental.new_items(cand, ledger, "k").collect()) == [5, 6, 7, 8, 9]


def test_export_round_trip(spark, tmp_path):
    from dqspark.sources.sinks import export_verified
    df = spark.createDataFrame([("a;b", None), ("line\nbreak", "x")], "p string, q string")
    assert export_verified(df, str(tmp_path / "out")) == (2, 2)
    assert export_verified(df, str(tmp_path / "outp"), fmt="parquet") == (2, 2)


def test_export_checks_content(spark, tmp_path):
    from dqspark.sources import sinks
    df = spark.createDataFrame([("a", None, 1, 0.1), ("a", None, 1, 0.1), (None, "", 2, None), ('q"', " é ", None, -2.5)],
                               "p string, q string, n int, x double")
    written = df.agg(F.count(F.lit(1)).alias("rows"), sinks.content_digest(df.schema).alias("digest")).first()
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / fmt)
        assert sinks.export_verified(df, path, fmt=fmt) == (4, 4)
        assert sinks.export_verified(df.limit(0), path + "-none", fmt=fmt) == (0, 4)
    # the same number of rows and columns, other values: a cell, a moved null, one row twice for another
    changed = (df.withColumn("n", F.when(F.col("n") == 2, 3).otherwise(F.col("n"))),
               df.select(F.col("q").alias("p"), F.col("p").alias("q"), "n", "x"),
               df.where("p = 'a'").union(df.where("p = 'a'")))
    for i, other in enumerate(changed):
        path = str(tmp_path / f"changed-{i}")
        other.write.option("header", True).option("escape", '"').csv(path)
        with pytest.raises(ValueError, match="content changed"):
            sinks.verify_export(spark, path, df.schema, written["rows"], written["digest"])
    with pytest.raises(ValueError, match="shape changed"):
        sinks.verify_export(spark, str(tmp_path / "csv"), df.schema, 3, written["digest"])


def test_cleaning_rules_run_on_a_stream(spark, tmp_path):
    from dqspark.operators import clean
    from dqspark.sources.tables import dirty_registry
    from tests.conftest import SF_SMALL
    d = dirty_registry(spark, SF_SMALL)
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    d.write.parquet(src)
    incremental.incremental_load(spark, src, out, ckpt, d.schema,
                                 transform=lambda s: clean.Cleaning(s).cleaned)
    streamed = spark.read.parquet(out)
    batch = clean.Cleaning(d).cleaned
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def _audit(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_audit_equals_the_batch_audit_after_a_killed_batch(spark, tmp_path, monkeypatch):
    from pyspark.errors import StreamingQueryException
    from dqspark.operators import clean
    from dqspark.sources.tables import dirty_registry
    from tests.conftest import SF_SMALL
    df = dirty_registry(spark, SF_SMALL)
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    parts = df.repartition(3, "code").withColumn("arrival", F.spark_partition_id())
    parts.write.parquet(str(tmp_path / "parts"))
    parts = spark.read.parquet(str(tmp_path / "parts"))
    writer = type(df.write)
    real = writer.parquet

    def killed(self, where, *args, **kw):
        real(self, where, *args, **kw)
        if "/rows/load_id=1" in where:
            raise RuntimeError("killed after the rows")
    for arrival in range(3):
        parts.where(F.col("arrival") == arrival).drop("arrival").write.mode("append").parquet(src)
        if arrival == 1:
            monkeypatch.setattr(writer, "parquet", killed)
            with pytest.raises((StreamingQueryException, RuntimeError)):
                incremental.clean_stream(spark, src, out, ckpt, df.schema)
            monkeypatch.setattr(writer, "parquet", real)
        incremental.clean_stream(spark, src, out, ckpt, df.schema)
    incremental.clean_stream(spark, src, out, ckpt, df.schema)         # nothing new
    batch = clean.Cleaning(parts.drop("arrival"))
    got = incremental.stream_cleaned(spark, out)
    assert got.columns == df.columns
    assert got.exceptAll(batch.cleaned).isEmpty() and batch.cleaned.exceptAll(got).isEmpty()
    assert _audit(incremental.stream_audit(spark, out, df.schema)) == _audit(batch.audit())
