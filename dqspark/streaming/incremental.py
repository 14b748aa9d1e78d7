"""Incremental loading: process only items not materialised before.

Four forms of the same idea:

* ``new_items``: a batch left-anti join of candidates against a ledger of
  already-loaded keys;
* ``incremental_load``: a Structured Streaming file source with
  ``Trigger.AvailableNow``; the checkpoint records which files were
  processed, so each run picks up only new files, exactly once.  Row-local
  cleaning rules (pure column expressions) can be applied in the stream;
* ``ingest_stream``: raw export files as they land, through the streaming side
  of the ``raw_export`` source; each micro-batch is a whole ingest of its files,
  whose rows and ledger replace what an earlier attempt of that batch wrote;
* ``clean_stream``: the cleaning rules over rows as they land; the audit's events
  are counted per micro-batch and summed by ``stream_audit``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqspark.operators import clean
from dqspark.sources import ingest, raw_export


def new_items(candidates: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Rows of ``candidates`` whose key is not in ``ledger``."""
    return candidates.join(ledger.select(key), key, "left_anti")


def incremental_load(spark: SparkSession, source_dir: str, target_dir: str, checkpoint_dir: str,
                     schema, fmt: str = "parquet",
                     transform: Callable[[DataFrame], DataFrame] | None = None,
                     max_files_per_trigger: int | None = None) -> None:
    """Run one AvailableNow pass: new files of ``source_dir`` -> ``target_dir``."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)
    if transform is not None:
        stream = transform(stream)
    q = (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir)
         .outputMode("append").trigger(availableNow=True).start(target_dir))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def ingest_stream(spark: SparkSession, folder: str, target: str, checkpoint_dir: str, glob: str = "*.csv",
                  pattern: str = raw_export.ORIGIN, split: int | None = None, **options) -> None:
    """Ingest the raw files of ``folder`` that no earlier run has seen.

    Rows and ledger go to ``target/rows/batch=n`` and ``target/ledger/batch=n``,
    written over if the batch is run again, so a batch that was killed leaves
    nothing twice; ``ingested`` reads them.  Empty files have no lines and no
    ledger row here.  ``options`` are those of ``ingest.ingest``.
    """
    lines = raw_export.load_stream(spark, folder, f"{checkpoint_dir}/files", glob, pattern, split)

    def load(batch: DataFrame, number: int) -> None:
        done = ingest.ingest(ingest.Landing(batch.select("origin").distinct(), batch), **options)
        rows = done.rows.join(done.columns, "origin").select("origin", "columns", "data")
        rows.write.mode("overwrite").parquet(f"{target}/rows/batch={number}")
        done.ledger.write.mode("overwrite").parquet(f"{target}/ledger/batch={number}")

    q = (lines.writeStream.foreachBatch(load).option("checkpointLocation", f"{checkpoint_dir}/stream")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def ingested(spark: SparkSession, target: str) -> ingest.Ingested:
    """What the runs of ``ingest_stream`` have loaded so far."""
    rows, ledger = (spark.read.parquet(f"{target}/{x}").drop("batch") for x in ("rows", "ledger"))
    return ingest.Ingested(rows=rows.select("origin", "data"), ledger=ledger,
                           columns=rows.groupBy("origin").agg(F.first("columns").alias("columns")))


_EVENTS = "_audit_events"


def clean_stream(spark: SparkSession, source_dir: str, target: str, checkpoint_dir: str, schema,
                 config: clean.CleanConfig = clean.DIRTY_CONFIG, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> None:
    """Clean the files of ``source_dir`` that no earlier run has seen.

    A micro-batch is read once: its cleaned rows are written with their audit
    events, and the events are counted from what was written.  Both replace
    those of an earlier attempt of the batch, so a killed batch counts once.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def load(batch: DataFrame, number: int) -> None:
        cleaning = clean.Cleaning(batch, config)
        rows = f"{target}/rows/load_id={number}"
        (cleaning.staged.select(*batch.columns, cleaning.event_list().alias(_EVENTS))
         .write.mode("overwrite").parquet(rows))
        events = batch.sparkSession.read.parquet(rows).select(F.explode(_EVENTS).alias("e")).select("e.*")
        clean.counted_events(events).write.mode("overwrite").parquet(f"{target}/events/load_id={number}")

    q = (reader.load(source_dir).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def stream_cleaned(spark: SparkSession, target: str) -> DataFrame:
    """The rows that the runs of ``clean_stream`` have cleaned so far."""
    return spark.read.parquet(f"{target}/rows").drop(_EVENTS, "load_id")


def stream_audit(spark: SparkSession, target: str, schema, config: clean.CleanConfig = clean.DIRTY_CONFIG) -> DataFrame:
    """The audit log of all loads; reads their counts of events only."""
    events = clean.counted_events(spark.read.parquet(f"{target}/events").drop("load_id"))
    return clean.Cleaning(spark.createDataFrame([], schema), config).audit(events=events)
