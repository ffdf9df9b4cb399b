"""Incremental ingest of a landing folder.

The source system reloads its landing folder on a daily schedule. The same
job as a Structured Streaming query: new files of a table are read with
the table's declared schema, conformed, and appended to the detail-store
table, each file exactly once. The checkpoint (on shared storage) records
which files were taken, so a restart after a lost executor or driver does
neither skip nor repeat a file. ``available_now`` runs it as a batch: take
what has landed, then stop.

Whole-row dedupe is not applied here (it is a batch-only rule for
dimensions; a stream would need unbounded state). Key dedupe (A2) belongs to
the batch conform.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.conform import accept, reject, stage
from ledgerline.sources.csv import every_field_checked, typed_options
from ledgerline.sources.register import FILE, take_new
from ledgerline.sources.specs import TableSpec


class StreamingIngest:
    """The running queries of one ingest: accepted rows, and rejected rows
    when a reject folder was given."""

    def __init__(self, queries: list[StreamingQuery]):
        self.queries = queries

    def awaitTermination(self) -> None:  # noqa: N802 (Spark's spelling)
        for q in self.queries:
            q.awaitTermination()

    def stop(self) -> None:
        for q in self.queries:
            q.stop()


def _stream(spark: SparkSession, spec: TableSpec, landing_dir: str,
            max_files_per_trigger: int | None):
    reader = spark.readStream.schema(spec.scan_schema).options(**typed_options(spec))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return stage(every_field_checked(reader.csv(landing_dir), spec), spec)


def _start(df, out_dir: str, checkpoint_dir: str, partition_by, available_now: bool):
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint_dir))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(out_dir)


def stream_ingest(spark: SparkSession, spec: TableSpec, landing_dir: str, table_dir: str,
                  checkpoint_dir: str, partition_by: tuple[str, ...] = (),
                  available_now: bool = True, max_files_per_trigger: int | None = None,
                  rejects_dir: str | None = None) -> StreamingIngest:
    """Accepted rows go to ``table_dir``; with ``rejects_dir`` the rejected
    rows (with their reason) go there, through a second query with its own
    checkpoint, so no landed row is lost. Each query takes each file
    exactly once."""
    accepted = accept(_stream(spark, spec, landing_dir, max_files_per_trigger), spec)
    queries = [_start(accepted, table_dir, f"{checkpoint_dir.rstrip('/')}/accepted",
                      partition_by, available_now)]
    if rejects_dir:
        rejected = reject(_stream(spark, spec, landing_dir, max_files_per_trigger))
        queries.append(_start(rejected, rejects_dir, f"{checkpoint_dir.rstrip('/')}/rejected",
                              (), available_now))
    return StreamingIngest(queries)


def stream_new(spark: SparkSession, spec: TableSpec, landing_dir: str, warehouse: str, checkpoint_dir: str,
               name: str, available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """As :func:`stream_ingest`, but files known to the delivery register, loaded before by a batch or by
    this stream under any name, are left out (see :mod:`ledgerline.sources.register`).

    Each micro-batch is a load named after the stream and its number, so a
    batch that broke off is repeated as a whole.
    """
    def take(batch: DataFrame, number: int) -> None:
        take_new(batch, spec, warehouse, f"{name}-{number}")

    reader = spark.readStream.schema(spec.scan_schema).options(**typed_options(spec))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = every_field_checked(reader.csv(landing_dir), spec).withColumn(FILE, F.col("_metadata.file_path"))
    writer = rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint_dir)
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return writer.trigger(**trigger).start()
