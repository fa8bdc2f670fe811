"""Incremental bronze ingest (SRC1 + SRC2 as a stream).

The monitored pipeline re-reads every raw sheet on each run. Here new files landing in a folder
are picked up incrementally by the file stream source, tagged with lineage (file name from the
file metadata, load time) and appended to the bronze table. The checkpoint (by default inside the
target's folder, hidden from readers) records which files were committed, so a restarted or retried run never loads
a file twice and never skips one (exactly-once file sink).

``ingest_available`` runs with ``availableNow``: it processes everything that has landed, in
bounded micro-batches, and stops, so it can be scheduled like a batch job.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from kpiloom.session import path_exists


def _stream(spark: SparkSession, landing: str, schema: StructType | str, fmt: str, max_files: int):
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        reader = reader.option("header", "true")
    df = reader.load(landing)
    return df.withColumns({"source_file_name": F.col("_metadata.file_name"),
                           "ingestion_timestamp": F.current_timestamp()})


def default_checkpoint(target: str) -> str:
    """The checkpoint belongs to the target: every run on a target goes on where the last one stopped."""
    return f"{target.rstrip('/')}/_ingest_checkpoint"


def _rows(spark: SparkSession, target: str) -> int:
    """Committed rows of the target (from Parquet footers)."""
    return spark.read.parquet(target).count() if path_exists(spark, f"{target.rstrip('/')}/_spark_metadata") else 0


def start_ingest(spark: SparkSession, landing: str, schema: StructType | str, target: str, fmt: str = "csv",
                 checkpoint: str | None = None, max_files: int = 1000, available_now: bool = True,
                 processing_time: str | None = None) -> StreamingQuery:
    """Start the landing -> bronze stream (parquet sink, append, exactly once)."""
    writer = (_stream(spark, landing, schema, fmt, max_files).writeStream.format("parquet")
              .option("path", target).option("checkpointLocation", checkpoint or default_checkpoint(target))
              .outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def ingest_available(spark: SparkSession, landing: str, schema: StructType | str, target: str, fmt: str = "csv",
                     checkpoint: str | None = None, max_files: int = 1000) -> int:
    """Ingest everything landed so far and stop; returns the number of rows appended."""
    before = _rows(spark, target)
    q = start_ingest(spark, landing, schema, target, fmt, checkpoint, max_files, available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return _rows(spark, target) - before
