"""Change capture as a stream (S8 / ST1) and the stream sources over table files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def file_stream(spark: SparkSession, directory: str, name_glob: str,
                max_files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    """A streaming scan of the files of one table in ``directory`` (schema taken from the
    files once, as streaming sources require a fixed schema)."""
    schema = spark.read.format(fmt).load(f"{directory.rstrip('/')}/{name_glob}").schema
    reader = (spark.readStream.format(fmt).schema(schema)
              .option("pathGlobFilter", name_glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(directory)


def capture_changes(changes: DataFrame, history_path: str, checkpoint: str,
                    available_now: bool = True, processing_time: str = "15 seconds"):
    """S8 / ST1: append every change row (with its metadata) to the history table.

    The file sink with a checkpoint is exactly-once: a restarted query never appends a
    micro-batch twice.  Default cadence mirrors the ~15 s flushes of a managed change feed.
    """
    w = (changes.writeStream.format("parquet").outputMode("append")
         .option("path", history_path).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(
        processingTime=processing_time)
    return w.start()
