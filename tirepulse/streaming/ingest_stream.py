"""Incremental ingestion of daily report files with Structured Streaming.

The typed loader of ``sources.ingest`` (its reader options, types and test for malformed
rows) applied to files as they land in a folder, appended to the month-partitioned
Parquet table the reports read. Malformed rows are skipped by default, and a second
stream (``reject_stream``) writes them with the names of their malformed columns;
each has its own checkpoint, so both see every file once.
The streaming checkpoint records which files were processed, so a restarted
or failed run neither skips nor duplicates a file. ``availableNow`` processes
what is there and stops, which suits a daily schedule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tirepulse.operators.common import MONTH_PARTITION
from tirepulse.sources.ingest import CSV_OPTIONS, accepted, description_columns, raw_schema, rejected


def _raw(spark: SparkSession, desc_path: str, input_dir: str) -> DataFrame:
    return spark.readStream.schema(raw_schema(description_columns(spark, desc_path))).options(**CSV_OPTIONS).csv(input_dir)


def _started(rows: DataFrame, path: str, checkpoint: str, available_now: bool, *partitions: str) -> StreamingQuery:
    writer = (rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
              .partitionBy(*partitions).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def ingest_stream(spark: SparkSession, desc_path: str, input_dir: str, output_path: str, checkpoint: str,
                  schema: T.StructType, available_now: bool = True, on_malformed: str = "skip") -> StreamingQuery:
    """Start the stream; returns the running query (``awaitTermination`` to wait). ``on_malformed`` as in the loader."""
    reports = accepted(_raw(spark, desc_path, input_dir), schema, on_malformed)
    return _started(reports.withColumn(MONTH_PARTITION, F.date_format("report_start_at", "yyyy-MM")), output_path,
                    checkpoint, available_now, MONTH_PARTITION)


def reject_stream(spark: SparkSession, desc_path: str, input_dir: str, rejects_path: str, checkpoint: str,
                  schema: T.StructType, available_now: bool = True) -> StreamingQuery:
    """Start the stream of the rows that ``ingest_stream`` skips: their text columns, line and ``bad_columns``."""
    return _started(rejected(_raw(spark, desc_path, input_dir), schema), rejects_path, checkpoint, available_now)
