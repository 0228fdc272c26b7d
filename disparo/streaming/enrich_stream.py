"""Incremental enrichment of raw files as they land (C1 as a Structured Streaming job).

New CSV files under ``raw_dir`` are read with the declared all-text schema, pass through
the row-local enrichment and the stream-static reference join, and are appended to the
year-partitioned Parquet table.  The stream's progress lives in ``checkpoint_location``
(a shared folder), so a restarted or failed job resumes where it stopped, and files
already processed are not read again.

The department frequency is a count over *all* rows, so it is not frozen into appended
rows (older rows would go stale); ``read_enriched`` attaches it when the table is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from disparo.config import EventConfig
from disparo.plans.jobs import add_frequency, add_reference, enrich_rows
from disparo.sources.tables import all_string_schema, read_table


def start_enrich_stream(spark: SparkSession, raw_dir: str, columns: Sequence[str], out_path: str,
                        checkpoint_location: str, ref: DataFrame | None = None,
                        cfg: EventConfig = EventConfig(), available_now: bool = True,
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what has landed and stops."""
    reader = spark.readStream.schema(all_string_schema(columns)).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = add_reference(enrich_rows(reader.csv(raw_dir), cfg), ref, cfg)
    writer = (rows.writeStream.format("parquet").outputMode("append")
                  .option("path", out_path).option("checkpointLocation", checkpoint_location)
                  .partitionBy("year"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_enriched(spark: SparkSession, out_path: str, cfg: EventConfig = EventConfig()) -> DataFrame:
    """The streamed table with the department frequency over all rows landed so far."""
    return add_frequency(read_table(spark, out_path), cfg)
