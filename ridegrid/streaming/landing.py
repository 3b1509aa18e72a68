"""Process months as they land: a file stream over the raw lake.

The original system ran the monthly job when a month's file had been landed.
Here the raw lake is a streaming file source; each micro-batch names the
(year, month) partitions that received files, and those months are rebuilt in
full from the lake with the batch job (dynamic partition overwrite makes the
rebuild idempotent, so a month split over several batches, or a batch replayed
after a failure, converges to the same tables).  Only the distinct month keys
of a batch reach the driver (a handful of rows).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.monthly_job import run_backfill


def start_landing_stream(spark: SparkSession, raw_base: str, clean_base: str,
                         demand_base: str, checkpoint: str, available_now: bool = True,
                         max_files_per_trigger: int | None = None,
                         rel_err: float = 0.01) -> StreamingQuery:
    schema = spark.read.parquet(raw_base).schema  # includes year/month partition columns
    reader = spark.readStream.schema(schema).option("basePath", raw_base)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(raw_base).select("year", "month")

    def rebuild(batch: DataFrame, batch_id: int) -> None:
        months = [(r["year"], r["month"]) for r in batch.distinct().collect()
                  if r["year"] is not None and r["month"] is not None]
        if months:
            run_backfill(batch.sparkSession, raw_base, clean_base, demand_base,
                         months=sorted(months), rel_err=rel_err)

    writer = (stream.writeStream.foreachBatch(rebuild)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="1 hour")
    return writer.start()
