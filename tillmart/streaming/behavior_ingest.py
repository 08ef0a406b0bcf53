"""Raw behaviour files to staged logs as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillmart.operators import standardize
from tillmart.plans.staging import insert_logs
from tillmart.schemas import RAW_ROWS
from tillmart.sources.day_table import DayTable


def ingest_stream(
    spark: SparkSession,
    raw_path: str,
    table: DayTable,
    checkpoint: str,
    quarantine: str | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Load every raw file that has arrived, then stop.

    Each micro-batch goes through the same insert-if-new as the batch job. That makes a
    replayed batch harmless, and it needs no watermark: a log that arrives weeks late is
    still taken, where deduplication inside a watermark would drop it.
    """

    def load(batch: DataFrame, _: int) -> None:
        insert_logs(table.of(batch.sparkSession), batch, quarantine)

    raw = (
        spark.readStream.schema(RAW_ROWS)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(raw_path)
    )
    return (
        standardize.behavior_logs(raw)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
