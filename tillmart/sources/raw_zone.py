"""The raw zone: payloads as they came, append-only."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillmart.operators import quality
from tillmart.schemas import RAW_ROWS

RAW_PARTITIONS = ("batch_date", "source_api")


def raw_rows(
    payloads: DataFrame,
    source_api: Column,
    payload_json: Column,
    batch_date: Column,
    fetched_at: Column,
    raw_id: Column | None = None,
    ingest_seq: Column | None = None,
) -> DataFrame:
    """One raw row per payload row.

    ``payload_json`` is the text as received; for structured input use ``payload_text``.
    ``ingest_seq`` keeps the order of arrival inside a fetch. Random ids are drawn once per
    call, so every fetch needs a call of its own.
    """
    return payloads.select(
        (F.uuid() if raw_id is None else raw_id).alias("raw_id"),
        source_api.alias("source_api"),
        batch_date.alias("batch_date"),
        payload_json.alias("payload_json"),
        fetched_at.cast("timestamp_ntz").alias("fetched_at"),
        (F.monotonically_increasing_id() if ingest_seq is None else ingest_seq).alias("ingest_seq"),
    )


def payload_text(payloads: DataFrame) -> Column:
    """All columns as one JSON text. Null fields are left out, as if the source did not send them."""
    return F.to_json(F.struct(*payloads.columns))


def by_partition(rows: DataFrame) -> DataFrame:
    """``rows`` so that a partition of the raw zone lies in few tasks; a large one is split."""
    return rows.hint("rebalance", *RAW_PARTITIONS)


def land(
    rows: DataFrame, table: str, json_folder: str | None = None, together: bool = False
) -> None:
    """Append raw rows to ``table`` and, if asked, their payloads as gzipped JSON lines.

    Both appends hold the same payloads, so a rerun of a day leaves them in step. ``together`` says
    that ``rows`` were written ``by_partition`` and need not move again.
    """
    texts = rows.select("payload_json", *RAW_PARTITIONS)
    if not together:
        rows, texts = by_partition(rows), by_partition(texts)
    rows.write.mode("append").partitionBy(*RAW_PARTITIONS).parquet(table)
    if json_folder is not None:
        gzipped = texts.write.mode("append").partitionBy(*RAW_PARTITIONS).option("zlib.compress.level", "BEST_SPEED")
        gzipped.text(json_folder, compression="gzip")


def observed(rows: DataFrame, rules: quality.Rules) -> tuple[DataFrame, Observation]:
    """``rows`` flagged by the raw rules, counted by whatever writes them.

    ``n``, ``bad``, and ``cancelled`` and ``refunded`` among the payloads of order feeds. A payload is
    parsed for a status only if it holds that word, or an escape that could stand for it.
    """
    payload = F.col("payload_json")
    status = F.coalesce(F.get_json_object(payload, "$.orderStatus"), F.get_json_object(payload, "$.OrderStatus"))

    def says(word: str) -> Column:
        return F.when(payload.contains(word) | payload.contains("\\"), status == word)

    seen = Observation()
    flagged = quality.with_violations(rows, rules).observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.size("violations") > 0).alias("bad"),
        F.count_if(says("CANCELLED")).alias("cancelled"),
        F.count_if(says("REFUNDED")).alias("refunded"),
    )
    return flagged, seen


def content_key(rows: DataFrame) -> Column:
    """Hash of all that a raw row holds, apart from when it was fetched."""
    fields = ("raw_id", "source_api", "batch_date", "payload_json")
    return F.sha2(F.to_json(F.struct(*fields)), 256)


def scan(spark: SparkSession, table: str, batch_dates: Iterable[date] | None = None) -> DataFrame:
    """Raw rows of some batch dates; only their folders are read."""
    rows = spark.read.schema(RAW_ROWS).parquet(table)
    return of_batches(rows, batch_dates)


def of_batches(rows: DataFrame, batch_dates: Iterable[date] | None) -> DataFrame:
    if batch_dates is None:
        return rows
    return rows.where(F.col("batch_date").isin(*[F.lit(d) for d in batch_dates]))
