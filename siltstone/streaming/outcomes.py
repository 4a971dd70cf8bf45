"""Outcome events to the latest outcome per work, by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.tracker import latest


def windowed_counts(events: DataFrame, ts: str = "ts", delay: str = "10 minutes", width: str = "1 hour", by: str = "status") -> DataFrame:
    """Counts per window and value; late rows within the delay are counted, state older than it goes."""
    return events.withWatermark(ts, delay).groupBy(F.window(ts, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), by, "n")


def upsert_latest(events: DataFrame, target: str, checkpoint: str, key: str = "id", order: tuple[str, ...] = ("ts", "event_id")):
    """A query that keeps, in the folder ``target``, versions of the latest row per key.

    Each micro-batch is merged with the newest version and written as the next one, named after the
    batch, so a batch that is run again writes the same version; readers take the highest complete one.
    """
    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if number > 0:
            rows = spark.read.schema(batch.schema).parquet(f"{target}/version={number - 1}").unionByName(batch)
        latest(rows, [key], list(order)).select(*batch.columns).write.mode("overwrite").parquet(f"{target}/version={number}")

    return events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
