"""Streaming adapters: articles that land in a folder, and counts of events over windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.urls import address_key
from newsloom.sources.files import ARTICLE
from newsloom.sources.store import Store


def ingest(spark: SparkSession, landing: str, table: str, checkpoint: str):
    """A query that merges landing JSON lines into a stored table (``sources.store``) by canonical address, each
    micro-batch once: its label is in the log, so a batch that is run again changes nothing.

    Rows of a batch are numbered behind all stored ones, so the first of equals stays the first. A batch writes its own
    new and better rows, and reads only the buckets that may hold its addresses.
    """
    incoming = spark.readStream.schema(ARTICLE).json(landing)
    store = Store(spark, table, "_key")

    def merge(batch: DataFrame, epoch: int) -> None:
        store.put(batch.withColumn("_seq", F.monotonically_increasing_id()).withColumn("_key", address_key(F.col("url"))), label=f"batch{epoch}")

    return incoming.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums per window and type, with late rows up to the watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select("window.start", "event_type", "n", "total")
