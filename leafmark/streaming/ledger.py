"""Incremental ingestion of documents from a landing folder (an extension: the source system works document by document)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

LANDED = "doc_id long, text string, landed_at timestamp"


def landed(spark: SparkSession, path: str) -> DataFrame:
    """Documents as they land (Parquet), each text once a day: state is bounded by the watermark."""
    stream = spark.readStream.schema(LANDED).parquet(path).withColumn("sha256", F.sha2("text", 256))
    return stream.withWatermark("landed_at", "1 day").dropDuplicatesWithinWatermark(["sha256"])


def event_counts(stream: DataFrame, time: str, kind: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Tumbling counts by kind."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), kind).agg(F.count("*").alias("n"))


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes what has landed so far and stops; the next call goes on from there."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_state(events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last event of each key of an append-only log."""
    last = F.max_by(F.struct(*events.columns), F.struct(*order)).alias("s")
    return events.groupBy(key).agg(last).select("s.*")
