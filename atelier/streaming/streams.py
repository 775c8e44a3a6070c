"""Windowed counts of events, and detection over a landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import detect
from ..sources import files, upsert


def _timed(events: DataFrame) -> DataFrame:
    """Event time as a point in time; one without a zone is taken in the session's."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Count and sum of each kind in tumbling windows; rows later than ``late`` are left out when streaming."""
    return _timed(events).withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of each user: events no further apart than ``gap``."""
    return _timed(events).withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("stop"), "user_id", "n")


def detect_stream(spark: SparkSession, folder: str, out: str, checkpoint: str):
    """Rooms of every vector document that lands in a folder, each batch written once under its number."""
    docs = spark.readStream.schema(files.VECTORS).option("multiLine", True).json(folder)

    def write(batch: DataFrame, number: int) -> None:
        detect.rooms(files.text_blocks(batch)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def distinct_events(events: DataFrame, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """The first row of each key; when streaming, repeats are known for as long as the watermark holds their key."""
    timed = _timed(events)
    return timed.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys) if events.isStreaming else timed.dropDuplicates(keys)


def rule_totals(events: DataFrame) -> DataFrame:
    """Of each rule (its kind): how often it was seen, the sum of its values and when it was last seen."""
    return events.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.max("ts").alias("last_seen"))


def totals_stream(events: DataFrame, path: str, checkpoint: str, late: str = "10 minutes", writer: str = "totals"):
    """Totals of distinct events, kept in a table that is changed by key (``sources.upsert``).

    Update mode gives the whole total of each rule that a batch touched, and a batch number is applied once, so that a
    batch played again, or a sink that ended between two steps, gives the same table as one pass over all rows.
    """

    def write(batch: DataFrame, number: int) -> None:
        upsert.upsert(batch, path, ["event_type"], buckets=8, batch=(writer, number))

    totals = rule_totals(distinct_events(events, ["event_id"], late))
    return totals.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
