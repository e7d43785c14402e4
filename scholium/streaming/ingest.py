"""Structured Streaming ingest: landed records as a stream, each key once, counted by windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import fingerprint


def landed(spark: SparkSession, path: str, schema: str, kind: str = "json", files: int = 100) -> DataFrame:
    """Files as they land, some at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(kind).load(path)


def first_seen(rows: DataFrame, at: str = "harvested_at", title: str = "title", late: str = "30 days") -> DataFrame:
    """Records whose fingerprint was not seen within the watermark; state is as large as what the watermark holds."""
    keyed = rows.withColumn("fp", fingerprint(F.col(title))).withColumn("_at", F.to_timestamp(F.col(at)))
    return keyed.withWatermark("_at", late).dropDuplicatesWithinWatermark(["fp"])


def counts(rows: DataFrame, at: str, by: str, window: str = "7 days", late: str = "1 day") -> DataFrame:
    """(start, value, n) in windows of time."""
    timed = rows.withColumn("_at", F.to_timestamp(F.col(at))).withWatermark("_at", late)
    return timed.groupBy(F.window("_at", window).alias("w"), F.col(by).alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "value", "n")


def write_available(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append all that is there now, exactly once, and stop: what a scheduled run does."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
