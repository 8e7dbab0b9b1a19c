"""Streams: windows over late events, duplicates, and enrichment that resumes. An extension of the batch operators."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.operators.manifest import worklist
from loam.session import exists


def windowed(events: DataFrame, length: str = "1 hour", slide: str | None = None, late: str | None = "2 hours") -> DataFrame:
    """Counts and sums by event type and tumbling, or sliding, window; events later than the watermark are left out."""
    at = F.window("ts", length, slide) if slide else F.window("ts", length)
    out = (events.withWatermark("ts", late) if late else events).groupBy(at.alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return out.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str | None = "2 hours") -> DataFrame:
    out = (events.withWatermark("ts", late) if late else events).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("w.start").alias("start"), "n")


def without_duplicates(events: DataFrame, key: str = "event_id", late: str = "2 hours") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def folder_stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).parquet(folder)


def resumable(stream: DataFrame, compute: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, key: str = "path"):
    """Computes each new item of a stream once: a batch that is run again leaves out what has been stored."""

    def batch(df: DataFrame, _: int) -> None:
        rows = df.dropDuplicates([key])
        if exists(df.sparkSession, out):
            rows = worklist(rows, df.sparkSession.read.parquet(out), key)
        compute(rows).write.mode("append").parquet(out)

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(batch).start()
