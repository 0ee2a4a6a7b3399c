"""Responses as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dedupe(
    stream: DataFrame, delay: str, id: str = "id", time: str = "submitted_at", salts: int = 0
) -> DataFrame:
    """Drop resubmitted ids. Rows later than the watermark are dropped too, and an id is forgotten
    once the watermark has passed it, so the state does not grow with the history.

    With ``salts``, copies of one id are first dropped within that many random parts, so that an id that is sent
    very often reaches its last task at most ``salts`` times; it costs a second exchange and more state.
    """
    stream = stream.withWatermark(time, delay)
    if salts:
        stream = (
            stream.withColumn("_salt", F.floor(F.rand(0) * salts))
            .dropDuplicatesWithinWatermark([id, "_salt"]).drop("_salt")
        )
    return stream.dropDuplicatesWithinWatermark([id])


def tally(
    stream: DataFrame, by: str, window: str = "7 days", delay: str | None = None,
    time: str = "submitted_at",
) -> DataFrame:
    """(window_start, by, n) per tumbling window, given out once the window is closed.

    Give ``delay`` unless the stream already has a watermark.
    """
    if delay is not None:
        stream = stream.withWatermark(time, delay)
    return (
        stream.groupBy(F.window(time, window), F.col(by)).agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                by, "n")
    )


def run_available(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Run over what is there now, append to parquet files and read them back.

    The checkpoint makes a rerun go on where the last one stopped.
    """
    spark: SparkSession = stream.sparkSession
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
