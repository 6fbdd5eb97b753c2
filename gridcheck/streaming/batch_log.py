"""The batch log as a stream: JSON lines appended by workers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridcheck.sources.documents import LOG


def read_log(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(LOG).option("maxFilesPerTrigger", files_per_trigger).json(path)


def status_windows(log: DataFrame, width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Items, checks and failures by status and time window; rows later than the watermark are left out."""
    return (
        log.withWatermark("timestamp", late)
        .groupBy(F.window("timestamp", width).alias("window"), "status")
        .agg(F.count(F.lit(1)).alias("items"), F.sum("checks").alias("checks"), F.sum("failures").alias("failures"), F.sum("elapsed_seconds").alias("seconds"))
    )


def start(rows: DataFrame, name: str, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Into an in-memory table of that name; checkpoint is a folder that all executors share."""
    return rows.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).start()
