"""Streams of rows: an extension, since all of the engine's own steps read whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def counts_by_window(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """start, event_type, n, total: tumbling windows; rows later than ``late`` are left out, as the watermark says."""
    grouped = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type")
    return grouped.agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def upserts(points: DataFrame, keys: list[str], path: str, checkpoint: str):
    """Keeps a table of the last version of each key: each batch is merged into a new table version under ``path``."""
    from textloom.sources.sinks import upsert

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = spark.read.parquet(f"{path}/v{number - 1}") if number else None
        upsert(old, batch.dropDuplicates(keys), keys, f"{path}/v{number}")

    return points.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
