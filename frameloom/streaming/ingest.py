"""Samples as a stream: repeated tokens dropped within a watermark, counts by scene and window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_samples(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def first_arrivals(stream: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each token once while the watermark remembers it; null tokens are left out. The state ends with the watermark."""
    return stream.where("sample_token is not null").withWatermark("ingested_at", late).dropDuplicatesWithinWatermark(["sample_token"])


def scene_counts(stream: DataFrame, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Samples a scene and window of ingestion."""
    return stream.withWatermark("ingested_at", late).groupBy(F.window("ingested_at", window), "scene_name").agg(F.count("*").alias("n"))


def append_to(stream: DataFrame, path: str, checkpoint: str):
    """Appends to a parquet table exactly once; runs what is there and ends."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
