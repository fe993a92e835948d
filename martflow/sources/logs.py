"""App logs: a folder of day-rolled files, one JSON record per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_log_lines(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.text(folder)


def stream_log_lines(
    spark: SparkSession, folder: str, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)
