"""A text-file stream: one row per line of each file that arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                     with_path: bool = False) -> DataFrame:
    """Streaming ``value`` (and ``file_path``) per line of files arriving
    under ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load(path)
    if with_path:
        return df.select("value", F.col("_metadata.file_path").alias("file_path"))
    return df
