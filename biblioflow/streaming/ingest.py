"""Incremental ingestion of a landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def landed(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """Files of a folder as a stream, each seen once: (id_jems, text, landed_at)."""
    files = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", pattern).load(folder)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return files.select(
        F.regexp_replace(name, r"\.[^.]*$", "").alias("id_jems"), F.col("value").alias("text"), F.col("_metadata.file_modification_time").alias("landed_at")
    )


def ingest_new(stream: DataFrame, target: str, state: str) -> StreamingQuery:
    """Append what is new to a parquet table and stop; the state folder remembers what was seen."""
    writer = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", state)
    return writer.trigger(availableNow=True).start()
