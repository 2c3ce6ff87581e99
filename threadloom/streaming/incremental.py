"""Resumable phases and incremental builds with Structured Streaming."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.scratch import scratch_path


def process_new(spark: SparkSession, source: str, schema, transform, target: str, checkpoint: str) -> None:
    """Reads what has arrived at source since the last call, transforms it and appends it to target, exactly once: offsets and commits are in checkpoint."""
    stream = transform(spark.readStream.schema(schema).parquet(source))
    stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def counts_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events taken in by a stream that runs until it has caught up, then counted."""
    target, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-checkpoint")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    process_new(spark, f"{sf_dir}/events.parque[t]", schema, lambda df: df.select("event_type", "user_id"), target, checkpoint)
    return spark.read.parquet(target).groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


def windowed_counts(events: DataFrame, delay: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts per type and tumbling window of a stream or table with column ts; rows later than delay are ignored by a stream."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"))


class Phase:
    """A step whose output is kept with the hash of its configuration and rebuilt only if that changes or the output is missing."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _exists(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def run(self, name: str, config: dict, build) -> DataFrame:
        stamp = hashlib.sha256(json.dumps(config, sort_keys=True).encode()).hexdigest()[:16]
        path = f"{self.folder}/{name}-{stamp}"
        if not self._exists(f"{path}/_SUCCESS"):
            build().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)
