"""What the operators share: tables, shared scratch tables, checked broadcasts, word hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.scratch import drop_path, materialize, prepare, release, scratch_path

__all__ = ["BROADCAST_BYTES", "SPACE", "broadcast_if_small", "drop_path", "materialize", "parallelism", "prepare", "release", "scratch_path", "table"]

#: Largest side that is ever broadcast, in bytes, by a bound worked out from a count.
BROADCAST_BYTES = 8 << 20

#: Java regular expression of the white space that separates words.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def broadcast_if_small(df: DataFrame, row_bytes: int) -> DataFrame:
    """df, marked for broadcast if its counted rows stay below the bound; else Spark shuffles both sides."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
