"""Global order without a task that sees all rows: row numbers, and rotation of numbered rows into shards."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadloom.scratch import materialize, prepare

_PLACED = pa.schema([("block", pa.int64()), ("sid", pa.int32())])


def numbered(df: DataFrame, keys: tuple[Column, ...], label: str = "numbered") -> DataFrame:
    """df with rank, from 1, by keys (a total order): row numbers within sampled ranges plus the sizes of the ranges before."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(df.repartitionByRange(parts, *keys).withColumn("_range", F.spark_partition_id()), label)
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("n")).withColumn("_before", F.sum("n").over(Window.orderBy("_range")) - F.col("n")).select("_range", "_before")  # one row a range
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(*keys)) + F.col("_before")
    return dealt.join(F.broadcast(sizes), "_range").withColumn("rank", rank).drop("_range", "_before")


def rotate(ranked: DataFrame, size: Column, every: int, target: int, least_rows: int = 0, most_rows: int | None = None) -> DataFrame:
    """ranked (with rank) with sid: a shard ends where, looked at after every so many ranks, it holds most_rows, or target bytes and at
    least_rows. Only one row for so many ranks passes through the one ordered stream that the rule needs."""
    prepare(ranked.sparkSession)
    block = F.floor((F.col("rank") - 1) / every).cast("bigint")
    blocks = ranked.groupBy(block.alias("block")).agg(F.count("*").alias("n"), F.sum(size).cast("bigint").alias("bytes"))

    def run(batches):
        sid, rows, held = 0, 0, 0
        for batch in batches:
            sids = []
            for n, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                sids.append(sid)
                rows, held = rows + n, held + (b or 0)
                if (most_rows and rows >= most_rows) or (held >= target and rows >= least_rows):
                    sid, rows, held = sid + 1, 0, 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sids, pa.int32())], schema=_PLACED)

    placed = blocks.repartition(1).sortWithinPartitions("block").mapInArrow(run, "block long, sid int")
    return ranked.withColumn("block", block).join(placed, "block").drop("block")
