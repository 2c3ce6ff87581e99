"""Parent-child edges within shards, and the index of threads that cross shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadloom.functions.scalar import human_delta
from threadloom.functions.text import flatten
from threadloom.operators.shard import in_intervals, small, with_shard


def with_parent(items: DataFrame) -> DataFrame:
    return items.where("parent is not null and parent <> 0")


def edges(sharded: DataFrame) -> DataFrame:
    """sid, parent_id, ord, child_id: children of a parent by time (missing first) and id, numbered from 0 within the shard of the child."""
    order = Window.partitionBy("sid", "parent").orderBy(F.col("time").asc_nulls_first(), "id")
    return with_parent(sharded).select("sid", F.col("parent").alias("parent_id"), (F.row_number().over(order) - 1).alias("ord"), F.col("id").alias("child_id"))


def cross_links(edge_rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Distinct (parent_id, shard_sid) of children that lie outside their parent's shard."""
    outside = edge_rows.join(small(bounds.select("sid", "id_lo", "id_hi")), "sid").where((F.col("parent_id") < F.col("id_lo")) | (F.col("parent_id") > F.col("id_hi")))
    return outside.select("parent_id", F.col("sid").alias("shard_sid")).distinct()


def skipped(edge_rows: DataFrame, bounds: DataFrame, items: DataFrame) -> DataFrame:
    """Edges whose parent is in another shard than the child, with both shards, the seconds between them and the start of the child's text."""
    ranges = bounds.select(F.col("sid").alias("parent_sid"), "id_lo", "id_hi")
    crossing = in_intervals(edge_rows, "parent_id", ranges, "id_lo", "id_hi").where("parent_sid <> sid")
    parent = items.select(F.col("id").alias("parent_id"), F.col("time").alias("parent_time"))
    child = items.select(F.col("id").alias("child_id"), F.col("time").alias("child_time"), flatten(F.col("text")).alias("text"))
    both = crossing.join(parent, "parent_id").join(child, "child_id").withColumn("seconds", F.col("child_time") - F.col("parent_time"))
    return both.select("parent_id", "child_id", "parent_sid", F.col("sid").alias("child_sid"), "seconds", human_delta(F.col("seconds")).alias("delta"), "text")


def compressed_rows(cross: DataFrame) -> DataFrame:
    """parent_id, its sorted shards, and where they begin in the concatenation by parent. Offsets come from sums per range of parents, so no task sees all rows."""
    rows = cross.groupBy("parent_id").agg(F.sort_array(F.collect_set("shard_sid")).alias("sids")).withColumn("n", F.size("sids").cast("bigint")).withColumn("block", F.floor(F.col("parent_id") / 65536))
    blocks = rows.groupBy("block").agg(F.sum("n").alias("size"))
    before = blocks.withColumn("base", F.sum("size").over(Window.orderBy("block")) - F.col("size")).select("block", "base")
    inside = Window.partitionBy("block").orderBy("parent_id").rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(before, "block").select("parent_id", "sids", (F.col("base") + F.sum("n").over(inside) - F.col("n")).alias("offset"))


def thread(edge_rows: DataFrame, cross: DataFrame, bounds: DataFrame, parents: DataFrame) -> DataFrame:
    """Children of parents (parent_id) from their own shard and all shards the cross index names."""
    own = with_shard(parents, bounds, "parent_id").select("parent_id", "sid")
    where = own.union(parents.join(cross, "parent_id").select("parent_id", F.col("shard_sid").alias("sid"))).distinct()
    return edge_rows.join(where, ["sid", "parent_id"]).select("parent_id", "sid", "ord", "child_id")
