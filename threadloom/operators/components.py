"""Connected components by alternating large-star and small-star (Kiveris et al. 2014).

Every round is two aggregations and two joins, all distributed; its edges are written to the shared
folder, so a lost executor costs one round at most. A hub is one row a task after partial
aggregation, and its edges are split by the engine's skew handling of joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.scratch import materialize, release

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (u, v): any links of long ids, also repeated or reversed. Returns (node, component) of each
    node that has a link to another one; component is the smallest node reached."""
    current = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(current)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        lowest = current.groupBy("v").agg(F.lit(None).cast("long").alias("m")).union(current.groupBy("u").agg(F.min("v"))).groupBy("v").agg(F.min("m").alias("m"))
        # large star: what is above v is linked to the smallest of v and v's neighbours
        large = current.join(lowest, "v").select("u", F.coalesce(F.least("m", "v"), "v").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # small star: what is below u is linked to the smallest below u
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        following = materialize(small, "links")
        release(current)
        after, current = _state(following), following
        if after == state:
            break
        state = after
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(current.select("v", "v").distinct())
