"""Nearest ancestors in reply trees, by pointer doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.scratch import materialize, release

# Fixed value: how many hops a story may be away.
MAX_DEPTH = 40


def nearest_marked(items: DataFrame, marked: DataFrame, max_depth: int | None = MAX_DEPTH) -> DataFrame:
    """(id, story_id) of each item: itself if it is in marked (id), else its nearest marked ancestor within max_depth hops (None: any number); null if there is none.

    Each round doubles how far every pointer reaches, so depth d takes log2(d) joins; a marked item points to itself with no hops, a missing
    parent ends the chain, and so does a cycle of parents without a marked item: its items, and all below it, have none. Every round's pointers are written, so lineage never grows."""
    marks = marked.select("id").distinct().withColumn("mark", F.lit(True))
    start = items.select("id", "parent").join(marks, "id", "left")
    known = F.coalesce("mark", F.lit(False))
    pointers = materialize(start.select("id", F.when(known, F.col("id")).otherwise(F.col("parent")).alias("to"), F.when(known, 0).otherwise(1).cast("bigint").alias("hops"), known.alias("done")), "pointers")
    limit = max_depth if max_depth is not None else pointers.count()  # no chain is longer; on a cycle without a mark pointers run for ever
    reach = 1
    while True:
        open_rows = pointers.where("not done and `to` is not null")
        if reach > limit or open_rows.isEmpty():
            break
        ahead = pointers.select(F.col("id").alias("to"), F.col("to").alias("next"), F.col("hops").alias("more"), F.col("done").alias("there"))
        moved = open_rows.join(ahead, "to", "left").select("id", F.col("next").alias("to"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"), F.coalesce("there", F.lit(False)).alias("done"))
        following = materialize(pointers.where("done or `to` is null").select("id", "to", "hops", "done").union(moved), "pointers")
        release(pointers)
        pointers, reach = following, reach * 2
    return pointers.select("id", F.when(F.col("done") & (F.col("hops") <= limit), F.col("to")).alias("story_id"))


def story_of_item(items: DataFrame, max_depth: int | None = MAX_DEPTH) -> DataFrame:
    """(id, story_id): the item itself if it is a story, else its nearest story above."""
    return nearest_marked(items, items.where("type = 'story'"), max_depth)


def comment_totals(items: DataFrame, stories: DataFrame) -> DataFrame:
    """(id, comment_total) of each of stories (id): comments whose nearest ancestor among them it is; 0 if none."""
    above = nearest_marked(items, stories, None)
    counted = above.join(items.where("type = 'comment'").select("id"), "id").where("story_id is not null and story_id <> id").groupBy("story_id").agg(F.count("*").alias("n"))
    return stories.select("id").distinct().join(counted, F.col("id") == F.col("story_id"), "left").select("id", F.coalesce("n", F.lit(0)).alias("comment_total"))
