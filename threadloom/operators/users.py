"""Per-author activity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadloom.functions.scalar import channel, domain, month_key, user_key
from threadloom.operators.order import numbered, rotate
from threadloom.operators.shard import in_intervals


def _posts(items: DataFrame) -> DataFrame:
    return items.where("author is not null").withColumn("user_key", user_key(F.col("author"))).withColumn("seen", F.nullif("time", F.lit(0).cast("bigint")))


def user_stats(items: DataFrame) -> DataFrame:
    """One row per author, ignoring case; the spelling, and the title of the best score, are those of the earliest row (missing times first, then id)."""
    p = _posts(items).withColumn("points", F.coalesce("score", F.lit(0).cast("bigint"))).withColumn("kind", channel(F.col("type"), F.col("title"))).withColumn("at", F.struct(F.coalesce("time", F.lit(-(1 << 62))).alias("t"), "id"))
    best = F.min_by(F.struct("id", "title"), F.struct(-F.col("points"), "at"))

    def n(condition) -> F.Column:
        return F.count_if(F.coalesce(condition, F.lit(False)))

    out = p.groupBy("user_key").agg(
        F.min_by("author", "at").alias("username"), F.min("seen").alias("first_time"), F.max("seen").alias("last_time"), F.count("*").alias("items"),
        n(F.col("type") == "comment").alias("comments"), n(F.col("type") == "story").alias("stories"), n(F.col("kind") == "ask").alias("ask"), n(F.col("kind") == "show").alias("show"), n(F.col("kind") == "launch").alias("launch"),
        n(F.col("type") == "job").alias("jobs"), n(F.col("type") == "poll").alias("polls"), F.sum("points").alias("sum_score"), F.max("points").alias("max_score"), F.min("points").alias("min_score"), best.alias("best"),
    )
    return out.select("user_key", "username", "first_time", "last_time", "items", "comments", "stories", "ask", "show", "launch", "jobs", "polls", (F.col("sum_score") / F.col("items")).alias("avg_score"), "sum_score", "max_score", "min_score", F.col("best.id").alias("max_score_id"), F.nullif("best.title", F.lit("")).alias("max_score_title"))


def user_domains(items: DataFrame) -> DataFrame:
    return _posts(items).withColumn("domain", domain(F.col("url"))).where("domain is not null").groupBy("user_key", "domain").agg(F.count("*").alias("count"))


def user_months(items: DataFrame) -> DataFrame:
    return _posts(items).withColumn("month", month_key(F.col("time"))).where("month is not null").groupBy("user_key", "month").agg(F.count("*").alias("count"))


def user_growth(users: DataFrame) -> DataFrame:
    """New authors per month and their running total; the window sees one row per month."""
    months = users.withColumn("month", month_key(F.col("first_time"))).where("month is not null").groupBy("month").agg(F.count("*").alias("new_users"))
    return months.withColumn("total_users", F.sum("new_users").over(Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)))


def active_users(months: DataFrame) -> DataFrame:
    return months.groupBy("month").agg(F.count("*").alias("active"))


# How a shard of users is cut in the published archive.
TARGET_BYTES, LOOK_EVERY = 15 << 20, 1000


def user_bytes(users: DataFrame, domains: DataFrame, months: DataFrame) -> DataFrame:
    """(user_key, bytes): estimated size of a user's rows, 128 bytes and the texts, and 16 bytes and the text a host or month."""
    own = users.select("user_key", (F.lit(128) + F.octet_length("username") + F.coalesce(F.octet_length("max_score_title"), F.lit(0))).cast("bigint").alias("bytes"))
    more = [df.groupBy("user_key").agg(F.sum(F.lit(16) + F.octet_length(c)).alias("bytes")) for df, c in ((domains, "domain"), (months, "month"))]
    return own.unionByName(more[0]).unionByName(more[1]).groupBy("user_key").agg(F.sum("bytes").alias("bytes"))


def user_shards(sizes: DataFrame, target: int = TARGET_BYTES, every: int = LOOK_EVERY) -> DataFrame:
    """(user_key, bytes, rank, sid): users by key; a shard ends where, looked at after every so many users, it has reached the target."""
    return rotate(numbered(sizes, (F.col("user_key"),), "users-by-key"), F.col("bytes"), every, target)


def user_bounds(placed: DataFrame) -> DataFrame:
    """sid, user_lo, user_hi, users and bytes of each shard."""
    return placed.groupBy("sid").agg(F.min("user_key").alias("user_lo"), F.max("user_key").alias("user_hi"), F.count("*").alias("users"), F.sum("bytes").alias("bytes"))


def _ordinal(key: F.Column) -> F.Column:
    """The first seven bytes as a number that rises with the key."""
    return F.conv(F.rpad(F.hex(F.substring(key.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("bigint")


def route_users(shards: DataFrame, names: DataFrame) -> DataFrame:
    """(username, sid): the shard whose range of keys holds each name; ranges are disjoint. Keys are first compared by their leading bytes as numbers,
    so that the join is one on equal blocks, then in full."""
    keyed = names.select("username", user_key(F.col("username")).alias("key")).withColumn("_key", _ordinal(F.col("key")))
    ranges = shards.select("sid", "user_lo", "user_hi", _ordinal(F.col("user_lo")).alias("_lo"), _ordinal(F.col("user_hi")).alias("_hi"))
    return in_intervals(keyed, "_key", ranges, "_lo", "_hi").where(F.col("key").between(F.col("user_lo"), F.col("user_hi"))).select("username", "sid")
