"""The interactive query catalogue: look-ups, top lists, ranges, prefixes and aggregates over items, users and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadloom.functions.scalar import user_key, utc_date


def item(items: DataFrame, *ids: int) -> DataFrame:
    return items.where(F.col("id").isin(*ids))


def user(users: DataFrame, name: str) -> DataFrame:
    return users.where(F.col("user_key") == user_key(F.lit(name)))


def children(edges: DataFrame, parent: int) -> DataFrame:
    return edges.where(F.col("parent_id") == parent)


def author_range(items: DataFrame, author: str, lo: int, hi: int) -> DataFrame:
    return items.where((F.col("author") == author) & F.col("time").between(lo, hi)).orderBy(F.desc("time"))


def author_scan(items: DataFrame, lo: str | None = None, hi: str | None = None) -> DataFrame:
    """Items of the authors from lo on and before hi, ignoring case, by author and time."""
    key = F.lower("author")
    found = items.where("author is not null")
    found = found.where(key >= F.lower(F.lit(lo))) if lo else found
    found = found.where(key < F.lower(F.lit(hi))) if hi else found
    return found.orderBy(key, "time", "id")


def last_day(items: DataFrame) -> DataFrame:
    """Stories of the day before the latest item."""
    latest = items.agg(F.max("time").alias("latest"))  # one row
    return items.where("type = 'story'").join(F.broadcast(latest), F.col("time") >= F.col("latest") - 86400).drop("latest")


def titled(items: DataFrame, prefix: str) -> DataFrame:
    """Stories whose title starts so, ignoring case."""
    return items.where((F.col("type") == "story") & F.col("title").ilike(f"{prefix}%"))


def top(items: DataFrame, by: list, n: int) -> DataFrame:
    return items.orderBy(*by).limit(n)


def stories_per_author(items: DataFrame, n: int = 50) -> DataFrame:
    return items.where("type = 'story'").groupBy("author").agg(F.count("*").alias("stories")).orderBy(F.desc("stories"), F.asc_nulls_first("author")).limit(n)


def users_per_domain(user_domains: DataFrame) -> DataFrame:
    return user_domains.groupBy("domain").agg(F.countDistinct("user_key").alias("users"))


def activity_per_month(user_months: DataFrame) -> DataFrame:
    return user_months.groupBy("month").agg(F.sum("count").alias("active"))


def child_counts(edges: DataFrame) -> DataFrame:
    return edges.groupBy("parent_id").agg(F.count("*").alias("cnt"))


def comments_per_item(edges: DataFrame, items: DataFrame) -> DataFrame:
    counts = edges.groupBy(F.col("parent_id").alias("id")).agg(F.count("*").alias("comments"))
    return counts.join(items.select("id", "title"), "id").select("id", "title", "comments")


def top_per_user(rows: DataFrame, what: str, n: int = 8) -> DataFrame:
    """Of each user the n values of column what with the highest counts."""
    order = Window.partitionBy("user_key").orderBy(F.desc("count"), F.asc(what))
    return rows.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= n).select("user_key", what, "count", "rn")


def in_years(index: DataFrame, *years: int) -> DataFrame:
    """Components of which any year is among years."""
    return index.where(F.arrays_overlap(F.split("years_csv", ","), F.array(*[F.lit(str(y)) for y in years])))


def timeline(members: DataFrame) -> DataFrame:
    """Members of each component numbered by day, then points."""
    order = Window.partitionBy("component_id").orderBy(utc_date(F.coalesce("time", F.lit(0).cast("bigint"))), F.coalesce("score", F.lit(0).cast("bigint")).desc(), "story_id")
    return members.withColumn("n", F.row_number().over(order)).select("component_id", "story_id", "n")


def sample(items: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """A repeatable random sample: the n smallest hashes of the seeded id."""
    return items.orderBy(F.md5(F.concat_ws("#", F.lit(seed), "id").cast("binary")), "id").limit(n)
