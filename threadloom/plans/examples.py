"""User-defined functions of every kind the host interface offers, and their use."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf, udtf
from pyspark.sql.window import Window

from threadloom.scratch import prepare
from threadloom.sources.adapter import items
from threadloom.streaming import incremental


def udf1_scalar(spark, sf_dir: str) -> DataFrame:
    """A vectorised scalar function: digits of an id summed."""
    prepare(spark)

    @pandas_udf("long")
    def digit_sum(ids: pd.Series) -> pd.Series:
        return ids.astype(str).map(lambda x: sum(map(int, x))).astype("int64")

    return items(spark, sf_dir).select("id", digit_sum("id").alias("digits"))


def udf2_aggregate(spark, sf_dir: str) -> DataFrame:
    """A grouped aggregate: the range of scores of a type, in one pass over each group's scores."""
    prepare(spark)

    @pandas_udf("long")
    def spread(scores: pd.Series) -> int:
        return int(scores.max() - scores.min())

    return items(spark, sf_dir).where("score is not null").groupBy("type").agg(spread("score").alias("spread"))


def udf3_window(spark, sf_dir: str) -> DataFrame:
    """The same aggregate over a window: each author's scores so far."""
    prepare(spark)

    @pandas_udf("long")
    def total(scores: pd.Series) -> int:
        return int(scores.sum())

    order = Window.partitionBy("author").orderBy("id").rowsBetween(-2, 0)
    return items(spark, sf_dir).where("score is not null and author is not null").select("id", total("score").over(order).alias("last_three"))


def udf4_table(spark, sf_dir: str) -> DataFrame:
    """A table function joined laterally: the decimal digits of each day's number of items."""
    prepare(spark)

    @udtf(returnType="place int, digit int")
    class Digits:
        def eval(self, n: int):
            for place, digit in enumerate(reversed(str(n))):
                yield place, int(digit)

    spark.udtf.register("threadloom_digits", Digits)
    days = items(spark, sf_dir).where("time is not null").groupBy(F.floor(F.col("time") / 86400).cast("bigint").alias("day")).agg(F.count("*").alias("n"))
    return spark.sql("select day, n, d.place, d.digit from {days}, lateral threadloom_digits(n) d", days=days)


def udf5_collation(spark, sf_dir: str) -> DataFrame:
    """Grouping under a collation that ignores case; Spark offers built-in ones only."""
    named = items(spark, sf_dir).where("author is not null").select(F.collate("author", "UTF8_LCASE").alias("name"))
    return named.groupBy("name").agg(F.count("*").alias("n")).select(F.lower(F.collate("name", "UTF8_BINARY")).alias("user_key"), "n")


def entries(plain: str) -> dict:
    return {
        "udf1_scalar": (udf1_scalar, plain + "select id, cast(list_sum(list_transform(string_split(cast(id as varchar), ''), lambda x: cast(x as bigint))) as bigint) as digits from items"),
        "udf2_aggregate": (udf2_aggregate, plain + "select type, max(score) - min(score) as spread from items where score is not null group by type"),
        "udf3_window": (udf3_window, plain + "select id, cast(sum(score) over (partition by author order by id rows between 2 preceding and current row) as bigint) as last_three from items where score is not null and author is not null"),
        "udf4_table": (udf4_table, plain + ", days as (select time // 86400 as day, count(*) as n from items where time is not null group by 1) select day, n, cast(p as integer) as place, cast(substr(reverse(cast(n as varchar)), p + 1, 1) as integer) as digit from days, unnest(range(0, 12)) t(p) where p < length(cast(n as varchar))".replace("unnest(range(0, 12)) t(p)", "range(0, 12) t(p)")),
        "udf5_collation": (udf5_collation, plain + "select lower(author) as user_key, count(*) as n from items where author is not null group by all"),
        "inc1_incremental_counts": (incremental.counts_by_type, "select event_type, count(*) as n, count(distinct user_id) as users from events group by event_type"),
    }
