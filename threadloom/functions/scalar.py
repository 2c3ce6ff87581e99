"""Scalar expressions: hosts, months, spans, channels, hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def domain(url: Column) -> Column:
    """Host of a URL with its port, lower-case, without user info, default port and leading ``www.``; null if there is none."""
    scheme = F.lower(F.try_parse_url(url, F.lit("PROTOCOL")))
    authority = F.lower(F.regexp_replace(F.try_parse_url(url, F.lit("AUTHORITY")), "^.*@", ""))
    plain = F.when(scheme == "http", F.regexp_replace(authority, ":80$", "")).when(scheme == "https", F.regexp_replace(authority, ":443$", "")).otherwise(authority)
    return F.nullif(F.regexp_replace(plain, r"^www\.", ""), F.lit(""))


def utc_date(seconds: Column) -> Column:
    """The UTC day of epoch seconds, whatever the session's time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int"))


def month_key(seconds: Column) -> Column:
    """``YYYY-MM`` in UTC; null for a missing or zero time."""
    return F.date_format(utc_date(F.nullif(seconds, F.lit(0).cast("bigint"))), "yyyy-MM")


def iso_time(seconds: Column) -> Column:
    """ISO 8601 in UTC, to the second; n/a for a missing time."""
    rest = F.pmod(seconds, F.lit(86400))
    parts = [F.lpad(F.floor(rest % per / unit).cast("string"), 2, "0") for per, unit in ((86400, 3600), (3600, 60), (60, 1))]
    return F.when(seconds.isNull(), "n/a").otherwise(F.concat(F.date_format(utc_date(seconds), "yyyy-MM-dd"), F.lit("T"), F.concat_ws(":", *parts), F.lit("Z")))


def day_end(seconds: Column) -> Column:
    """The last second of the UTC day."""
    return (F.floor(seconds / 86400) * 86400 + 86399).cast("bigint")


def span_days(first: Column, last: Column) -> Column:
    return (last - first) / F.lit(86400.0)


def user_key(name: Column) -> Column:
    return F.lower(F.trim(F.coalesce(name, F.lit(""))))


def channel(kind: Column, title: Column) -> Column:
    """jobs, ask, show, launch or story; null for anything that is neither a job nor a story."""
    head = F.coalesce(title, F.lit(""))
    # The prefixes by which the forum marks its channels.
    return (
        F.when(kind == "job", "jobs")
        .when((kind != "story") | kind.isNull(), F.lit(None).cast("string"))
        .when(head.rlike("(?i)^ask hn:"), "ask")
        .when(head.rlike("(?i)^show hn:"), "show")
        .when(head.rlike("(?i)^launch hn:"), "launch")
        .otherwise("story")
    )


def short_hash(text: Column) -> Column:
    return F.substring(F.sha2(text.cast("binary"), 256), 1, 12)


def human_delta(seconds: Column) -> Column:
    """Largest fitting unit: days, hours or minutes with two digits, else seconds."""
    size = F.abs(seconds)
    sign = F.when(seconds < 0, "-").otherwise("")

    def unit(per: int, name: str) -> Column:
        hundredths = F.floor(size / F.lit(float(per)) * F.lit(100.0) + F.lit(0.5))  # a tie of the binary value goes up
        return F.concat(sign, F.floor(hundredths / 100).cast("string"), F.lit("."), F.lpad((hundredths % 100).cast("string"), 2, "0"), F.lit(f" {name}"))

    return F.when(seconds.isNull(), "n/a").when(size >= 86400, unit(86400, "days")).when(size >= 3600, unit(3600, "hours")).when(size >= 60, unit(60, "minutes")).otherwise(F.concat(sign, size.cast("string"), F.lit(" sec")))
