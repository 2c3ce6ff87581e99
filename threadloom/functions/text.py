"""Text expressions: HTML, tokens, similarity, item links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on exactly these words, patterns and sizes.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "been", "but", "by", "for", "from", "had", "has", "have", "he", "her", "his", "i", "if",
    "in", "into", "is", "it", "its", "itself", "me", "more", "most", "my", "no", "not", "of", "on", "or", "our", "ours", "s", "she", "so",
    "t", "than", "that", "the", "their", "theirs", "them", "themselves", "then", "there", "these", "they", "this", "those", "to", "too",
    "up", "us", "very", "was", "we", "were", "what", "when", "where", "which", "who", "why", "with", "you", "your", "yours", "ycombinator",
    "hn", "news", "item", "id", "https", "http", "www", "com",
)
ENTITIES = (("&quot;", '"'), ("&#x27;", "'"), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))
FORUM_HOST = "news.ycombinator.com"
MAX_STORY_TOKENS = 96
MAX_LINKS_PER_ITEM = 12
MIN_TOKEN_CHARS = 3

#: White space as JavaScript has it; Java's ``\s`` is ASCII only.
JS_SPACE = r"[\s ﻿  -     　]"
#: ASCII word boundaries: Java's ``\b`` counts accented letters as word characters.
_BEFORE, _AFTER = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"


def decode_entities(html: Column) -> Column:
    """The six entities above, the ampersand last; any other stays."""
    out = F.coalesce(html, F.lit(""))
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def strip_html(html: Column) -> Column:
    """Entities decoded, tags dropped, white space collapsed."""
    spaced = F.regexp_replace(F.regexp_replace(decode_entities(html), "<[^>]+>", " "), JS_SPACE + "+", " ")
    return F.trim(spaced)


def has_related_keyword(text: Column) -> Column:
    return F.when(strip_html(text).rlike(f"(?i){_BEFORE}(related|past){JS_SPACE}*:"), 1).otherwise(0)


def link_patterns(host: str = FORUM_HOST) -> list[str]:
    """Item links by falling reliability: full URL, host without scheme, quoted relative href, bare link of three digits or more."""
    name = host.replace(".", r"\.")
    return [
        rf"(?i)https?://{name}/item\?id=(\d+)",
        rf"(?i){_BEFORE}{name}/item\?id=(\d+)",
        r"""(?i)href\s*=\s*["']item\?id=(\d+)""",
        rf"(?i){_BEFORE}item\?id=(\d{{3,}}){_AFTER}",
    ]


def linked_items(text: Column, url: Column, limit: int = MAX_LINKS_PER_ITEM, host: str = FORUM_HOST) -> Column:
    """Distinct item ids in order of pattern, then place; at most limit (0: all)."""
    source = F.concat(F.coalesce(text, F.lit("")), F.lit("\n"), F.coalesce(url, F.lit("")))
    found = F.concat(*[F.regexp_extract_all(source, F.lit(p), F.lit(1)) for p in link_patterns(host)])
    ids = F.array_distinct(F.filter(F.transform(found, lambda x: x.try_cast("bigint")), lambda x: x > 0))
    ids = F.slice(ids, 1, limit) if limit else ids
    return F.when(F.contains(source, F.lit("item?id=")), ids).otherwise(F.array().cast("array<bigint>"))


def story_tokens(title: Column, text: Column, limit: int = MAX_STORY_TOKENS) -> Column:
    """Sorted distinct tokens: the first so many of three or more characters that are neither stop words nor numbers."""
    raw = F.lower(F.concat(strip_html(title), F.lit(" "), strip_html(text)))
    parts = F.split(raw, "[^a-z0-9]+")
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    kept = F.filter(parts, lambda t: (F.length(t) >= MIN_TOKEN_CHARS) & ~F.array_contains(stop, t) & ~t.rlike("^[0-9]+$"))
    return F.array_sort(F.slice(F.array_distinct(kept), 1, limit))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct tokens; 0 if either is empty or missing."""
    common = F.size(F.array_intersect(a, b))
    return F.when((F.coalesce(F.size(a), F.lit(0)) > 0) & (F.coalesce(F.size(b), F.lit(0)) > 0), common / (F.size(a) + F.size(b) - common)).otherwise(F.lit(0.0))


def flatten(text: Column, limit: int = 240) -> Column:
    """White space collapsed; cut to limit characters and marked if longer."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), JS_SPACE + "+", " "))
    return F.when((F.lit(limit) > 0) & (F.length(flat) > limit), F.concat(F.substring(flat, 1, limit), F.lit("..."))).otherwise(flat)


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units, as JavaScript counts."""
    return F.coalesce((F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("bigint"), F.lit(0).cast("bigint"))


def raw_bytes(author: str = "author") -> Column:
    """Estimated size of an item: 80 bytes and its texts."""
    return F.lit(80).cast("bigint") + utf16_length(F.col(author)) + utf16_length(F.col("title")) + utf16_length(F.col("text")) + utf16_length(F.col("url"))
