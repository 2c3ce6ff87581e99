"""Document fingerprints: threshold-scaled sketches, in DataFrame expressions only.

A sketch keeps every 5-word shingle whose hash (the first 64 bits of md5) lies below a fixed fraction
(1 / 2^SCALE_BITS) of the hash range, whatever the text's length, so sketches of any documents, and unions of them, hold
the same hashes of the same shingles: sizes, intersections and containment are estimated from them
without bias. The fraction is one half, as half of the documents have fewer than 250 words; an archive of long documents
takes a finer one. Beside the hashes a sketch has a digest of the text's words, which alone tells apart two texts so short that
neither has a hash below the fraction.

Defined cases: null and empty texts (and texts of white space) have an empty sketch, alike to each other (1) and to nothing
else (0); texts of fewer than five words are one shingle; rows without doc_id come after all others, rows of one doc_id by
falling md5 of their text; the document after the last is the first; a single row is its own next; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadloom.llm.common import SPACE, broadcast_if_small, parallelism, table

SHINGLE = 5
SCALE_BITS = 1
#: The first hash, in hexadecimal, that the fixed fraction leaves out.
LIMIT = f"{1 << (64 - SCALE_BITS):016x}"
_MIN = -(1 << 63)
_BLANKS = " \t\n\x0b\x0c\r"


def with_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the sketch of column text: struct(digest of the words, kept hashes ascending)."""
    trimmed = F.btrim(F.col(text), F.lit(_BLANKS))
    keep = [c for c in df.columns if c != out]
    df = df.select(*keep, F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE)).alias("_w"))
    w = F.col("_w")
    last = F.greatest(F.size(w) - SHINGLE, F.lit(0))  # concat_ws leaves out the words that a short text doesn't have
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.md5(F.concat_ws(" ", *[F.get(w, i + k) for k in range(SHINGLE)]).cast("binary")), 1, 16))
    kept = F.when(F.size(w) > 0, F.sort_array(F.array_distinct(F.filter(hashes, lambda x: x < F.lit(LIMIT))))).otherwise(F.array().cast("array<string>"))
    return df.select(*keep, F.struct(F.md5(F.array_join(w, " ").cast("binary")).alias("digest"), kept.alias("hashes")).alias(out))


def spelled(sketch: str) -> Column:
    """The sketch as text: its digest and hashes."""
    s = F.col(sketch)
    return F.concat(s["digest"], F.lit(":"), F.array_join(s["hashes"], ","))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two sketches; of sketches without hashes, whether the words are the same."""
    common = F.size(F.array_intersect(a["hashes"], b["hashes"]))
    every = F.size(a["hashes"]) + F.size(b["hashes"]) - common
    return F.when(every == 0, (a["digest"] == b["digest"]).cast("double")).otherwise(common / every)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of a that b has as well; without hashes in a, whether the words are the same."""
    return F.when(F.size(a["hashes"]) == 0, (a["digest"] == b["digest"]).cast("double")).otherwise(F.size(F.array_intersect(a["hashes"], b["hashes"])) / F.size(a["hashes"]))


def merge(a: Column, b: Column) -> Column:
    """The sketch of the union of two shingle sets; it stands for no one text, so its digest is null."""
    return F.struct(F.lit(None).cast("string").alias("digest"), F.sort_array(F.array_union(a["hashes"], b["hashes"])).alias("hashes"))


def cardinality(a: Column) -> Column:
    """Estimated number of distinct shingles."""
    return F.size(a["hashes"]) * F.lit(1 << SCALE_BITS)


def _bounds(quantiles: list[int]) -> list[tuple[int, int]]:
    """Bounds (key, tie) of ranges: a key that holds several quantiles is divided evenly by tie, a hash of 60 bits."""
    times = {k: quantiles.count(k) for k in set(quantiles)}
    return sorted((k, (j << 60) // n) for k, n in times.items() for j in range(n))


def _bucket(key: Column, bounds: list[tuple[int, int]]) -> Column:
    """How many bounds are not above key, a struct: a binary search over a literal array."""
    if not bounds:
        return F.lit(0)
    steps = [1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)]
    array = F.array(*[F.struct(F.lit(k).cast("long").alias("key"), F.lit(t).cast("long").alias("tie")) for k, t in bounds])
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, step: F.when((at + step <= len(bounds)) & (F.get(array, at + step - 1) <= key), at + step).otherwise(at))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, key, text) with a bucket, and the text of the next row by falling doc_id within reach.

    Rows are dealt to ranges of (doc_id, hash of the text) found by one aggregate of quantiles, so one doc_id with many texts, and rows
    without any, are divided too; the first row of each range is copied behind the last row of the range before it (the very first
    one behind the very last), marked, so each range is on its own and texts are shuffled once."""
    spark = docs.sparkSession
    wanted = 4 * parallelism(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    tie = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(_MIN)).alias("key"), tie.alias("tie")).alias("key"), text.alias("text"))
    found = rows.agg(F.percentile_approx("key.key", [(i + 1) / wanted for i in range(wanted - 1)], 20 * wanted)).first()[0] if wanted > 1 else []
    rows = rows.withColumn("bucket", _bucket(F.col("key"), _bounds(found or [])))
    heads = rows.groupBy("bucket").agg(F.max("key").alias("key"))  # one row a range
    order = Window.orderBy(F.desc("bucket"))
    heads = heads.withColumn("before", F.coalesce(F.lag("bucket").over(order), F.min("bucket").over(Window.partitionBy())))
    heads = broadcast_if_small(heads, 64)
    copies = rows.join(heads.select("key", "before"), "key").groupBy("before").agg(F.min("text").alias("text"))
    lowest = F.struct(F.lit(_MIN).alias("key"), F.lit(-1).cast("long").alias("tie"))
    marked = copies.select(F.lit(None).cast("long").alias("doc_id"), lowest.alias("key"), "text", F.col("before").alias("bucket"), F.lit(True).alias("copy"))
    return rows.withColumn("copy", F.lit(False)).unionByName(marked).repartition(parallelism(spark), "bucket")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Sketches of each text, of its edited text, and their likeness; see the contract of op2."""
    own = with_sketch(with_next(docs), "text", "sketch")
    following = Window.partitionBy("bucket").orderBy("copy", F.desc("key"))
    paired = own.select("*", F.lead("text").over(following).alias("next"), F.lead("sketch").over(following).alias("next_sketch")).where(~F.col("copy"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = paired.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), "sketch", "next_sketch",
        F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))"), F.substring("next", F.lit(1), half)).alias("edited"),
    )
    both = with_sketch(edited.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)), "edited", "edited_sketch")
    return both.select("doc_id", "n_chars", "edited_sha256", spelled("sketch").alias("fingerprint"), spelled("edited_sketch").alias("edited_fingerprint"), likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


def op2_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


OP2_SQL = f"""
with t as (select doc_id, coalesce(text, '') as text from documents),
p as (select *, coalesce(lead(text) over w, first_value(text) over w) as following from t window w as (order by doc_id desc nulls last, md5(text) desc rows between unbounded preceding and unbounded following)),
e as (select doc_id, text, following, left(text, length(text) - length(text) // 2) || left(following, length(text) // 2) as edited from p),
v as (select row_number() over () as rid, * from e),
s as (select rid, k, regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+') as w from (select rid, unnest(['own', 'edited', 'next']) as k, unnest([text, edited, following]) as x from v)),
f as (select rid, k, md5(coalesce(array_to_string(w, ' '), '')) as d, case when len(w) = 0 then [] else list_sort(list_distinct(list_filter(
    list_transform(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1), lambda i: substr(md5(array_to_string(w[i:i + {SHINGLE - 1}], ' ')), 1, 16)), lambda x: x < '{LIMIT}'))) end as h from s),
j as (select v.*, a.d as ad, a.h as ah, b.d as bd, b.h as bh, c.d as cd, c.h as ch, len(list_intersect(a.h, b.h)) as ab, len(list_intersect(a.h, c.h)) as ac
    from v join f a on a.rid = v.rid and a.k = 'own' join f b on b.rid = v.rid and b.k = 'edited' join f c on c.rid = v.rid and c.k = 'next')
select doc_id, cast(length(text) as bigint) as n_chars, sha256(edited) as edited_sha256,
  ad || ':' || coalesce(array_to_string(ah, ','), '') as fingerprint, bd || ':' || coalesce(array_to_string(bh, ','), '') as edited_fingerprint,
  case when len(ah) + len(bh) = 0 then cast(ad = bd as double) else cast(ab as double) / (len(ah) + len(bh) - ab) end as near_edited,
  case when len(ah) + len(ch) = 0 then cast(ad = cd as double) else cast(ac as double) / (len(ah) + len(ch) - ac) end as near_next
from j
"""
