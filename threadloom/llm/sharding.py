"""Sharding by extendible hashing, in DataFrame expressions only.

A row's hash is the first 60 bits of md5 over its doc_id and its text's md5. The directory is indexed by hash prefixes;
a bucket whose bytes exceed the limit splits on one more bit, all others stay as they are. The splits need no pass each:
one aggregate over fine prefixes (a few dozen a shard) gives the bytes of every prefix of every length, and a row's depth is the
number of its prefixes, from the empty one on, that exceed the limit. If a finest prefix exceeds it as well, another
round goes on with further bits for the rows of those prefixes only.

Defined cases: null texts have no bytes; rows without doc_id hash as an empty id; rows equal in doc_id and text can't be told apart by
any bit: they share a shard, which is marked ``oversized`` if they exceed the limit; so is a single row above the limit; an empty
table gives no rows; further columns are ignored by the assignment and written with the shards.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import broadcast_if_small, materialize, table

BITS = 60
SHARD_BYTES = 1 << 20
#: Bits looked at beyond the expected depth.
SPARE_BITS = 6
MAX_ROUND_BITS = 24


def _prefix(bits) -> F.Column:
    """The leading bits of column h as a number; bits: a number or a column."""
    return F.expr(f"shiftright(h, {BITS} - {bits})")


def _hashed(docs: DataFrame, whole: bool) -> DataFrame:
    """doc_id, h and bytes of each row; with whole, all its columns as the struct row too."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("#"), F.md5(text.cast("binary")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long").alias("h"), F.octet_length(text).cast("long").alias("bytes"), *([F.struct(*(docs[c] for c in docs.columns)).alias("row")] if whole else []))


def _leaves(rows: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """The directory over prefixes of high bits (cell): depth, bytes and rows of each cell's leaf; depth high + 1 stands for a cell above the limit.
    Prefixes of fewer than low bits are known to exceed the limit.

    A leaf is a prefix that fits, or the finest, whose parent doesn't fit: a join on unique keys. It is then spread over the cells below it."""
    cells = rows.groupBy(_prefix(high).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"), F.min("h").alias("h0"), F.max("h").alias("h1"))
    nodes = cells.select("bytes", "n", "h0", "h1", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"), "cell").withColumn("node", F.expr(f"shiftright(cell, {high} - depth)"))
    sums = materialize(nodes.groupBy("depth", "node").agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"), (F.min("h0") == F.max("h1")).alias("one_key")), "prefixes")
    full = sums.where(F.col("shard_bytes") > limit).select((F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    below = sums.where(F.col("depth") > low).withColumn("parent", F.expr("shiftright(node, 1)")).join(full, ["depth", "parent"]).drop("parent")
    open_nodes = sums.where(F.col("depth") == low).unionByName(below)
    leaves = open_nodes.where((F.col("shard_bytes") <= limit) | (F.col("depth") == high))
    wide = F.expr(f"shiftleft(1L, {high} - depth)")
    spread = leaves.withColumn("cell", F.explode(F.sequence(F.col("node") * wide, (F.col("node") + 1) * wide - 1)))
    return spread.select("cell", F.when(F.col("shard_bytes") > limit, high + 1).otherwise(F.col("depth")).cast("int").alias("depth"), "shard_bytes", "shard_rows", "one_key")


def assign_shards(docs: DataFrame, limit: int = SHARD_BYTES, whole: bool = False) -> DataFrame:
    """doc_id, shard (its hash prefix as bits), depth, shard_bytes, shard_rows and oversized of each row; with whole, the row too."""
    rows, done, low = _hashed(docs, whole), [], 0
    kept = ["row"] if whole else []
    while True:
        total = rows.agg(F.sum("bytes")).first()[0] or 0
        high = min(BITS, low + min(MAX_ROUND_BITS, max(1, math.ceil(math.log2(max(2.0, total / limit)))) + SPARE_BITS))
        leaves = materialize(_leaves(rows, low, high, limit), "directory")
        placed = rows.withColumn("cell", _prefix(high)).join(broadcast_if_small(leaves, 64), "cell")
        last = high >= BITS
        full = F.col("depth") > high
        final = placed if last else placed.where(~full | F.col("one_key"))
        done.append(final.select("doc_id", F.when(F.least(F.col("depth"), F.lit(high)) == 0, F.lit("")).otherwise(F.expr(f"substring(lpad(bin(h), {BITS}, '0'), 1, least(depth, {high}))")).alias("shard"), F.least("depth", F.lit(high)).cast("int").alias("depth"), "shard_bytes", "shard_rows", (F.col("shard_bytes") > limit).alias("oversized"), *kept))
        more = leaves.where(full & ~F.col("one_key"))
        if last or more.isEmpty():
            break
        rows, low = placed.where(full & ~F.col("one_key")).select("doc_id", "h", "bytes", *kept), high + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """Writes every row of docs, with all columns, below path, one folder a shard."""
    if "shard" in docs.columns:
        raise ValueError("docs already has a column named shard")
    assign_shards(docs, limit, whole=True).select("row.*", "shard").repartition("shard").write.partitionBy("shard").parquet(path)


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))


OP4_SQL = f"""
with d as (select doc_id, cast(strlen(coalesce(text, '')) as bigint) as bytes,
    cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || '#' || md5(coalesce(text, ''))), 1, 15)) as bigint) as h from documents),
n as (select k as depth, h >> ({BITS} - k) as node, sum(bytes) as b, count(*) as c from d, range(0, 31) t(k) group by all),
p as (select doc_id, h, k as depth, n.b, n.c from d, range(0, 31) t(k), n where n.depth = k and n.node = (h >> ({BITS} - k))),
l as (select doc_id, h, cast(sum(case when b > {SHARD_BYTES} then 1 else 0 end) as integer) as depth from p group by doc_id, h)
select l.doc_id, substr(lpad(bin(l.h), {BITS}, '0'), 1, l.depth) as shard, l.depth, cast(p.b as bigint) as shard_bytes, p.c as shard_rows, p.b > {SHARD_BYTES} as oversized
from l join p on p.doc_id = l.doc_id and p.h = l.h and p.depth = l.depth
"""
