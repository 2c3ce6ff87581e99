"""What a build publishes: sharded Parquet, manifests as JSON, the packed cross-shard index."""

from __future__ import annotations

import json
import struct
import sys
from array import array

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators.related import Related, link_order, member_order
from threadloom.operators.shard import locate, manifest, totals
from threadloom.operators.users import active_users, user_growth
from threadloom.scratch import materialize

#: A manifest has one row a shard; more than this is not a manifest.
MANIFEST_ROWS = 200_000


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard, rows by id, so that a look-up reads one file and its id statistics prune row groups; authors, which ids don't order,
    have a bloom filter."""
    out = sharded.repartition("sid").sortWithinPartitions("sid", "id").write.mode("overwrite").option("parquet.bloom.filter.enabled#author", "true")
    out.partitionBy("sid").parquet(path)


def look_up(spark: SparkSession, shards: str, bounds: list[tuple[int, int, int]], key: int) -> DataFrame:
    """The item of an id: its shard is found in the manifest's sorted bounds (id_lo, id_hi, sid), on the driver, and only that one is read."""
    sid = locate(bounds, key)
    if sid is None:
        return read_shards(spark, shards).where("false")
    return spark.read.option("basePath", shards).parquet(f"{shards}/sid={sid}").where(F.col("id") == key)


def read_shards(spark: SparkSession, path: str, sids: list[int] | None = None) -> DataFrame:
    """The shards, or those of sids: the folder names prune the scan."""
    shards = spark.read.parquet(path)
    return shards if sids is None else shards.where(F.col("sid").isin(sids))


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """One small file on whatever file system the path names."""
    at, files = _at(spark, path)
    out = files.create(at, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def read_bytes(spark: SparkSession, path: str) -> bytes | None:
    """A small file's content, or None if there is none."""
    at, files = _at(spark, path)
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    at, files = _at(spark, path)
    files.delete(at, True)


def _rows(df: DataFrame, limit: int = MANIFEST_ROWS) -> list[dict]:
    rows = [r.asDict(True) for r in df.limit(limit + 1).collect()]
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows don't fit into a manifest")
    return rows


def write_item_manifest(sharded: DataFrame, path: str, rules) -> dict:
    """Shards with their bounds, the cut rules and the snapshot time."""
    shards = sorted(_rows(manifest(sharded)), key=lambda r: r["sid"])
    out = {"version": 1, "sharding": dict(vars(rules)), "shards": shards, "snapshot_time": max((s["tmax"] for s in shards if s["tmax"] is not None), default=None)}
    write_bytes(sharded.sparkSession, path, json.dumps(out).encode())
    return out


def rebuild_manifest(spark: SparkSession, shards: str, path: str, rules) -> dict:
    """The manifest of shards that are already written."""
    return write_item_manifest(spark.read.parquet(shards), path, rules)


def discover_shards(spark: SparkSession, folder: str, stem: str = "shard") -> DataFrame:
    """sid, file, path and bytes of the shard files in a folder, named stem_N or stem_N_HASH, plain or gzip: of several files of one shard a gzip
    one comes before a plain one, and one with a hash before one without. Only the listing is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"{stem}_*").load(folder).select("path", F.col("length").alias("bytes"))
    pattern = rf"/({stem}_(\d+)(_[0-9a-f]{{12}})?\.[a-z]+(\.gz)?)$"
    named = files.select(F.regexp_extract("path", pattern, 2).alias("n"), F.regexp_extract("path", pattern, 1).alias("file"), (F.regexp_extract("path", pattern, 4) != "").alias("gzip"), (F.regexp_extract("path", pattern, 3) != "").alias("hashed"), "path", "bytes").where("n <> ''")
    best = F.max_by(F.struct("file", "path", "bytes"), F.struct("gzip", "hashed", "file"))
    return named.groupBy(F.col("n").cast("int").alias("sid")).agg(best.alias("best")).select("sid", "best.*")


def with_content_hashes(shards: DataFrame, path: str) -> DataFrame:
    """Adds content: the first 12 digits of the SHA-256 over the sorted digests of each shard's files."""
    files = shards.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    digests = files.select(F.regexp_extract("path", r"/sid=(\d+)/", 1).cast("int").alias("sid"), F.sha2("content", 256).alias("digest"))
    content = digests.groupBy("sid").agg(F.substring(F.sha2(F.array_join(F.sort_array(F.collect_list("digest")), "").cast("binary"), 256), 1, 12).alias("content"))
    return shards.join(content, "sid", "left")


def repair_sizes(spark: SparkSession, path: str, shards: str, hashes: bool = False) -> dict:
    """Writes the bytes on disk of each shard, their share of the raw bytes, and content hashes if wanted, into a manifest that is there already."""
    out = json.loads(read_bytes(spark, path))
    listed = spark.createDataFrame([(s["sid"], s["raw_bytes_est"]) for s in out["shards"]], "sid int, raw_bytes_est long")
    sized = with_file_sizes(listed, shards)
    found = {r["sid"]: r for r in _rows(with_content_hashes(sized, shards) if hashes else sized)}
    for s in out["shards"]:
        s.update({k: v for k, v in found[s["sid"]].items() if k not in ("sid", "raw_bytes_est")})
    write_bytes(spark, path, json.dumps(out).encode())
    return out


def write_user_shards(users: DataFrame, domains: DataFrame, months: DataFrame, placed: DataFrame, path: str) -> None:
    """Tables users, user_domains and user_months below path, one folder a shard, by key; placed: (user_key, sid)."""
    where = placed.select("user_key", "sid")
    for name, rows, more in (("users", users, []), ("user_domains", domains, ["domain"]), ("user_months", months, ["month"])):
        rows.join(where, "user_key").repartition("sid").sortWithinPartitions("sid", "user_key", *more).write.mode("overwrite").partitionBy("sid").parquet(f"{path}/{name}")


def write_user_manifest(spark: SparkSession, shards: str, path: str, target: int) -> dict:
    """The manifest of user shards that are written: their bounds and bytes on disk, totals, and growth and activity by month."""
    # a table without rows has no files that a schema could be read from
    users, months = (spark.read.schema(f"user_key string, {c}, sid int").parquet(f"{shards}/{name}") for name, c in (("users", "first_time long"), ("user_months", "month string, count long")))
    bounds = users.groupBy("sid").agg(F.min("user_key").alias("user_lo"), F.max("user_key").alias("user_hi"), F.count("*").alias("users"))
    sizes = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load([f"{shards}/{name}" for name in ("users", "user_domains", "user_months")]).select("path", "length")
    sizes = sizes.groupBy(F.regexp_extract("path", r"/sid=(\d+)/", 1).cast("int").alias("sid")).agg(F.sum("length").alias("bytes"))
    rows = sorted(_rows(bounds.join(sizes, "sid", "left")), key=lambda r: r["sid"])
    series = [sorted(_rows(df), key=lambda r: r["month"]) for df in (user_growth(users), active_users(months))]
    out = {"version": 1, "target_bytes": target, "collation": "nocase", "shards": rows, "totals": {"users": sum(r["users"] for r in rows)}, "user_growth": series[0], "user_active": series[1]}
    write_bytes(spark, path, json.dumps(out).encode())
    return out


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The shards of a manifest, plain or gzip."""
    return spark.read.option("multiLine", True).json(path).select(F.explode("shards").alias("s")).select("s.*")


def with_file_sizes(shards: DataFrame, path: str) -> DataFrame:
    """Adds each shard's bytes on disk and their share of the estimated raw bytes; only file listings are read."""
    files = shards.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path).select("path", "length")
    sizes = files.groupBy(F.regexp_extract("path", r"/sid=(\d+)/", 1).cast("int").alias("sid")).agg(F.sum("length").alias("bytes"))
    return shards.join(sizes, "sid", "left").withColumn("share", F.col("bytes") / F.col("raw_bytes_est"))


def write_archive_index(sharded: DataFrame, path: str) -> dict:
    """Totals, and posts and comments of each shard."""
    per_shard = manifest(sharded)
    out = {"totals": _rows(totals(per_shard))[0], "shards": sorted(_rows(per_shard), key=lambda r: r["sid"])}
    write_bytes(sharded.sparkSession, path, json.dumps(out).encode())
    return out


# Magic, version and layout of the packed index (little-endian: magic, version, parents, links, shards, 0).
CROSS_MAGIC, CROSS_VERSION, CROSS_HEADER = b"CSHX", 1, "<4s5I"


def pack_cross(rows, shards: int) -> bytes:
    """Header, parent ids (u32), offsets (u32, one more than parents), shard ids (u16); rows: a list of (parent, sids), or an iterator of them by rising parent."""
    parents, offsets, sids = array("I"), array("I", [0]), array("H")
    try:
        for parent, own in sorted(rows) if isinstance(rows, list) else rows:
            if parents and parent <= parents[-1]:
                raise ValueError("parents must rise")
            parents.append(parent)
            sids.extend(own)
            offsets.append(len(sids))
    except OverflowError as e:
        raise ValueError("ids beyond 32 bits or shards beyond 16 bits can't be packed") from e
    if sys.byteorder == "big":
        for numbers in (parents, offsets, sids):
            numbers.byteswap()
    return struct.pack(CROSS_HEADER, CROSS_MAGIC, CROSS_VERSION, len(parents), len(sids), shards, 0) + parents.tobytes() + offsets.tobytes() + sids.tobytes()


def unpack_cross(content: bytes) -> dict[int, list[int]]:
    magic, version, n, links, _, _ = struct.unpack_from(CROSS_HEADER, content)
    if magic != CROSS_MAGIC or version != CROSS_VERSION:
        raise ValueError("not a packed cross-shard index")
    at = struct.calcsize(CROSS_HEADER)
    parents = struct.unpack_from(f"<{n}I", content, at)
    offsets = struct.unpack_from(f"<{n + 1}I", content, at + 4 * n)
    sids = struct.unpack_from(f"<{links}H", content, at + 4 * n + 4 * (n + 1))
    return {p: list(sids[offsets[i] : offsets[i + 1]]) for i, p in enumerate(parents)}


def write_cross(compressed: DataFrame, path: str, shards: int, form: str = "parquet", limit: int = 50_000_000) -> None:
    """The cross-shard index as Parquet, or, for clients that load it whole, as JSON or packed; those are refused beyond limit parents."""
    if form == "parquet":
        compressed.repartitionByRange("parent_id").sortWithinPartitions("parent_id").write.mode("overwrite").parquet(path)
        return
    if compressed.count() > limit:
        raise ValueError("too many parents for one file")
    rows = ((r.parent_id, r.sids) for r in compressed.select("parent_id", "sids").orderBy("parent_id").toLocalIterator())
    content = pack_cross(rows, shards) if form == "binary" else json.dumps({"shards": shards, "links": {str(p): list(s) for p, s in rows}}).encode()
    write_bytes(compressed.sparkSession, path, content)


def write_related(related: Related, path: str) -> dict:
    """Components, members and links by shard of ranked components, each in its order, the top lists and, last, a manifest: it says that the rest is there."""
    spark = related.items.sparkSession
    ranked = materialize(related.ranked(), "ranked-components")
    placed = ranked.select("component_id", "sid", "rank")

    def write(df: DataFrame, name: str, order: tuple) -> None:
        df.repartition("sid").sortWithinPartitions("sid", "rank", *order).write.mode("overwrite").partitionBy("sid").parquet(f"{path}/{name}")

    write(ranked, "components", ())
    write(related.members().join(placed, "component_id"), "members", member_order())
    write(related.component_links().join(placed, "component_id"), "links", link_order())
    write_bytes(spark, f"{path}/top.json", json.dumps({"version": 2, "backlinks": sorted(_rows(related.backlinks()), key=lambda r: r["rank"])}).encode())
    shards = ranked.groupBy("sid").agg(F.min("rank").alias("rank_lo"), F.max("rank").alias("rank_hi"), F.count("*").alias("component_count"), F.sum("member_count").alias("member_count"), F.sum("edge_count").alias("link_count"), F.sum("bytes").alias("bytes_est"))
    rows = sorted(_rows(shards), key=lambda r: r["sid"])
    out = {"config": dict(vars(related.config)), "totals": {k: sum(r[k] for r in rows) for k in ("component_count", "member_count", "link_count")}, "shards": rows}
    write_bytes(spark, f"{path}/manifest.json", json.dumps(out).encode())
    return out
