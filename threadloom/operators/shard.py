"""Id-range shards: the greedy cut, manifests, zone maps, routing."""

from __future__ import annotations

from bisect import bisect_right, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import raw_bytes
from threadloom.scratch import materialize, prepare


@dataclass(frozen=True)
class CutRules:
    """When a shard ends; the row that meets a rule still belongs to it."""

    # Defaults of the published archive.
    target_bytes: int = 12_582_912
    max_bytes: int = 25_165_824
    max_rows: int = 600_000
    max_days: int | None = 14
    robust_from: int = 16
    low: float = 0.01
    high: float = 0.99


def order_statistic(ordered: list, p: float):
    """The value at floor((n - 1) * p)."""
    return ordered[int((len(ordered) - 1) * p)]


#: Rows of a packed block of the cut's input.
PACKED_ROWS = 1 << 16
_PACKED = "first_id long, rows int, ids binary, times binary, known binary, bytes binary"
_PACKED_SCHEMA = pa.schema([("first_id", pa.int64()), ("rows", pa.int32()), *((x, pa.binary()) for x in ("ids", "times", "known", "bytes"))])
_BOUNDS_SCHEMA = pa.schema([("sid", pa.int32()), ("id_lo", pa.int64()), ("id_hi", pa.int64())])


def _pack(batches):
    """Sorted rows (id, time, bytes) as blocks of numbers."""
    for batch in batches:
        for at in range(0, batch.num_rows, PACKED_ROWS):
            part = batch.slice(at, PACKED_ROWS)
            ids, sizes = (part.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 2))
            known = part.column(1).is_valid().to_numpy(zero_copy_only=False)
            times = part.column(1).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([int(ids[0])], pa.int64()), pa.array([len(ids)], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (ids, times, known, sizes))], schema=_PACKED_SCHEMA)


def _spans(times: np.ndarray, known: np.ndarray, rules: CutRules) -> int | None:
    """The first row up to which the times span so many days: all of them, and, from robust_from times on, without their tails as well."""
    high = np.maximum.accumulate(np.where(known, times, np.iinfo(np.int64).min))
    low = np.minimum.accumulate(np.where(known, times, np.iinfo(np.int64).max))
    seen = np.maximum.accumulate(known)
    wide = seen & ((np.where(seen, high, 0) - np.where(seen, low, 0)) // 86400 >= rules.max_days)
    if not wide.any():
        return None
    first = int(np.argmax(wide))
    ordered = sorted(times[: first + 1][known[: first + 1]].tolist())
    for i in range(first, len(times)):
        if i > first and known[i]:
            insort(ordered, int(times[i]))
        if len(ordered) < rules.robust_from or (order_statistic(ordered, rules.high) - order_statistic(ordered, rules.low)) // 86400 >= rules.max_days:
            return i
    return None


def _cut(held: list[np.ndarray], rules: CutRules) -> int | None:
    """How many of the open shard's rows (ids, times, known, bytes) it ends with, if it ends among them."""
    _, times, known, sizes = held
    if not len(sizes):
        return None
    end = int(np.searchsorted(np.cumsum(sizes), min(rules.target_bytes, rules.max_bytes)))
    end = min(end, rules.max_rows - 1)
    if rules.max_days:
        spans = _spans(times[: end + 1], known[: end + 1], rules)
        end = end if spans is None else min(end, spans)
    return end + 1 if end < len(sizes) else None


def _cutter(rules: CutRules):
    kinds = (np.int64, np.int64, bool, np.int64)

    def run(batches):
        sid, last = 0, None
        held = [np.zeros(0, k) for k in kinds]
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True):
                new = [np.frombuffer(x, k) for x, k in zip(row, kinds, strict=True)]
                if np.any(np.diff(new[0]) < 0) or (last is not None and new[0][0] < last):
                    raise ValueError("ids out of order")
                last = int(new[0][-1])
                held = [np.concatenate(x) for x in zip(held, new, strict=True)]
                out = []
                while (n := _cut(held, rules)) is not None:
                    out.append({"sid": sid, "id_lo": int(held[0][0]), "id_hi": int(held[0][n - 1])})
                    sid, held = sid + 1, [x[n:] for x in held]
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=_BOUNDS_SCHEMA)
        if len(held[0]):
            yield pa.RecordBatch.from_pylist([{"sid": sid, "id_lo": int(held[0][0]), "id_hi": int(held[0][-1])}], schema=_BOUNDS_SCHEMA)

    return run


def shard_bounds(items: DataFrame, rules: CutRules = CutRules()) -> DataFrame:
    """sid, id_lo, id_hi. Sizes are worked out, and rows sorted and packed, in parallel. Where a shard ends depends on where the one before
    ended, so the packed blocks (25 bytes a row, one record for 65,536 rows) pass through one stream, sorted where it reads them; a cut is a search
    in running sums. The stream holds the open shard and one block."""
    prepare(items.sparkSession)
    narrow = items.select("id", F.col("time").cast("bigint").alias("time"), raw_bytes().alias("bytes")).repartitionByRange("id").sortWithinPartitions("id")
    packed = materialize(narrow.mapInArrow(_pack, _PACKED), "cut-input")
    return packed.repartition(1).sortWithinPartitions("first_id").mapInArrow(_cutter(rules), "sid int, id_lo long, id_hi long")


def in_intervals(rows: DataFrame, key: str, intervals: DataFrame, lo: str, hi: str) -> DataFrame:
    """rows joined to the disjoint intervals that hold their integer key: an equi-join on blocks of keys as wide as the mean interval (an
    interval is repeated for each block it meets, three times on average at most), then a comparison within the block."""
    least, most, n = intervals.agg(F.min(lo), F.max(hi), F.count("*")).first()
    shift = max(0, ((most - least) // n).bit_length()) if n else 0

    def block(c: str) -> Column:
        return F.shiftright(F.col(c) - F.lit(least or 0).cast("bigint"), shift)

    spread = intervals.withColumn("_block", F.explode(F.sequence(block(lo), block(hi))))
    return rows.withColumn("_block", block(key)).join(small(spread), "_block").where(F.col(key).between(F.col(lo), F.col(hi))).drop("_block")


def with_shard(items: DataFrame, bounds: DataFrame, key: str = "id") -> DataFrame:
    """Point in interval: bounds are disjoint, so at most one shard fits."""
    return in_intervals(items, key, bounds.select("sid", "id_lo", "id_hi"), "id_lo", "id_hi").drop("id_lo", "id_hi")


def small(manifest: DataFrame, rows: int = 200_000) -> DataFrame:
    """A manifest marked for broadcast if its counted rows are few; else Spark decides."""
    return F.broadcast(manifest) if manifest.count() <= rows else manifest


def effective_time(times: Column, p: float, fallback: Column) -> Column:
    """Order statistic of the sorted array, or the fallback if it is empty."""
    return F.coalesce(F.get(times, F.floor((F.size(times) - 1) * F.lit(p)).cast("int")), fallback)


def manifest(sharded: DataFrame) -> DataFrame:
    """Zone map of each shard: id and time bounds, robust time bounds, counts and estimated bytes. A shard's rows are bounded by the cut rules, so is its array of times."""
    # The 1st and 99th percentile.
    agg = sharded.groupBy("sid").agg(
        F.min("id").alias("id_lo"), F.max("id").alias("id_hi"), F.min("time").alias("tmin"), F.max("time").alias("tmax"), F.sort_array(F.collect_list("time")).alias("times"),
        F.count_if(F.col("time").isNull()).alias("time_null"), F.count("*").alias("count"), F.sum(raw_bytes()).alias("raw_bytes_est"),
        F.count_if(F.col("type") != "comment").alias("posts"), F.count_if(F.col("type") == "comment").alias("comments"),
    )
    return agg.select("sid", "id_lo", "id_hi", "tmin", "tmax", effective_time(F.col("times"), 0.01, F.col("tmin")).alias("tmin_eff"), effective_time(F.col("times"), 0.99, F.col("tmax")).alias("tmax_eff"), "time_null", "count", "raw_bytes_est", "posts", "comments")


def totals(shards: DataFrame) -> DataFrame:
    return shards.agg(F.sum("count").alias("items"), F.sum("posts").alias("posts"), F.sum("comments").alias("comments"), F.sum("raw_bytes_est").alias("bytes"), F.count("*").alias("shards"), F.max("tmax").alias("snapshot_time"))


def route_times(shards: DataFrame, lo: Column | int, hi: Column | int) -> DataFrame:
    """Shards whose effective time interval meets [lo, hi]; bounds are trimmed, so outliers can lie elsewhere."""
    lo, hi = (x if isinstance(x, Column) else F.lit(x) for x in (lo, hi))
    return shards.where((F.col("tmin_eff") <= hi) & (F.col("tmax_eff") >= lo))


def locate(bounds: list[tuple[int, int, int]], key: int) -> int | None:
    """The sid of sorted (id_lo, id_hi, sid) that holds key; for single look-ups on the driver."""
    at = bisect_right(bounds, (key, float("inf"), 0)) - 1
    return bounds[at][2] if at >= 0 and bounds[at][0] <= key <= bounds[at][1] else None
