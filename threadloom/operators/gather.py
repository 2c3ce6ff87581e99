"""A wide column of a keyed table, brought to rows that stay in their order and task: tasks read it from sorted files, so that no row that holds
it is ever dealt or sorted."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from threadloom.scratch import materialize, prepare

#: Bytes of a row group, the least that a task reads; of the row groups that a task keeps; of a batch that it gives out.
GROUP_BYTES, HELD_BYTES, OUT_BYTES = 1 << 20, 32 << 20, 4 << 20
#: Rows whose values are looked up at once.
LOOKED_UP = 512
_OPEN_FILES = 8


def by_key(table: DataFrame, key: str, column: str, label: str) -> list[tuple[int, int, str]] | None:
    """table's key and column in files sorted by key in the shared folder: the least and the largest key of each, and its path. None if
    Python can't open the shared folder."""
    kept = table.select(F.col(key).cast("bigint").alias("key"), F.col(column).alias("value")).where("key is not null").repartitionByRange("key").sortWithinPartitions("key")
    kept = materialize(kept, label, {"parquet.block.size": GROUP_BYTES})
    files = kept.select("key", F.col("_metadata.file_path").alias("path")).groupBy("path").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    found = sorted((r.lo, r.hi, r.path) for r in files.collect())
    try:
        for _, _, path in found[:1]:
            _open(path)
    except (OSError, ValueError, NotImplementedError):
        return None
    return found


def _open(path: str) -> pq.ParquetFile:
    files, at = fs.FileSystem.from_uri(path)
    return pq.ParquetFile(files.open_input_file(at))


def _meet(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which of the intervals hold one of the sorted keys."""
    return np.flatnonzero(np.searchsorted(keys, lo, "left") < np.searchsorted(keys, hi, "right"))


class _Sorted:
    """Rows of sorted files by key. Row groups that were read last are kept, as the next rows often need them too."""

    def __init__(self, files: list[tuple[int, int, str]]) -> None:
        self.paths = [f[2] for f in files]
        self.lo, self.hi = (np.array([f[i] for f in files], np.int64) for i in (0, 1))
        self.opened: dict[int, tuple] = {}
        self.groups: dict[tuple[int, int], tuple[np.ndarray, pa.Array]] = {}
        self.held = 0

    def _file(self, at: int) -> tuple:
        if at not in self.opened:
            if len(self.opened) >= _OPEN_FILES:
                self.opened.pop(next(iter(self.opened)))[0].close()
            file = _open(self.paths[at])
            place = file.schema_arrow.get_field_index("key")
            bounds = [file.metadata.row_group(g).column(place).statistics for g in range(file.metadata.num_row_groups)]
            known = [(s.min, s.max) if s is not None and s.has_min_max else (self.lo[at], self.hi[at]) for s in bounds]
            self.opened[at] = file, np.array([k[0] for k in known], np.int64), np.array([k[1] for k in known], np.int64)
        return self.opened[at]

    def _read(self, at: int, group: int) -> tuple[np.ndarray, pa.Array]:
        name = at, group
        if name not in self.groups:
            read = self._file(at)[0].read_row_group(group, columns=["key", "value"], use_threads=False)
            self.groups[name] = read["key"].to_numpy(), pa.concat_arrays(read["value"].chunks)
            self.held += self.groups[name][1].nbytes
        else:
            self.groups[name] = self.groups.pop(name)  # the one used last
        return self.groups[name]

    def rows(self, keys: np.ndarray) -> tuple[np.ndarray, pa.Array | None]:
        """Keys, sorted, and values of all row groups that may hold one of the sorted keys."""
        names = [(int(at), int(g)) for at in _meet(keys, self.lo, self.hi) for g in _meet(keys, *self._file(int(at))[1:])]
        read = [self._read(*name) for name in names]
        for name in list(self.groups):
            if self.held <= HELD_BYTES:
                break
            if name not in names:
                self.held -= self.groups.pop(name)[1].nbytes
        if not read:
            return np.zeros(0, np.int64), None
        return np.concatenate([k for k, _ in read]), pa.concat_arrays([v for _, v in read])

    def joined(self, part: pa.RecordBatch, key: str, field: pa.Field) -> Iterator[pa.RecordBatch]:
        """part with the values of its keys: a row for each of a key's rows, or one with null if it has none; in pieces of some MB."""
        column = part.column(part.schema.get_field_index(key))
        known = column.is_valid().to_numpy(zero_copy_only=False)
        wanted = column.fill_null(0).to_numpy(zero_copy_only=False)
        keys, values = self.rows(np.unique(wanted[known]))
        if values is None:
            yield pa.RecordBatch.from_arrays([*part.columns, pa.nulls(part.num_rows, field.type)], schema=part.schema.append(field))
            return
        first, n = np.searchsorted(keys, wanted, "left"), np.zeros(len(wanted), np.int64)
        n[known] = (np.searchsorted(keys, wanted, "right") - first)[known]
        times = np.maximum(n, 1)
        row = np.repeat(np.arange(len(wanted)), times)
        place = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times) + first[row]
        missing = n[row] == 0
        sizes = np.full(len(keys), 16) if not (pa.types.is_string(values.type) or pa.types.is_binary(values.type)) else pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(np.where(missing, 0, sizes[np.where(missing, 0, place)]) + 64)
        at = 0
        while at < len(row):
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + OUT_BYTES, "right")))
            taken = values.take(pa.array(place[at:end], pa.int64(), mask=missing[at:end])).cast(field.type)
            yield pa.RecordBatch.from_arrays([*part.take(pa.array(row[at:end])).columns, taken], schema=part.schema.append(field))
            at = end


def gather(rows: DataFrame, lookups: list[tuple[str, list[tuple[int, int, str]], str]]) -> DataFrame:
    """rows left-joined to files of by_key, in the order and the partitions that they have. lookups: the key's column, the files, the new string
    column. Fast where neighbouring rows have neighbouring keys."""
    prepare(rows.sparkSession)
    schema = rows.select("*", *[F.lit(None).cast("string").alias(name) for _, _, name in lookups]).schema
    fields = {name: to_arrow_schema(schema).field(name) for _, _, name in lookups}

    def run(batches):
        sources = [(key, _Sorted(files), fields[name]) for key, files, name in lookups]

        def joined(part, left):
            if not left:
                yield part
                return
            key, source, field = left[0]
            for piece in source.joined(part, key, field):
                yield from joined(piece, left[1:])

        for batch in batches:
            for at in range(0, batch.num_rows, LOOKED_UP):
                yield from joined(batch.slice(at, LOOKED_UP), sources)

    return rows.mapInArrow(run, schema)
