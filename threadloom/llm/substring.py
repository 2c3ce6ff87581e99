"""Substring dedup by recompression.

Recompression (Jez 2016) renames a sequence round by round: every run of one symbol becomes a symbol, then every pair
whose left symbol falls on the left side and whose right symbol on the right side of a partition of the alphabet that each
level draws anew. A name is a hash of what it stands for, so one table of names holds for all documents, and equal
passages get equal symbols but near their ends. How near is not bounded by the worst case but recorded: each symbol carries the
*context* of words that its being made depends on (its parts' contexts, the neighbour that could have paired with it
but didn't, the words that end a run). Where these words stand again, so does the symbol: symbols whose contexts lie within a
window of ``WINDOW`` = 20 words are the window's interior symbols.

Plan: (1) map tasks pack the rows into chunks of about ``CHUNK_BYTES`` of text, each sorted by doc_id and
stored as one compressed row; no later step shuffles plain texts. (2) In each of the ``ROUNDS`` Spark rounds, chunks rename what is left
of their texts up to a level and send each distinct symbol with its context once to the bucket of its name; buckets
tell which symbols stand nowhere else. A window with such a symbol inside can't repeat; documents without any other window drop out of the
rounds that follow. (3) What is left, about the windows that do repeat, is verified word by word: a window's words are
compared by 128 bits of two independent hashes of each word; buckets return the windows that start earlier elsewhere. (4) Each chunk marks the
words of returned windows and of windows that start earlier in the chunk itself. A passage that a third of all documents share is one
record a chunk in one bucket. A symbol longer than a window, such as a long run, tells nothing, so its windows are left for verification,
where equal windows of a chunk are one record.

Defined cases: null and empty texts have no words; texts shorter than a window lose nothing; rows without doc_id come after all
others; of rows with one doc_id the one read first counts as earlier; an empty table gives no rows; further
columns are kept by ``dedup_documents`` and ignored by ``dedup_digests``.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm import words
from threadloom.llm.common import materialize, parallelism, table

WINDOW = 20
#: Levels of naming after which a Spark round asks which symbols stand elsewhere.
ROUNDS = (4, 6)
CHUNK_BYTES = 3 << 20
#: Bytes of input that one bucket is made for.
BUCKET_INPUT = 4 << 20
#: Entries of a worker's word numbers, after which they start anew with the next chunk.
MEMO = 400_000

_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_FAR = np.iinfo(np.int64).max
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Marks a symbol that the chunk has more than once, in the byte that holds the length of its context.
_AGAIN = 128

DIGESTS = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_DIGEST_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
SYMBOLS = "bucket int, chunk long, names binary, places binary, spans binary"
_SYMBOL_SCHEMA = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("names", pa.binary()), ("places", pa.binary()), ("spans", pa.binary())])
UNIQUE = "chunk long, places binary, spans binary"
_UNIQUE_SCHEMA = pa.schema([("chunk", pa.int64()), ("places", pa.binary()), ("spans", pa.binary())])
WINDOWS = "bucket int, chunk long, hashes binary, checks binary, docs binary, places binary, own binary"
_WINDOW_SCHEMA = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), *((x, pa.binary()) for x in ("hashes", "checks", "docs", "places", "own"))])
LATER = "chunk long, places binary"
_LATER_SCHEMA = pa.schema([("chunk", pa.int64()), ("places", pa.binary())])


def _salt(level: int, what: int) -> np.uint64:
    return words.mix(np.array([2 * level + what + 1], np.uint64) * _U(_BASES[0]))[0]


class Sequence:
    """Symbols of texts put one after the other: name, first word, whether a text begins with it, and its context [low, high).

    A context that reaches beyond its text lies in no window."""

    def __init__(self, word_ids: np.ndarray, names: np.ndarray, begins: np.ndarray) -> None:
        n = len(word_ids)
        self.words, self.level, self.n = word_ids, 0, n
        self.name, self.at = names, np.arange(n, dtype=np.int32)
        self.first = np.zeros(n, bool)
        self.first[begins[begins < n]] = True
        self.low, self.high = self.at.copy(), self.at + 1

    def _ends(self) -> tuple[np.ndarray, np.ndarray]:
        """Where each symbol ends, and whether its text ends there."""
        return np.append(self.at[1:], np.int32(self.n)), np.append(self.first[1:], True)

    def _before(self) -> np.ndarray:
        """Where the context of the symbol before begins; beyond the text for a text's first symbol."""
        return np.where(self.first, self.at - 1, np.append(np.int32(-1), self.low[:-1]))

    def _after(self, ends: np.ndarray, last: np.ndarray) -> np.ndarray:
        return np.where(last, ends + 1, np.append(self.high[1:], np.int32(self.n + 1)))

    def name_runs(self) -> None:
        """Every longest run of one symbol becomes a symbol. That a symbol isn't its neighbour is seen by the words on
        either side of the cut, where they differ from the symbol's own last or first word, else by the neighbour's context."""
        ends, last = self._ends()
        word, n = self.words, self.n
        low = np.where(~self.first & (word[np.maximum(self.at - 1, 0)] != word[ends - 1]), self.at - 1, self._before())
        high = np.where(~last & (word[np.minimum(ends, n - 1)] != word[self.at]), ends + 1, self._after(ends, last))
        self.low, self.high = np.minimum(self.low, low), np.maximum(self.high, high)
        equal = (self.name[1:] == self.name[:-1]) & ~self.first[1:]
        if equal.any():
            start = np.flatnonzero(np.concatenate(([True], ~equal)))
            size = np.diff(np.append(start, len(self.name)))
            name, run = self.name[start], size > 1
            name[run] = words.mix(name[run] * _U(_BASES[0]) + size[run].astype(np.uint64) * _U(_BASES[1]) + _salt(self.level, 1))
            self.low, self.high = np.minimum.reduceat(self.low, start), np.maximum.reduceat(self.high, start)
            self.name, self.at, self.first = name, self.at[start], self.first[start]

    def name_pairs(self) -> None:
        """Every left symbol followed by a right one becomes a symbol with it; one left over depends on the neighbour that it could
        have paired with."""
        salt = _salt(self.level, 0)
        right = (words.mix(self.name ^ salt) & _U(1)).astype(bool)
        pair = ~right[:-1] & right[1:] & ~self.first[1:]
        alone = ~(np.append(pair, False) | np.concatenate(([False], pair)))
        ends, last = self._ends()
        low = np.where(alone & right, np.minimum(self.low, self._before()), self.low)
        high = np.where(alone & ~right, np.maximum(self.high, self._after(ends, last)), self.high)
        p = np.flatnonzero(pair)
        name = self.name.copy()
        name[p] = words.mix(name[p] * _U(_BASES[0]) + name[p + 1] * _U(_BASES[1]) + salt)
        low[p], high[p] = np.minimum(low[p], low[p + 1]), np.maximum(high[p], high[p + 1])
        keep = np.concatenate(([True], ~pair))
        self.name, self.at, self.first, self.low, self.high = name[keep], self.at[keep], self.first[keep], low[keep], high[keep]

    def rename(self, level: int) -> Sequence:
        while self.level < level and len(self.name) > 1:
            self.name_runs()
            self.name_pairs()
            self.level += 1
        return self


class _Prefix:
    """Hashes of any runs of words by prefix sums of a polynomial, modulo 2^64."""

    def __init__(self, h: np.ndarray, base: int) -> None:
        n = len(h)
        powers = np.empty(n + 1, np.uint64)
        powers[0], powers[1:] = 1, base
        np.multiply.accumulate(powers, out=powers)
        inverse = np.empty(n + 1, np.uint64)
        inverse[0], inverse[1:] = 1, pow(base, -1, 1 << 64)
        self.inverse = np.multiply.accumulate(inverse)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * powers[:-1], dtype=np.uint64)))

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return words.mix((self.sums[high] - self.sums[low]) * self.inverse[low] + (high - low).astype(np.uint64))


class _WordNumbers(dict):
    """Word to its number, with two independent hashes of 64 bits by number."""

    def __init__(self) -> None:
        super().__init__()
        self.one, self.two = array("Q"), array("Q")

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_128_intdigest(word)
        self.one.append(h >> 64)
        self.two.append(h & ((1 << 64) - 1))
        out = self[word] = len(self)
        return out


_NUMBERS = [_WordNumbers()]


class _Texts:
    """Words of some texts, one after the other: numbers, both hashes, and where texts begin."""

    def __init__(self, texts: list[str | None]) -> None:
        if len(_NUMBERS[0]) > MEMO:
            _NUMBERS[0] = _WordNumbers()
        number = _NUMBERS[0]
        parts = [np.fromiter(map(number.__getitem__, w), np.int32, len(w)) for w in map(words.split, texts)]
        self.begins = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64))).astype(np.int64)
        self.ids = np.concatenate(parts or [np.zeros(0, np.int32)])
        self.one, self.two = (np.array(x, np.uint64)[self.ids] for x in (number.one, number.two))

    def row_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, at, side="right") - 1

    def symbols(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Names (by their words in context), first words and ends of the contexts of at most a window."""
        if not len(self.ids):
            return np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        seq = Sequence(self.ids, self.one, self.begins).rename(level)
        row = self.row_of(seq.at)
        good = (seq.high - seq.low <= WINDOW) & (seq.low >= self.begins[row]) & (seq.high <= self.begins[row + 1])
        low, high = seq.low[good], seq.high[good]
        return _Prefix(self.one, _BASES[0]).of(low, high) ^ (seq.name[good] * _U(_BASES[1])), low, high


class _Chunk:
    """The rows of a chunk and the numbers of their words."""

    def __init__(self, content: bytes, counts: bytes) -> None:
        pa.default_memory_pool().release_unused()  # of the chunk before
        rows = pa.ipc.open_stream(content).read_all().combine_chunks()
        batches = rows.to_batches()
        self.batch = batches[0] if batches else pa.RecordBatch.from_pylist([], schema=rows.schema)
        self.begins = np.concatenate(([0], np.cumsum(np.frombuffer(counts, np.int32), dtype=np.int64)))
        self.n = int(self.begins[-1])

    def doc_ids(self) -> np.ndarray:
        return np.array([_FAR if x is None else x for x in self.batch.column("doc_id").to_pylist()], dtype=np.int64)

    def live(self, unique: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Which places begin a window of one text that holds none of the unique symbols' contexts (places, lengths)."""
        out = np.zeros(self.n, bool)
        if self.n < WINDOW:
            return out
        start = np.arange(self.n - WINDOW + 1)
        ends = self.begins[np.searchsorted(self.begins, start, side="right")]
        nearest = np.full(self.n + 1, self.n + WINDOW + 1, np.int64)  # the nearest end of a unique context that begins here or later
        for places, spans in unique:
            np.minimum.at(nearest, places, places.astype(np.int64) + spans)
        nearest = np.minimum.accumulate(nearest[::-1])[::-1]
        out[: len(start)] = (start + WINDOW <= ends) & (nearest[start] > start + WINDOW)
        return out

    def part(self, live: np.ndarray) -> tuple[_Texts, np.ndarray]:
        """The texts with a live window, and what to add to their places to get the chunk's."""
        rows = np.flatnonzero(np.add.reduceat(np.append(live, False).astype(np.int32), np.minimum(self.begins[:-1], self.n)) * (np.diff(self.begins) > 0)) if len(self.begins) > 1 else np.zeros(0, np.int64)
        texts = _Texts(self.batch.column("text").take(pa.array(rows)).to_pylist())
        return texts, np.repeat(self.begins[rows] - texts.begins[:-1], np.diff(texts.begins))


def _pack(batches):
    """Chunks of rows, sorted by doc_id, each as one compressed Arrow stream with the number of words of each row."""
    from pyspark import TaskContext

    made, held, size = 0, [], 0
    task = TaskContext.get().partitionId()

    def chunk():
        nonlocal made
        rows = pa.Table.from_batches(held)
        ids = np.array([_FAR if x is None else x for x in rows.column("doc_id").to_pylist()], dtype=np.int64)
        rows = rows.take(pa.array(np.argsort(ids, kind="stable"))).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(rows)
        made += 1
        counts = np.array([len(words.split(t.as_py())) for t in rows.column("text")], np.int32)
        return pa.RecordBatch.from_arrays([pa.array([(task << 32) | made], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary())], names=["chunk", "rows", "counts"])

    for batch in batches:
        lengths = np.diff(np.frombuffer(batch.column("text").cast(pa.large_string()).buffers()[1], np.int64, batch.num_rows + 1, batch.column("text").offset * 8)) if batch.num_rows else np.zeros(0)
        at = 0
        while at < batch.num_rows:
            take = max(1, int(np.searchsorted(np.cumsum(lengths[at:]), CHUNK_BYTES - size)))
            part = batch.slice(at, take)
            held.append(part)
            size += int(lengths[at : at + take].sum())
            at += take
            if size >= CHUNK_BYTES or at < batch.num_rows:
                yield chunk()
                held, size = [], 0
    if held:
        yield chunk()


def _slices(u: np.ndarray, buckets: int):
    """(bucket, slice) of sorted hashes, for the buckets that have any."""
    if not len(u):
        return
    bucket = ((u >> _U(32)) * _U(buckets)) >> _U(32)
    starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(u)], strict=True):
        yield int(bucket[low]), slice(low, high)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _symbol_rows(number: int, names: np.ndarray, low: np.ndarray, high: np.ndarray, buckets: int) -> list[tuple]:
    """Each distinct symbol once, with its first place, by bucket."""
    u, first, count = np.unique(names, return_index=True, return_counts=True)
    places = low[first].astype(np.int32)
    spans = ((high - low)[first] | np.where(count > 1, _AGAIN, 0)).astype(np.uint8)
    return [(b, number, u[s].tobytes(), places[s].tobytes(), spans[s].tobytes()) for b, s in _slices(u, buckets)]


def _send_all(level: int, buckets: int):
    """The symbols of all texts of a chunk."""

    def run(batches):
        for batch in batches:
            for number, content, counts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                chunk = _Chunk(content.as_py(), counts.as_py())
                rows = _symbol_rows(number, *_Texts(chunk.batch.column("text").to_pylist()).symbols(level), buckets)
                if rows:
                    yield from _table(rows, _SYMBOL_SCHEMA).combine_chunks().to_batches()

    return run


def _unique_of(group) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.frombuffer(p, np.int32), np.frombuffer(s, np.uint8)) for p, s in zip(group.column("places").to_pylist(), group.column("spans").to_pylist(), strict=True)]


def _opened(left) -> tuple[int, _Chunk]:
    return left.column("chunk")[0].as_py(), _Chunk(left.column("rows")[0].as_py(), left.column("counts")[0].as_py())


def _send_live(level: int, buckets: int):
    """The symbols that lie in a live window."""

    def run(left, right):
        rows = []
        if left.num_rows:
            number, chunk = _opened(left)
            live = chunk.live(_unique_of(right))
            texts, shift = chunk.part(live)
            names, low, high = texts.symbols(level)
            if len(names):
                shift = shift[low]
                low, high = low + shift, high + shift
                before = np.concatenate(([0], np.cumsum(live)))
                inside = before[low + 1] > before[np.maximum(high - WINDOW, 0)]
                rows = _symbol_rows(number, names[inside], low[inside], high[inside], buckets)
        return _table(rows, _SYMBOL_SCHEMA)

    return run


def _joined(column, dtype) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(x, dtype) for x in column.to_pylist()]
    return np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def _by_row(row: np.ndarray, n: int, *columns: np.ndarray):
    """(row, its values of each column) of the rows that have any."""
    order = np.argsort(row, kind="stable")
    cuts = np.searchsorted(row[order], np.arange(n + 1))
    for i in np.flatnonzero(np.diff(cuts)).tolist():
        yield i, *(c[order[cuts[i] : cuts[i + 1]]] for c in columns)


def _unique_symbols(group):
    """Symbols that one chunk alone has, and once (each chunk sends a symbol once, marked if it has it more than once)."""
    names, row = _joined(group.column("names"), np.uint64)
    places, spans = _joined(group.column("places"), np.int32)[0], _joined(group.column("spans"), np.uint8)[0]
    order = np.argsort(names, kind="stable")
    s = names[order]
    same = s[1:] == s[:-1]
    alone = np.ones(len(s), bool)
    alone[1:] &= ~same
    alone[:-1] &= ~same
    good = order[alone]
    good = good[spans[good] < _AGAIN]
    chunks = group.column("chunk").to_pylist()
    return _table([(chunks[i], np.ascontiguousarray(p).tobytes(), np.ascontiguousarray(k).tobytes()) for i, p, k in _by_row(row[good], len(chunks), places[good], spans[good])], _UNIQUE_SCHEMA)


def _send_windows(buckets: int):
    """Each distinct live window once, at its first place, and the places of windows that stand earlier in the chunk."""

    def run(left, right):
        rows = []
        if left.num_rows:
            number, chunk = _opened(left)
            live = chunk.live(_unique_of(right))
            texts, shift = chunk.part(live)
            at = np.arange(len(shift))
            at = at[live[at + shift]] if len(shift) else at
            g = _Prefix(texts.one, _BASES[0]).of(at, at + WINDOW)
            check = _Prefix(texts.two, _BASES[1]).of(at, at + WINDOW)
            place = (at + shift[at]).astype(np.int32)
            order = np.lexsort((place, check, g))
            g, check, place = g[order], check[order], place[order]
            new = np.ones(len(g), bool)
            new[1:] = (g[1:] != g[:-1]) | (check[1:] != check[:-1])
            own = np.sort(place[~new])
            g, check, place = g[new], check[new], place[new]
            docs = chunk.doc_ids()[np.searchsorted(chunk.begins, place, side="right") - 1] if len(place) else np.zeros(0, np.int64)
            for b, s in _slices(g, buckets):
                near = np.argsort(place[s], kind="stable")  # near places and documents follow each other and compress
                rows.append((b, number, g[s][near].tobytes(), check[s][near].tobytes(), np.diff(docs[s][near], prepend=0).tobytes(), place[s][near].tobytes(), b""))
            if len(own):
                rows.append((number % buckets, number, b"", b"", b"", b"", own.tobytes()))
        return _table(rows, _WINDOW_SCHEMA)

    return run


def _later_windows(group):
    """Windows whose words also start at a smaller (doc_id, chunk, place)."""
    g, row = _joined(group.column("hashes"), np.uint64)
    check, place = _joined(group.column("checks"), np.uint64)[0], _joined(group.column("places"), np.int32)[0]
    docs = np.concatenate([np.cumsum(np.frombuffer(x, np.int64)) for x in group.column("docs").to_pylist()])
    chunks = group.column("chunk").to_pylist()
    order = np.lexsort((place, np.array(chunks, dtype=np.int64)[row], docs, check, g))
    s, c = g[order], check[order]
    later = order[1:][(s[1:] == s[:-1]) & (c[1:] == c[:-1])]
    found = [(chunks[i], np.sort(p).tobytes()) for i, p in _by_row(row[later], len(chunks), place[later])]
    return _table(found + [(c, x) for c, x in zip(chunks, group.column("own").to_pylist(), strict=True) if x], _LATER_SCHEMA)


def _covered(chunk: _Chunk, later) -> np.ndarray:
    """Which words a later window covers."""
    delta = np.zeros(chunk.n + WINDOW + 1, np.int32)
    for x in later.column("places").to_pylist():  # a place is in one of them only
        starts = np.frombuffer(x, np.int32)
        delta[starts] += 1
        delta[starts + WINDOW] -= 1
    return np.cumsum(delta)[: chunk.n] > 0


def _digest_rows(left, right):
    if not left.num_rows:
        return _table([], _DIGEST_SCHEMA)
    _, chunk = _opened(left)
    gone = _covered(chunk, right)
    n, removed, digest = [], [], []
    for i, text in enumerate(chunk.batch.column("text").to_pylist()):
        own = gone[chunk.begins[i] : chunk.begins[i + 1]]
        parts = words.split(text)
        n.append(len(parts))
        removed.append(int(own.sum()))
        if removed[-1]:
            parts = [parts[k] for k in np.flatnonzero(~own)]
        digest.append(hashlib.sha256(b" ".join(parts)).hexdigest())
    return pa.table([chunk.batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())], schema=_DIGEST_SCHEMA)


def cut_words(text: str, gone: np.ndarray) -> str:
    """The text without the marked words and the white space before each of them; white space elsewhere stays."""
    data, out, at = text.encode(), [], 0
    for i, found in enumerate(_WORD.finditer(data)):
        if gone[i]:
            at = found.end()
        else:
            out.append(data[at : found.end()])
            at = found.end()
    out.append(data[at:])
    return b"".join(out).decode().strip(" \t\n\r\x0b\x0c")


def _document_rows(left, right):
    _, chunk = _opened(left)
    gone = _covered(chunk, right)
    texts = []
    for i, text in enumerate(chunk.batch.column("text").to_pylist()):
        own = gone[chunk.begins[i] : chunk.begins[i + 1]]
        texts.append(cut_words(text, own) if own.any() else text)
    batch = chunk.batch
    columns = [pa.array(texts, batch.schema.field("text").type) if f.name == "text" else batch.column(i) for i, f in enumerate(batch.schema)]
    return pa.table(columns, schema=batch.schema)


def _find(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The chunk table, and of each chunk the places where windows start that start earlier elsewhere."""
    spark = docs.sparkSession
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    buckets = max(math.ceil(docs.rdd.getNumPartitions() * split / BUCKET_INPUT), 2 * parallelism(spark))
    chunks = materialize(docs.mapInArrow(_pack, "chunk long, rows binary, counts binary"), "chunks")
    unique = None
    for level in ROUNDS:
        if unique is None:
            sent = chunks.mapInArrow(_send_all(level, buckets), SYMBOLS)
        else:
            sent = chunks.groupBy("chunk").cogroup(unique.groupBy("chunk")).applyInArrow(_send_live(level, buckets), SYMBOLS)
        found = materialize(sent.groupBy("bucket").applyInArrow(_unique_symbols, UNIQUE), "unique-symbols")
        unique = found if unique is None else unique.union(found)
    windows = chunks.groupBy("chunk").cogroup(unique.groupBy("chunk")).applyInArrow(_send_windows(buckets), WINDOWS)
    return chunks, materialize(windows.groupBy("bucket").applyInArrow(_later_windows, LATER), "later-windows")


def dedup_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the kept words of each row of docs (doc_id, text)."""
    chunks, later = _find(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    return chunks.groupBy("chunk").cogroup(later.groupBy("chunk")).applyInArrow(_digest_rows, DIGESTS)


def dedup_documents(docs: DataFrame) -> DataFrame:
    """docs with the repeated words cut from text; rows and other columns stay as they are."""
    chunks, later = _find(docs)
    return chunks.groupBy("chunk").cogroup(later.groupBy("chunk")).applyInArrow(_document_rows, docs.schema)


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_digests(table(spark, sf_dir, "documents"))


OP8_SQL = """
with d as (select doc_id, row_number() over () as rid, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
x as (select rid, doc_id, unnest(range(1, len(w) - 18)) as s, w from d where len(w) >= 20),
h as (select rid, doc_id, s, md5(array_to_string(w[s:s + 19], ' ')) as g from x),
f as (select rid, s, row_number() over (partition by g order by doc_id, s) as k from h),
c as (select distinct rid, s + unnest(range(0, 20)) as p from f where k > 1),
p as (select rid, doc_id, unnest(w) as v, unnest(range(1, len(w) + 1)) as p from d),
k as (select p.rid, string_agg(p.v, ' ' order by p.p) as t, count(*) as n from p anti join c on p.rid = c.rid and p.p = c.p group by p.rid)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(k.n, 0) as bigint) as n_removed, sha256(coalesce(k.t, '')) as kept_sha256
from d left join k using (rid)
"""
