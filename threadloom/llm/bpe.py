"""Byte-level BPE encoding and decoding with a fixed rank file.

Two tiers: a minimal perfect hash over the vocabulary (hash and displace, one 64-bit hash a look-up,
verified against the stored token) resolves a pre-token that is itself in the vocabulary; any other
pre-token is merged by a heap of adjacent pairs over a linked list of its bytes, O(n log n) for
however long a pre-token. Results are kept in bounded per-worker memos.

Splitting, where the pattern is ``UNIT_PATTERN``: the text is first cut before every single space that stands between two non-blank
characters. No match of the pattern crosses such a place (a match that takes the space starts
there), so each unit is matched by the pattern on its own and equal units are encoded once; a unit of letters, or of letters and
one sign of end punctuation, is split without it. With any other pattern the whole text is matched.

Defined cases: a null text is empty; an empty text has no ids; special tokens are never made;
duplicate rows are kept; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import table

#: A worker remembers up to 2.25 times as many entries in each of two generations: units after a space, first units, other pre-tokens.
MEMO = 200_000
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the published pattern of byte-level BPE's first vocabulary.
UNIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
ENCODED = DIGESTS + ", ids array<int>"
_DIGEST_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
_ENCODED_SCHEMA = _DIGEST_SCHEMA.append(pa.field("ids", pa.list_(pa.int32())))


def load_ranks(path: str) -> list[bytes]:
    """Tokens by rank; ranks must be 0 to n - 1 without a gap."""
    with open(path, "rb") as lines:
        found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [found[i] for i in range(len(found))]


class MinimalPerfectHash:
    """Maps each of n keys to its own slot of n: buckets are placed by falling size, each with the
    smallest displacement that hits free slots only; buckets of one key take the slots left over."""

    def __init__(self, keys: list[bytes]) -> None:
        self.n, self.m = len(keys), max(1, len(keys) // 2)
        buckets: list[list[tuple[int, int, int]]] = [[] for _ in range(self.m)]
        for i, key in enumerate(keys):
            h = xxhash.xxh3_64_intdigest(key)
            buckets[h % self.m].append(((h >> 17) % self.n, (h >> 41) | 1, i))
        self.displacement, self.slots = [0] * self.m, [-1] * self.n
        single = []
        for b in sorted(range(self.m), key=lambda b: -len(buckets[b])):
            members = buckets[b]
            if len(members) <= 1:
                if members:
                    single.append((b, members[0][2]))
                continue
            d = 0
            while True:
                at = {(a + d * step) % self.n for a, step, _ in members}
                if len(at) == len(members) and all(self.slots[s] < 0 for s in at):
                    break
                d += 1
                if d > 50 * self.n:
                    raise ValueError("keys can't be told apart")
            self.displacement[b] = d
            for a, step, i in members:
                self.slots[(a + d * step) % self.n] = i
        free = (s for s in range(self.n) if self.slots[s] < 0)
        for b, i in single:
            s = next(free)
            self.displacement[b], self.slots[s] = -s - 1, i

    def candidate(self, key: bytes) -> int:
        """The only key number that key can be."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.displacement[h % self.m]
        return self.slots[-d - 1 if d < 0 else ((h >> 17) % self.n + d * ((h >> 41) | 1)) % self.n]


def byte_pairs(ranks: dict[bytes, int]) -> list[list[int]]:
    """The rank of each pair of bytes, or -1, by first and second byte."""
    return [[ranks.get(bytes((a, b)), -1) for b in range(256)] for a in range(256)]


def merge(piece: bytes, ranks: dict[bytes, int], pairs: list[list[int]]) -> list[int]:
    """Byte-pair merges by rank, leftmost first, with a heap over a linked list of the piece's bytes.

    A heap entry is rank and place in one integer; it is stale if the pair that now begins at its
    place has another rank (a rank stands for one byte string, so an equal rank is the same merge).
    """
    n = len(piece)
    get = ranks.get
    ends = list(range(1, n + 1))  # where the part that starts here ends
    before = list(range(-1, n))  # where the part before the one that starts here starts
    pair = [pairs[a][b] for a, b in zip(piece, piece[1:])]  # of the part that starts here and the next
    pair.append(-1)
    heap = [r << 32 | i for i, r in enumerate(pair) if r >= 0]
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        entry = pop(heap)
        i = entry & 0xFFFFFFFF
        if pair[i] != entry >> 32:
            continue
        middle = ends[i]
        ends[i] = stop = ends[middle]
        pair[middle] = -1
        if stop < n:
            before[stop] = i
            pair[i] = r = get(piece[i : ends[stop]], -1)
            if r >= 0:
                push(heap, r << 32 | i)
        else:
            pair[i] = -1
        if i:
            left = before[i]
            pair[left] = r = get(piece[left:stop], -1)
            if r >= 0:
                push(heap, r << 32 | left)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : ends[i]]])
        i = ends[i]
    return out


class _Irregular(Exception):
    """A unit with blanks at an end: the text isn't cut at single spaces only."""


class _Memo(dict):
    """A bounded memo in two generations: a full one becomes the older one, found entries come back."""

    def __init__(self, codec: Codec, limit: int) -> None:
        super().__init__()
        self.codec, self.limit, self.older = codec, limit, {}

    def __missing__(self, key: str) -> str:
        out = self.older.get(key)
        if out is None:
            out = self.make(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = out
        return out


class _Pieces(_Memo):
    """Pre-token to its ids, as text."""

    def make(self, piece: str) -> str:
        codec, key = self.codec, piece.encode()
        i = codec.hash.candidate(key)
        return str(i) if codec.tokens[i] == key else " ".join(map(str, merge(key, codec.ranks, codec.pairs)))


class _Units(_Memo):
    """Unit to the ids of the pre-tokens in it, as text."""

    lead = ""

    def make(self, unit: str) -> str:
        if not unit or unit[0].isspace() or unit[-1].isspace():
            raise _Irregular
        pieces = self.codec.pieces
        if unit.isalpha():  # remembered here, not among the pieces as well
            return pieces.make(self.lead + unit)
        if unit[-1] in ".,;:!?" and unit[:-1].isalpha():
            return self[unit[:-1]] + " " + pieces[unit[-1]]
        return " ".join(map(pieces.__getitem__, self.codec.pattern.findall(self.lead + unit)))


class _LaterUnits(_Units):
    lead = " "


class Codec:
    def __init__(self, tokens: list[bytes], pattern: str, phash: MinimalPerfectHash | None = None) -> None:
        self.tokens, self.pattern, self.hash = tokens, regex.compile(pattern), phash or MinimalPerfectHash(tokens)
        self.by_units = pattern == UNIT_PATTERN
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.pairs = byte_pairs(self.ranks)
        self.spelled = {str(i): t for i, t in enumerate(tokens)}
        self.pieces = _Pieces(self, MEMO // 4)
        self.first, self.later = _Units(self, MEMO // 4), _LaterUnits(self, 7 * MEMO // 4)

    def encode_text(self, text: str) -> str:
        """The ids as decimal numbers joined by one space."""
        if not text:
            return ""
        if not self.by_units:
            return " ".join(map(self.pieces.__getitem__, self.pattern.findall(text)))
        head, *rest = text.split(" ")
        try:
            if not rest:
                return self.first[head]
            return self.first[head] + " " + " ".join(map(self.later.__getitem__, rest))
        except _Irregular:
            return " ".join(map(self.pieces.__getitem__, self.pattern.findall(text)))

    def encode(self, text: str) -> list[int]:
        return list(map(int, self.encode_text(text).split()))

    def decode_text(self, ids: str) -> bytes:
        return b"".join(map(self.spelled.__getitem__, ids.split()))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_CODECS: dict[str, Codec] = {}


def _codec(shared) -> Codec:
    """This worker's codec for a broadcast vocabulary."""
    key, tokens, pattern, phash = shared.value
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(tokens, pattern, phash)
    return _CODECS[key]


def share_vocabulary(spark, path: str, pattern: str):
    """Broadcasts the vocabulary and its hash; their size is the rank file's, whatever the corpus."""
    tokens = load_ranks(path)
    key = hashlib.sha256(b"\0".join(tokens) + pattern.encode()).hexdigest()
    return spark.sparkContext.broadcast((key, tokens, pattern, MinimalPerfectHash(tokens)))


def _texts(batch):
    for doc, text in zip(batch.column(0), batch.column(1), strict=True):
        yield doc.as_py(), text.as_py() or ""


def _digests(shared):
    def run(batches):
        codec = _codec(shared)
        for batch in batches:
            rows = [_digest(codec, doc, text)[0] for doc, text in _texts(batch)]
            yield pa.RecordBatch.from_pylist(rows, schema=_DIGEST_SCHEMA)

    return run


def _digest(codec: Codec, doc, text: str) -> tuple[dict, str]:
    """The row of digests of a text's ids and of what they decode to, and the ids."""
    spelled = codec.encode_text(text)
    return {"doc_id": doc, "n_tokens": spelled.count(" ") + 1 if spelled else 0, "ids_sha256": hashlib.sha256(spelled.encode()).hexdigest(), "decoded_sha256": hashlib.sha256(codec.decode_text(spelled)).hexdigest()}, spelled


def _encoded(shared):
    def run(batches):
        codec = _codec(shared)
        for batch in batches:
            rows, ids, held = [], [], 0
            for doc, text in _texts(batch):
                row, spelled = _digest(codec, doc, text)
                rows.append(row)
                ids.append(np.array(spelled.split(), dtype=np.int32))
                held += len(ids[-1])
                if held > 1 << 20:
                    yield _rows(rows, ids)
                    rows, ids, held = [], [], 0
            yield _rows(rows, ids)

    return run


def _rows(rows: list[dict], ids: list[np.ndarray]):
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
    values = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
    digests = pa.RecordBatch.from_pylist(rows, schema=_DIGEST_SCHEMA)
    return pa.RecordBatch.from_arrays([*digests.columns, pa.ListArray.from_arrays(pa.array(offsets), values)], schema=_ENCODED_SCHEMA)


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, digests and ids of each row of docs (doc_id, text)."""
    return _input(docs).mapInArrow(_encoded(share_vocabulary(docs.sparkSession, path, pattern)), ENCODED)


def encode_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encodes each text, decodes its ids again, and returns digests of both."""
    return _input(docs).mapInArrow(_digests(share_vocabulary(docs.sparkSession, path, pattern)), DIGESTS)


def vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def op6_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), *vocabulary())
