"""Chat formatting: typed content parts flattened by a visitor into a turn template.

A conversation is a run of rows ordered by (turn, formatted segment). A row's content is its text,
or, where a column ``parts`` is an array of structs with a field ``type``, those typed parts. The visitor writes text parts
escaped, and every image, audio and document part as a placeholder; attachments are recorded
in order with the number of tokens that the placeholder expands to.

Template of one turn: ``<|start|>role<|message|>content<|end|>``.

Escaping is reversible: in texts and roles, each control string (``<|``, ``<s>``, ``</s>``,
``[INST]``, ``[/INST]``, ``<<SYS>>``, ``<</SYS>>``) gets one backslash after its first character,
and one that already has n backslashes there gets n + 1; reading takes one away.

Defined cases: a null text or role is empty; a null conv_id is a conversation of its own; a null
turn sorts first; rows that tie on turn go by their formatted segments (so by role, then escaped text), and repeated rows all count; a null
array of parts stands for the text, an empty one for no content; a column ``parts`` of any other type is ignored, as are further columns; an
empty table gives no rows. Rows are formatted where they are read, in parallel whatever conversation they
belong to. Only what is sequential by nature, the offsets and the digests of one conversation, follows the order of turns: segments are
streamed from sorted partitions, so no conversation is ever held in memory as a whole.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from threadloom.llm.common import table

START, MESSAGE, END = "<|start|>", "<|message|>", "<|end|>"
PLACEHOLDER = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}

_ESCAPE = re.compile(r"([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)")
_UNESCAPE = re.compile(r"([<\[])\\(\\*)(\||/?s>|/?INST\]|</?SYS>>)")
_TURN = re.compile(r"<\|start\|>(.*?)<\|message\|>(.*?)<\|end\|>", re.S)

#: Tokens per 28 x 28 pixel tile, per second of sound, per page.
TILE, SOUND_RATE, PAGE_TOKENS = 28, 25, 256

SEGMENTS = (
    "conv_id long, turn long, role string, segment string, char_start long, loss_start long, loss_end long, "
    "attachments array<struct<kind:string,ref:string,position:long,n_tokens:long>>"
)
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

_ATTACHMENT = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("position", pa.int64()), ("n_tokens", pa.int64())]))
_SEGMENT_SCHEMA = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("segment", pa.string()), ("char_start", pa.int64()), ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("attachments", _ATTACHMENT)])
_DIGEST_SCHEMA = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


class PartVisitor:
    """Flattens typed parts, one visit method a type; unknown types are an error."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.length = 0
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        method = getattr(self, f"visit_{part.get('type')}", None)
        if method is None:
            raise ValueError(f"unknown content part type: {part.get('type')!r}")
        method(part)

    def _write(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def _attach(self, kind: str, part: dict, n_tokens: int) -> None:
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "position": self.length, "n_tokens": n_tokens})
        self._write(PLACEHOLDER[kind])

    def visit_text(self, part: dict) -> None:
        self._write(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        tiles = math.ceil((part.get("width") or 0) / TILE) * math.ceil((part.get("height") or 0) / TILE)
        self._attach("image", part, max(1, tiles))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, max(1, math.ceil((part.get("seconds") or 0) * SOUND_RATE)))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, max(1, (part.get("pages") or 0) * PAGE_TOKENS))


def format_turn(role: str | None, text: str | None, parts: list[dict] | None = None) -> tuple[str, int, int, list[dict]]:
    """The turn's segment, where its content begins and ends in it, and its attachments."""
    visitor = PartVisitor()
    for part in parts if parts is not None else [{"type": "text", "text": text}]:
        visitor.visit(part)
    head = f"{START}{escape(role or '')}{MESSAGE}"
    for one in visitor.attachments:
        one["position"] += len(head)
    content = "".join(visitor.out)
    return f"{head}{content}{END}", len(head), len(head) + len(content), visitor.attachments


_PIECES = "conv_id long, turn long, role string, segment string, n_chars long, loss_start long, loss_end long, attachments array<struct<kind:string,ref:string,position:long,n_tokens:long>>"
_PIECE_SCHEMA = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("segment", pa.string()), ("n_chars", pa.int64()), ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("attachments", _ATTACHMENT)])


def _format(batches):
    """Each row's segment, with places counted from the segment's start."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            segment, lo, hi, attachments = format_turn(row["role"], row["text"], row.get("parts"))
            loss = row["role"] == "assistant"
            out.append({"conv_id": row["conv_id"], "turn": row["turn"], "role": row["role"], "segment": segment, "n_chars": len(segment), "loss_start": lo if loss else None, "loss_end": hi if loss else None, "attachments": attachments})
        yield pa.RecordBatch.from_pylist(out, schema=_PIECE_SCHEMA)


def _place(batches):
    """Ordered segments with their places counted from the conversation's start."""
    conv, offset, first = None, 0, True
    for batch in batches:
        starts, attachments = [], []
        for c, n, own in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "n_chars", "attachments")), strict=True):
            if first or c != conv:
                conv, offset, first = c, 0, False
            starts.append(offset)
            attachments.append([one | {"position": one["position"] + offset} for one in own])
            offset += n
        begin = pa.array(starts, pa.int64())
        shifted = [pc.add(batch.column(x), begin) for x in ("loss_start", "loss_end")]
        yield pa.RecordBatch.from_arrays([batch.column(x) for x in ("conv_id", "turn", "role", "segment")] + [begin, *shifted, pa.array(attachments, _ATTACHMENT)], schema=_SEGMENT_SCHEMA)


def _has_parts(rows: DataFrame) -> bool:
    kind = dict((f.name, f.dataType) for f in rows.schema).get("parts")
    return isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType) and "type" in kind.elementType.fieldNames()


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per turn, in order within each partition: its segment, its place in the conversation's
    formatted text (code points), the span under the loss mask (assistant content) and its attachments."""
    columns = [F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")] + (["parts"] if _has_parts(rows) else [])
    pieces = rows.select(*columns).mapInArrow(_format, _PIECES)
    return pieces.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "segment").mapInArrow(_place, SEGMENTS)


class _Reader:
    """Reads one conversation back from the pieces of its formatted text."""

    def __init__(self, conv) -> None:
        self.conv, self.n, self.chars, self.loss_chars = conv, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.buffer = ""

    def feed(self, piece: str, char_start: int, loss: tuple[int, int] | None) -> None:
        self.buffer += piece
        if loss:
            text = unescape(piece[loss[0] - char_start : loss[1] - char_start])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        done = 0
        for found in _TURN.finditer(self.buffer):
            if found.start() != done:
                raise ValueError("text outside of turns")
            done = found.end()
            self.n += 1
            self.turns.update(f"{unescape(found[1])}\n{unescape(found[2])}\n".encode())
        self.chars += len(piece)
        self.buffer = self.buffer[done:]

    def row(self) -> dict:
        if self.buffer:
            raise ValueError("the last turn doesn't end")
        return {"conv_id": self.conv, "n_turns": self.n, "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars}


def _read(batches):
    reader = None
    for batch in batches:
        out = []
        names = ("conv_id", "segment", "char_start", "loss_start", "loss_end")
        for conv, segment, start, lo, hi in zip(*(batch.column(x).to_pylist() for x in names), strict=True):
            if reader is None or conv != reader.conv:
                if reader is not None:
                    out.append(reader.row())
                reader = _Reader(conv)
            reader.feed(segment, start, None if lo is None else (lo, hi))
        yield pa.RecordBatch.from_pylist(out, schema=_DIGEST_SCHEMA)
    if reader is not None:
        yield pa.RecordBatch.from_pylist([reader.row()], schema=_DIGEST_SCHEMA)


def read_digests(segments: DataFrame) -> DataFrame:
    """Reads formatted conversations back and returns one row of digests per conversation.

    segments: from format_conversations, still in its order."""
    return segments.mapInArrow(_read, DIGESTS)


def op10_chat_formatting(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.sql("select * from values (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') as t(conv_id, turn, role, text)")
    return read_digests(format_conversations(rows.unionByName(probe)))


OP10_SQL = r"""
with rows as (
  select conv_id, turn, role, text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
  '<|start|>' || regexp_replace(coalesce(role, ''), '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g')
  || '<|message|>' || regexp_replace(coalesce(text, ''), '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g') || '<|end|>' as segment from rows)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, segment)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, segment) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(segment)) as bigint) as formatted_chars
from e group by conv_id
"""
