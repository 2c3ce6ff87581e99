"""WARC archives with revisit records.

``resolve`` decides from record headers alone (record id, payload digest, payload length) which
records hold a payload: of those with one digest and at least ``min_bytes`` the one with the
smallest id is the response, the others revisit it. Headers are shuffled by digest, pre-aggregated,
so a digest that a third of all records share is one row a task. ``write_archives`` joins the
decisions of repeated digests to the records (broadcast only if their counted size is below the
bound) and writes archives through Spark's text writer: the record separator of WARC (two CRLF) is
its line separator, so the files are ordinary WARC/1.1, on any file system Spark writes to, under
its commit protocol. ``read_archives`` streams gzip files, of one member or many, through Spark's text reader, cut at the same
separator, and puts the pieces together again by Content-Length: a task holds a batch of pieces and one record, whatever the
size of its file. ``resolve_revisits`` joins revisits to the responses they refer to. A record's id is made of page_id and payload digest.
Spark's writer makes one gzip member a file, so a record can't be read without those before it.

Defined cases: null or empty payload: a response of no bytes; null url: no target; rows without a
page_id are always responses, have a random record id and are never referred to; repeated rows of one page_id and payload are
all responses and share a record id; an empty table gives no records; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import broadcast_if_small, materialize, scratch_path, table

CRLF = "\r\n"
_SEPARATOR = b"\r\n\r\n"
DIGEST_PREFIX = "sha256:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_DATE = "2024-01-01T00:00:00Z"
MIN_REVISIT_BYTES = 100
RECORDS_PER_FILE = 10_000

RECORDS = "page_id long, url string, record_type string, header_digest string, content_digest string, payload_bytes long, refers_to long, refers_to_digest string, payload binary"
_RECORD_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("header_digest", pa.string()), ("content_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("refers_to_digest", pa.string()), ("payload", pa.binary())])


def with_headers(pages: DataFrame) -> DataFrame:
    """page_id, url, payload and the header fields made from the payload."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.regexp_replace("url", r"[\r\n]", ""), F.lit("")).alias("url"), payload.alias("payload"), F.sha2(payload.cast("binary"), 256).alias("digest"), F.octet_length(payload).cast("long").alias("payload_bytes"))


def resolve(headers: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """digest and the response's page_id, for each digest that more than one record has."""
    return (
        headers.where((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first_id")
    )


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Writes one record per page to gzip archives below path."""
    records = with_headers(pages)
    decisions = broadcast_if_small(materialize(resolve(records.drop("payload", "url"), min_bytes), "warc-decisions"), 120)
    decided = records.join(decisions, "digest", "left").withColumn("revisit", F.coalesce(F.col("page_id") != F.col("first_id"), F.lit(False)))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(CRLF * 2))
    block = F.when(F.col("revisit"), F.lit("")).otherwise(F.concat(http, F.col("payload")))

    def identity(c: str) -> F.Column:
        return F.coalesce(F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(":"), F.col("digest"), F.lit(">")), F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")))

    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(f"{CRLF}WARC-Record-ID: "), identity("page_id"),
        F.lit(f"{CRLF}WARC-Date: {WARC_DATE}{CRLF}WARC-Target-URI: "), F.col("url"),
        F.lit(f"{CRLF}WARC-Payload-Digest: {DIGEST_PREFIX}"), F.col("digest"),
        F.when(F.col("revisit"), F.concat(F.lit(f"{CRLF}WARC-Profile: {REVISIT_PROFILE}{CRLF}WARC-Refers-To: "), identity("first_id"))).otherwise(F.lit("")),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "), F.octet_length("block").cast("string"), F.lit(CRLF * 2),
    )
    decided.withColumn("block", block).select(F.concat(head, F.col("block")).alias("value")).write.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _members(content: bytes):
    """Pieces of a plain or gzip file, whatever number of gzip members it has."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    rest = content
    while rest:
        unzip = zlib.decompressobj(31)
        yield unzip.decompress(rest, 1 << 20)
        while unzip.unconsumed_tail:
            yield unzip.decompress(unzip.unconsumed_tail, 1 << 20)
        yield unzip.flush()
        rest = unzip.unused_data


def parse_records(archive: bytes | Iterable[bytes]):
    """(headers by lower-case name, block) of each record of an archive, whole or in pieces; a cut or malformed record is an error."""
    buffer, pieces = bytearray(), _members(archive) if isinstance(archive, bytes) else iter(archive)

    def fill(n: int) -> bool:
        while len(buffer) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            buffer.extend(piece)
        return True

    while True:
        while fill(2) and buffer[:2] == b"\r\n":  # empty lines between records
            del buffer[:2]
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not fill(len(buffer) + 1):
                if bytes(buffer).strip():
                    raise ValueError("a record's header is cut off")
                return
        lines = bytes(buffer[:end]).decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size, start = int(headers["content-length"]), end + 4
        if not fill(start + size + 4):
            raise ValueError("a record's block is cut off")
        yield headers, bytes(buffer[start : start + size])
        del buffer[: start + size + 4]


def _page(identity: str | None) -> int | None:
    number = (identity or "").removeprefix("<urn:page:").partition(":")[0].rstrip(">")
    return int(number) if number.lstrip("-").isdigit() else None


def _record(headers: dict, block: bytes, with_payload: bool) -> dict:
    kind = headers["warc-type"]
    out = {"page_id": _page(headers.get("warc-record-id")), "url": headers.get("warc-target-uri"), "record_type": kind, "header_digest": headers.get("warc-payload-digest", "").removeprefix(DIGEST_PREFIX)}
    if kind == "revisit":
        return out | {"refers_to": _page(headers.get("warc-refers-to")), "refers_to_digest": out["header_digest"]}
    payload = block.partition(b"\r\n\r\n")[2]
    return out | {"content_digest": hashlib.sha256(payload).hexdigest(), "payload_bytes": len(payload), "payload": payload if with_payload else None}


def _rows(archives, with_payload: bool):
    """Batches of the records of some archives, each whole or in pieces."""
    rows, held = [], 0
    for archive in archives:
        for headers, block in parse_records(archive):
            rows.append(_record(headers, block, with_payload))
            held += len(block) if with_payload else 0
            if len(rows) >= 2000 or held >= 8 << 20:
                yield pa.RecordBatch.from_pylist(rows, schema=_RECORD_SCHEMA)
                rows, held = [], 0
    yield pa.RecordBatch.from_pylist(rows, schema=_RECORD_SCHEMA)


def _parse_whole(with_payload: bool):
    """Archives as (content)."""

    def parse(batches):
        yield from _rows((content.as_py() for batch in batches for content in batch.column(0)), with_payload)

    return parse


def _parse_pieces(with_payload: bool):
    """Archives as (file, what stands between two separators), a file's rows in order."""

    def parse(batches):
        pieces = ((file, piece.as_py() + _SEPARATOR) for batch in batches for file, piece in zip(batch.column(0).to_pylist(), batch.column(1), strict=True))
        yield from _rows(((piece for _, piece in own) for _, own in groupby(pieces, key=itemgetter(0))), with_payload)

    return parse


def read_archives(spark, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives below path: *.gz in a stream, *.warc, which Spark would split anywhere, whole (up to 2 GB)."""

    def files(form: str, glob: str) -> DataFrame:
        return spark.read.format(form).option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("lineSep", CRLF * 2).load(path)

    streamed = files("text", "*.gz").select("_metadata.file_path", F.col("value").cast("binary")).mapInArrow(_parse_pieces(with_payload), RECORDS)
    plain = files("binaryFile", "*.warc")
    return streamed.unionAll(plain.select("content").mapInArrow(_parse_whole(with_payload), RECORDS)) if plain.inputFiles() else streamed


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Revisits with the digest and size of the response they refer to; responses as they are.

    A revisit whose response is missing or has another digest gets nulls."""
    responses = records.where("record_type = 'response'").select("page_id", "content_digest", "payload_bytes")
    originals = responses.where("page_id is not null").dropDuplicates(["page_id", "content_digest"]).select(F.col("page_id").alias("refers_to"), F.col("content_digest").alias("refers_to_digest"), F.col("content_digest").alias("payload_digest"), "payload_bytes")
    revisits = records.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to", "refers_to_digest").join(originals, ["refers_to", "refers_to_digest"], "left")
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select("page_id", "payload_bytes", F.col("content_digest").alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")).select(out).unionByName(revisits.select(out))


def op5_warc(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    headers = materialize(read_archives(spark, path, with_payload=False).drop("payload", "url"), "warc-headers")
    return resolve_revisits(headers)


OP5_SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, cast(strlen(html) as bigint) as payload_bytes, sha256(html) as payload_digest from p),
f as (select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first_id from d)
select page_id, payload_bytes, payload_digest,
  case when page_id <> first_id then 'revisit' else 'response' end as record_type,
  case when page_id <> first_id then first_id end as refers_to
from f
"""
