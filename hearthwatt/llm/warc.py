"""WARC archives: a writer on Spark's text sink and a reader that salvages what follows a damaged place."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hearthwatt.llm.frames import stored, table
from hearthwatt.llm.registry import query
from hearthwatt.sources.shared import run_folder

#: Bytes per archive. A reader holds one archive in memory.
ARCHIVE_BYTES = 16 << 20

_START = re.compile(rb"WARC/1\.[01]\r\n")
_MEMBER = b"\x1f\x8b\x08"
#: The member that follows a record of 16 MB or more.
_EMPTY = zlib.compressobj(1, zlib.DEFLATED, 31).flush()


def base32(hexadecimal: Column) -> Column:
    """Upper-case base32 of a digest given in hexadecimal; 40 bits, ten digits, are eight characters."""
    parts = [F.lpad(F.conv(F.substring(hexadecimal, i, 10), 16, 32), 8, "0") for i in range(1, 41, 10)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def deduplicated(pages: DataFrame, least: int = 0) -> DataFrame:
    """``page_id, url, payload`` with ``digest`` (hexadecimal SHA-1) and ``first``: the smallest page_id whose payload of
    ``least`` bytes or more is the same. Only digests that occur more than once are joined back."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    read = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    read = read.withColumn("digest", F.sha1("payload"))
    repeated = pages.select(F.col("page_id").cast("long").alias("id"), F.sha1(payload).alias("digest"), F.length(payload).alias("size")) \
        .where(F.col("size") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    return read.join(repeated, "digest", "left")


def records(pages: DataFrame) -> DataFrame:
    """One WARC record per row of ``deduplicated``, as ``record`` without the closing two line ends."""
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    identity = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.length("payload").cast("string"), F.lit("\r\n\r\n"))
    digest = F.concat(F.lit("sha1:"), base32(F.col("digest")))
    length = F.octet_length(F.col("http")) + F.when(F.col("revisit"), F.lit(0)).otherwise(F.length("payload"))
    url = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), "[\\r\\n]", " ")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), identity("page_id"),
        F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z"),
        F.when(url != "", F.concat(F.lit("\r\nWARC-Target-URI: "), url)).otherwise(F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: "), F.col("text_digest"),
        F.when(F.col("revisit"), F.concat(
            F.lit("\r\nWARC-Refers-To: "), identity("first"),
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), length.cast("string"), F.lit("\r\n\r\n"))
    built = pages.withColumn("revisit", revisit).withColumn("http", http).withColumn("text_digest", digest)
    block = F.when(F.col("revisit"), F.lit("")).otherwise(F.col("payload").cast("string"))
    return built.select(F.concat(head, F.col("http"), block).alias("record"))


def _archives(limit: int):
    """Records as gzip members, as many to a row as come to ``limit`` bytes, one at least, without the row's last byte, which is zero.

    A member ends with the record's length in four bytes, the last of which is zero below 16 MB. A longer record is
    followed by an empty member.
    """
    def run(batches):
        members, size = [], 0
        for batch in batches:
            for record in batch.column(0):
                raw = record.as_py() + b"\r\n\r\n"
                squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
                member = squeeze.compress(raw) + squeeze.flush()
                if member[-1]:
                    member += _EMPTY
                if members and size + len(member) > limit:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)[:-1]], pa.binary())], names=["archive"])
                    members, size = [], 0
                members.append(member)
                size += len(member)
        if members:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)[:-1]], pa.binary())], names=["archive"])
    return run


def write_warc(pages: DataFrame, folder: str, least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """A WARC record per row of ``pages`` (page_id, url, html; a null html is empty) in archives under ``folder``.

    Of equal payloads of ``least`` bytes or more the smallest page_id is a response and the others are revisits that
    refer to it; rows that repeat that very page_id are responses too, and so is a row without page_id unless another
    row has the same payload. No rows: no records. Columns besides these three are not read. Every record is a gzip member of its own.
    Spark's text sink writes the files and commits them, so any file system will do and a lost task leaves nothing behind; the
    separator that it puts behind each row is the archive's last byte. An archive holds ``archive_bytes`` bytes at most, unless one
    record alone has more.
    """
    rows = records(deduplicated(pages, least)).select(F.col("record").cast("binary")).mapInArrow(_archives(archive_bytes), "archive binary")
    rows.select(F.col("archive").cast("string").alias("archive")).write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(folder)


def digest_text(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class Damaged(ValueError):
    pass


def parse_record(content: bytes, at: int) -> tuple[dict, int]:
    """Fields of the record at a place and the place behind it; raises ``Damaged`` where a check fails."""
    start = _START.match(content, at)
    if not start:
        raise Damaged("no version line")
    end = content.find(b"\r\n\r\n", start.end() - 2)
    if end < 0:
        raise Damaged("header without end")
    fields: dict[str, str] = {}
    for line in content[start.end():end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without colon")
        fields[name.strip().lower().decode("ascii", "replace")] = value.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdigit():
        raise Damaged("no content length")
    first, last = end + 4, end + 4 + int(fields["content-length"])
    if content[last:last + 4] != b"\r\n\r\n":
        raise Damaged("block does not end where it should")
    block = content[first:last]
    http, _, payload = block.partition(b"\r\n\r\n") if fields.get("content-type", "").startswith("application/http") else (b"", b"", block)
    kind = fields.get("warc-type", "")
    wanted = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if wanted and kind != "revisit" and digest_text(payload) != wanted:
        raise Damaged("payload digest differs")
    size = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)
    return {"type": kind, "record_id": fields.get("warc-record-id"), "refers_to": fields.get("warc-refers-to"),
            "url": fields.get("warc-target-uri"), "date": fields.get("warc-date"), "digest": wanted or digest_text(payload),
            "payload_bytes": int(size[1]) if kind == "revisit" and size else len(payload),
            "payload": None if kind == "revisit" else payload, "verified": bool(wanted) and kind != "revisit"}, last + 4


def _member(content: bytes, at: int) -> tuple[bytes, int, str]:
    """Bytes of the gzip member at a place, the place behind it, and what is wrong with it: then the bytes are those before the fault."""
    stream, out, first = zlib.decompressobj(31), [], at
    while not stream.eof:
        if at >= len(content):
            return b"".join(out), at, "gzip: member cut short"
        part = content[at:at + (1 << 16)]
        try:
            out.append(stream.decompress(part))
        except zlib.error as error:
            return _before_fault(content[first:at + len(part)]), at + len(part), f"gzip: {error}"
        at += len(part) - len(stream.unused_data)
    return b"".join(out), at, ""


def _before_fault(member: bytes) -> bytes:
    """All that can be decompressed up to an error. The step in which it comes up gives nothing, so steps get smaller towards it."""
    done, out = 0, b""
    for step in (1 << 12, 1 << 6, 1):
        stream = zlib.decompressobj(31)
        parts = [stream.decompress(member[:done])]
        try:
            while done < len(member):
                parts.append(stream.decompress(member[done:done + step]))
                done += step
        except zlib.error:
            pass
        out = b"".join(parts)
    return out


def _inside(content: bytes, place: int) -> tuple[list[dict], int, str, str]:
    """Records of the gzip member at a place, the place behind it, what is wrong with the member, and with what it holds.

    The records of a member are salvaged as those of a plain archive. Of a member that is damaged only those count whose payload has the digest
    that they give, as nothing else vouches for them.
    """
    inner, end, fault = _member(content, place)
    found, wrong = [], ""
    for _, _, fields, reason in salvage(inner, packed=False) if inner else ():
        if fields is None:
            wrong = wrong or reason
        elif not fault or fields["verified"]:
            found.append(fields)
    return found, end, fault, wrong


def salvage(content: bytes, packed: bool = True) -> Iterator[tuple[int, int, dict | None, str]]:
    """Start, end and fields of each sound record; for a gap that was skipped, no fields but the reason.

    Plain records and gzip members are told apart by their first bytes, so an archive may mix both. After a failed
    check the search goes on, one byte behind the start of what failed, for the next version line or member that is
    sound itself: a record that another one swallowed through a wrong length is found again. A member may hold several records, which
    have its place; what is damaged among them is one gap with that place too. Records at the beginning of a member that is cut short or
    broken are kept if their digest holds, and the rest of it is a gap. Without ``packed`` only plain records are looked for.
    """
    at = 0
    while at < len(content):
        reason, place, rows = "", at, []
        while place < len(content):
            try:
                if packed and content.startswith(_MEMBER, place):
                    found, end, fault, wrong = _inside(content, place)
                    if fault:
                        rows += [(place, end, fields, "") for fields in found]
                        raise Damaged(fault)
                    if wrong and not found:
                        raise Damaged(wrong)
                    end += len(_EMPTY) * content.startswith(_EMPTY, end)
                    sound = [(place, end, fields, "") for fields in found] + [(place, end, None, f"within a member: {wrong}")] * bool(wrong)
                else:
                    parsed, end = parse_record(content, place)
                    sound = [(place, end, parsed, "")]
                break
            except Damaged as failed:
                reason = reason or str(failed)
                plain, member = _START.search(content, place + 1), content.find(_MEMBER, place + 1) if packed else -1
                place = min((x for x in (plain.start() if plain else -1, member) if x >= 0), default=len(content))
        yield from rows
        if place > at:
            yield at, place, None, reason
        if place < len(content):
            yield from sound
            at = end
        else:
            at = place


_READ = ("archive string, start long, end long, reason string, type string, record_id string, refers_to string, url string, "
         "date string, digest string, payload_bytes long, payload binary")


def read_warc(spark: SparkSession, folder: str, pattern: str = "part-*") -> DataFrame:
    """Records and gaps of all archives in a folder: ``archive``, ``start`` and ``end`` in bytes of the archive, and the
    fields of a record, or for a quarantined gap only its ``reason``. Empty archives have neither."""
    schema = pa.schema([("archive", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reason", pa.string()), ("type", pa.string()),
                        ("record_id", pa.string()), ("refers_to", pa.string()), ("url", pa.string()), ("date", pa.string()),
                        ("digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])

    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                archive, rows, held = batch.column(0)[i].as_py(), [], 0
                for start, end, fields, reason in salvage(batch.column(1)[i].as_py()):
                    rows.append({"archive": archive, "start": start, "end": end, "reason": reason or None, **(fields or {})})
                    rows[-1].pop("verified", None)
                    held += end - start
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "content")
    return found.mapInArrow(read, _READ)


def number(identity: str) -> Column:
    """Page number in a record's identity; null if it has none."""
    return F.regexp_extract(identity, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


SQL = """
WITH page AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
digested AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS digest FROM page),
first AS (SELECT digest, min(page_id) AS first FROM digested GROUP BY digest),
spelled AS (
    SELECT digest, list_aggregate(list_transform(range(0, 32), lambda i:
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + CAST(CAST(list_aggregate(list_transform(range(0, 5), lambda b:
            ((position(digest[1 + (5 * i + b) // 4] IN '0123456789abcdef') - 1) >> (3 - (5 * i + b) % 4)) % 2 * (1 << (4 - b))), 'sum') AS INTEGER) AS INTEGER)]
        ), 'string_agg', '') AS payload_digest, first
    FROM first)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM digested JOIN spelled USING (digest)
"""


@query("op7_warc", SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_folder(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, folder).where("reason IS NULL").select(
        number("record_id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), number("refers_to").alias("refers_to"))
