"""WARC archives: a writer in DataFrame functions and a reader that salvages damaged files."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.llm.common import LOWEST, slices

#: RFC 4648.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ = "file string, kind string, start long, stop long, reason string, record_id string, type string, uri string, refers_to string, payload_bytes long, payload_digest string, payload binary"
#: Bytes that are inflated at a time, at most.
PIECE = 1 << 20
#: A gzip member of nothing: what Spark's writer puts behind each record's own member.
EMPTY = gzip.compress(b"", mtime=0)


def base32_sha1(data: Column) -> Column:
    """SHA-1 in upper-case base32: 160 bits are 8 groups of 5 hex digits, each of 4 base32 digits."""
    digest = F.sha1(data)
    out = []
    for g in range(8):
        bits = F.conv(F.substring(digest, 5 * g + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def write_archive(
    pages: DataFrame,
    path: str,
    min_revisit_bytes: int = 0,
    date: str = "2000-01-01T00:00:00Z",
    compression: str = "gzip",
    records_per_file: int = 2000,
    file_bytes: int = 256 << 20,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
) -> None:
    """Writes a WARC/1.1 record per row of `pages` under `path`, by Spark's own committed file writer.

    Of records with equal payloads of at least `min_revisit_bytes` the one with the
    smallest id is a response and the others are revisits of it, which carry no payload;
    shorter payloads are all responses.  Equality is by SHA-256.  Which page a row
    revisits is found on ids and digests alone; payloads are shuffled once, by id, so a
    large group of copies is spread over all tasks.

    With "gzip" each record is a gzip member of its own, so that damage costs one record.
    Spark's text sink writes the members as they are and an empty member as the separator
    between them, which readers of gzip skip; the files have no suffix of gzip.  A file
    holds at most `records_per_file` records and `file_bytes`, but for its last record: a
    long record is followed by as many empty rows as its bytes count for.  With "none"
    records are plain and files are bounded by `records_per_file` alone.

    Edge cases: a null payload is the empty one; a null url has no target line; a missing
    id comes before all others; repeated rows of the first page are all responses.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("key", F.unhex(F.sha2("payload", 256)))
    small = rows.select("id", "key").distinct()
    first = small.groupBy("key").agg(F.min("id").alias("first_id"))
    decided = small.join(first, "key").where("id <> first_id").select("id", "key", "first_id")
    rows = rows.join(decided, ["id", "key"], "left")
    length = F.octet_length("payload")
    revisit = F.col("first_id").isNotNull() & (length >= min_revisit_bytes)
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.when(c != LOWEST, c.cast("string")).otherwise(""), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), length.cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", F.translate("url", "\r\n", "")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn(F.col("first_id"))), line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(""),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
        F.col("block"),
        F.lit("\r\n\r"),  # the last line feed follows: as the writer's separator, or in the member
    )
    plain = rows.withColumn("block", block).select(record.alias("value"))
    if compression == "none":
        plain.write.option("lineSep", "\n").option("maxRecordsPerFile", records_per_file).text(path)
        return
    share = max(1, file_bytes // records_per_file)

    def members(batches):
        for batch in slices(batches, 64):
            out: list[bytes] = []
            for value in batch.column(0):
                out.append(gzip.compress(value.as_py() + b"\n", 6, mtime=0))
                out += [b""] * (len(out[-1]) // share)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    zipped = plain.select(F.col("value").cast("binary")).mapInArrow(members, "value binary")
    zipped.select(F.col("value").cast("string")).write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY.decode("ISO-8859-1")).option(
        "maxRecordsPerFile", records_per_file
    ).text(path)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


_VERSION = re.compile(rb"(?:\A|(?<=\n))WARC/1\.[01]\r\n")
_VERSION_HERE = re.compile(rb"WARC/1\.[01]\r\n")


def _record(buf: bytes | bytearray, at: int, final: bool) -> tuple[int, dict | str] | None:
    """The record that begins at `at`: (its end, fields), or (where to search on, what is wrong); None: more bytes are needed."""
    m = _VERSION_HERE.match(buf, at)
    if not m:
        if not final and len(buf) - at < 10:
            return None
        return at, "no version line"
    # A header of any length ends at its empty line, or is broken where another version line comes first.
    cut = buf.find(b"\r\n\r\n", m.end())
    later = _VERSION.search(buf, m.end(), cut if cut >= 0 else len(buf))
    if cut < 0 or later:
        return None if not final and not later else (at + 1, "header does not end")
    head = {}
    for row in bytes(buf[m.end() : cut]).split(b"\r\n"):
        name, colon, value = row.partition(b":")
        if not colon:
            return at + 1, "malformed header line"
        head[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    size = head.get(b"content-length", "")
    if not size.isascii() or not size.isdigit():
        return at + 1, "no valid Content-Length"
    begin, end = cut + 4, cut + 4 + int(size)
    if end + 4 > len(buf):
        return None if not final else (at + 1, "block is cut short")
    if buf[end : end + 4] != b"\r\n\r\n":
        return at + 1, "block does not end where Content-Length says"
    # From here the frame is sound: a failed check quarantines just this record.
    block = bytes(memoryview(buf)[begin:end])
    if (want := head.get(b"warc-block-digest", "")).startswith("sha1:") and want[5:] != sha1_base32(block):
        return end + 4, "block digest differs"
    payload, length, kind = block, len(block), head.get(b"warc-type", "")
    if b"msgtype=response" in head.get(b"content-type", "").encode() and (split := block.find(b"\r\n\r\n")) >= 0:
        payload = block[split + 4 :]
        length = len(payload)
        if kind == "revisit" and (n := re.search(rb"(?i)\r\ncontent-length: *(\d+)", block[:split])):
            length = int(n[1])
    digest = head.get(b"warc-payload-digest", "").removeprefix("sha1:")
    if kind != "revisit":
        if digest and digest != sha1_base32(payload):
            return end + 4, "payload digest differs"
        digest = sha1_base32(payload)
    return end + 4, {
        "record_id": head.get(b"warc-record-id"),
        "type": kind,
        "uri": head.get(b"warc-target-uri"),
        "refers_to": head.get(b"warc-refers-to"),
        "payload_bytes": length,
        "payload_digest": digest or None,
        "payload": None if kind == "revisit" else payload,
    }


def _plain(buf: bytes | bytearray, base: int, final: bool) -> tuple[list[tuple], int]:
    """Records and gaps of uncompressed bytes, and how many bytes are done with."""
    out, at = [], 0
    while at < len(buf):
        got = _record(buf, at, final)
        if got is None:
            break
        end, found = got
        if isinstance(found, dict):
            out.append(("record", base + at, base + end, "", found))
            at = end
            continue
        if end <= at + 1:  # no sound frame: the next version line is searched for
            m = _VERSION.search(buf, at + 1)
            end = m.start() if m else len(buf)
            if not m and not final:
                break
        out.append(("gap", base + at, base + end, found, {}))
        at = end
    return out, at


def _member(data: bytes, at: int) -> tuple[int | None, list[tuple], str]:
    """One gzip member from `at`: (where it ends, or None if it is damaged; its records and gaps; what is wrong)."""
    z, buf, out, base, pos, size = zlib.decompressobj(31), bytearray(), [], 0, at, 4096
    error, rest, need = "", b"", 0
    while not z.eof and (rest or pos < len(data)):
        if not rest:
            rest = data[pos : pos + size]
            pos += len(rest)
            size = min(4 * size, PIECE)
        try:
            buf += z.decompress(rest, PIECE)
        except zlib.error as e:
            error = str(e)
            break
        rest = z.unconsumed_tail
        if len(buf) >= need:
            found, done = _plain(buf, base, False)
            out += found
            del buf[:done]
            base += done
            need = 2 * len(buf)  # a long record is looked at again when twice as much of it is there
    ended = z.eof and not error
    found, _ = _plain(buf, base, True)
    out += found
    return (pos - len(z.unused_data) if ended else None), out, error or ("" if ended else "member is cut short")


def salvage(data: bytes) -> Iterator[tuple]:
    """(kind, start, stop, reason, fields) of an archive, plain or of gzip members, damaged or not.

    Offsets are those of the file; records and gaps inside a gzip member have the member's
    offsets if it is sound.  After a failed check the next gzip member that inflates, or
    the next version line, is searched for, and the bytes between are logged as a gap.
    What a damaged member yields before its damage is kept where its own checks hold.
    """
    at, gap = 0, None
    while at < len(data):
        if data[at : at + 3] == b"\x1f\x8b\x08":
            stop, found, error = _member(data, at)
            good = [x for x in found if x[0] == "record"]
            if stop is not None and (good or not found):
                if gap is not None:
                    yield "gap", gap, at, "not a member or a version line", {}
                    gap = None
                for kind, _, _, reason, fields in found:
                    yield kind, at, stop, reason, fields
                at = stop
                continue
            for kind, _, _, reason, fields in good:  # damaged, but these came whole
                yield kind, at, at, reason, fields
            gap = at if gap is None else gap
        elif _VERSION_HERE.match(data, at):
            if gap is not None:
                yield "gap", gap, at, "not a member or a version line", {}
                gap = None
            # A sound frame is followed by its Content-Length, whatever bytes its block has.
            end, fields = _record(data, at, True)
            if isinstance(fields, dict):
                yield "record", at, end, "", fields
            else:  # else the next version line or gzip member that inflates is searched for
                if end <= at + 1:
                    version = _VERSION.search(data, at + 1)
                    end = version.start() if version else len(data)
                    nxt = data.find(b"\x1f\x8b\x08", at, end)
                    while nxt >= 0 and zlib_fails(data, nxt):
                        nxt = data.find(b"\x1f\x8b\x08", nxt + 1, end)
                    end = nxt if nxt >= 0 else end
                yield "gap", at, end, fields, {}
            at = end
            continue
        else:
            gap = at if gap is None else gap
        member = data.find(b"\x1f\x8b\x08", at + 1)
        end = member if member >= 0 else len(data)
        version = _VERSION.search(data, at + 1, end + 10)  # one that begins before the member
        at = version.start() if version and version.start() < end else end
    if gap is not None:
        yield "gap", gap, len(data), "not a member or a version line", {}


def zlib_fails(data: bytes, at: int) -> bool:
    """Whether no sound start of a gzip member is at `at`."""
    try:
        return not zlib.decompressobj(31).decompress(data[at : at + 4096], 64)
    except zlib.error:
        return True


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records and quarantined gaps of the archives under `path` (columns of READ; kind is record or gap).

    Each file is read whole by one task, so it must stay below the 2 GB of Spark's binary
    reader (`write_archive` bounds its files); a damaged file never fails the job.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        names = [f.split()[0] for f in READ.split(", ")]
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                rows, size = [], 0
                for kind, start, stop, reason, fields in salvage(content.as_py()):
                    if not with_payload:
                        fields.pop("payload", None)
                    size += len(fields.get("payload") or b"")
                    rows.append({"file": name.as_py(), "kind": kind, "start": start, "stop": stop, "reason": reason} | fields)
                    if len(rows) >= 2000 or size > 16 * PIECE:
                        yield _batch(rows, names)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names)

    return files.mapInArrow(run, READ)


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    kinds = {"start": pa.int64(), "stop": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in names], names=names)


def page_records(records: DataFrame) -> DataFrame:
    """Per record that `write_archive` wrote: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Edge cases: gaps have no row; a record whose id is not a page's has a NULL page_id, and
    a response a NULL refers_to; repeated records stay.
    """
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:page:(-?[0-9]+)>', 1) as bigint)")
    return records.where("kind = 'record'").select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), page("refers_to").alias("refers_to")
    )
