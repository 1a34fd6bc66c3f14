"""WARC archives: writer with revisit records, and a salvage reader.

The writer puts one record per row, each a gzip member of its own. Of equal
payloads one is written as a response; the others revisit it. Every task
attempt writes an archive of its own name and returns a manifest row; the
manifest, written as a table, names the archives that count, so a lost
executor or repeated task leaves nothing half done.

The salvage reader checks each member (gzip's checksum, version line, lengths,
digests of known labels). After a failed check it searches for the next valid member
or version line, goes on from there, and logs the bytes between as a quarantined gap.
A member may hold any number of records; the search goes on inside it likewise.
Compressed and plain records may be mixed in one archive.

Defined cases: a null payload is an empty one; a null id is read back as null,
and is less than any other; rows that share the largest id of equal payloads
are all responses; an empty table gives no archive; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm.common import cut, open_store, shared_folder, text_of
from shopstream.session import new_run_dir

# fixed values: the format's version line, the head of a response block and the name of the revisit profile
VERSION = b"WARC/1.1\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 256 << 20  # an archive is closed beyond this size
MANIFEST = pa.schema([("archive", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])
ENTRY = ("archive string, offset long, length long, status string, reason string, record_type string, "
         "record_id string, target_uri string, refers_to string, payload_digest string, payload_bytes long, "
         "payload binary")

_GZIP = b"\x1f\x8b\x08"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_CHUNK = 1 << 20


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def digest_of(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column: 40 bits are 8 digits of base 32."""
    digits = [F.lpad(F.conv(F.substring(F.sha1(payload), 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)]
    # the digits 0-9A-V of a number to base 32, and RFC 4648's
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


# ------------------------------------------------------------------- writing
def record_id(key: int | None) -> str:
    return f"<urn:record:{'none' if key is None else key}>"


def record(kind: str, key: int | None, uri: str | None, payload: bytes, digest: str, refers_to: int | None,
           date: str) -> bytes:
    """One record as bytes; a revisit has no block."""
    block = HTTP_HEAD + payload if kind == "response" else b""
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(key)}", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if uri is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]", "", uri))
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    return VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes, level: int = 3) -> bytes:
    press = zlib.compressobj(level, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def write_archives(spark: SparkSession, pages: DataFrame, *, out_dir: str | None = None, id_col: str = "page_id",
                   uri_col: str = "url", payload_col: str = "html", least: int = 0,
                   date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write one record per row; returns the manifest (archive, bytes, records).

    Payloads of ``least`` bytes or more are deduplicated by digest.
    """
    out_dir = shared_folder(spark, out_dir or new_run_dir(spark, "llm-warc"))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{uri_col}`").cast("string").alias("uri"),
                        text_of(payload_col).alias("payload"))
    rows = rows.withColumn("digest", digest_of(F.col("payload")))
    # partial maxima in every task; only groups of two or more go on
    leaders = (rows.where(F.length("payload") >= least).groupBy("digest")
               .agg(F.max("id").alias("leader"), F.count("*").alias("n")).where("n > 1").select("digest", "leader"))
    marked = rows.join(leaders, "digest", "left").withColumn(
        "refers_to", F.when((F.length("payload") >= least) & (F.coalesce("id", F.lit(-1 << 63)) < F.col("leader")),
                            F.col("leader")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(out_dir)
        part, sink, done = TaskContext.get().partitionId(), None, []
        path, size, n = "", 0, 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                digest, key, uri, payload, refers_to = row
                if sink is None:
                    store.create_dir(folder, recursive=True)
                    path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.warc.gz"
                    sink, size, n = store.open_output_stream(path, compression=None), 0, 0
                data = _member(record("response" if refers_to is None else "revisit", key, uri, payload, digest,
                                      refers_to, date))
                sink.write(data)
                size, n = size + len(data), n + 1
                if size >= ARCHIVE_BYTES:
                    sink.close()
                    sink = done.append({"archive": f"{out_dir}/{path.rsplit('/', 1)[1]}", "bytes": size, "records": n})
        if sink is not None:
            sink.close()
            done.append({"archive": f"{out_dir}/{path.rsplit('/', 1)[1]}", "bytes": size, "records": n})
        yield pa.RecordBatch.from_pylist(done, schema=MANIFEST)

    ready = marked.select("digest", "id", "uri", "payload", "refers_to")
    return cut(spark, ready.mapInArrow(run, "archive string, bytes long, records long"), "warc-manifest")


# ------------------------------------------------------------------- reading
class _Source:
    """Random reads of an archive, and the search for the next record start."""

    def __init__(self, source, size: int):
        self.source, self.size = source, size
        self.at, self.held = 0, b""

    def source_bytes(self, at: int, length: int) -> bytes:
        if not self.at <= at or at + min(length, self.size - at) > self.at + len(self.held):
            self.source.seek(at)
            self.at, self.held = at, self.source.read(min(max(length, _CHUNK), self.size - at))
        return self.held[at - self.at:at - self.at + length]

    def next_start(self, at: int) -> int:
        """First offset from ``at`` that holds a member's magic or a version line; the size, if none."""
        while at < self.size:
            piece = self.source_bytes(at, _CHUNK)
            found = _START.search(piece)
            if found:
                return at + found.start()
            if at + len(piece) >= self.size:
                break
            at += max(1, len(piece) - 16)  # a start may lie across two pieces
        return self.size


class Damaged(Exception):
    """A record that fails a check; ``end`` is where it would stop, if its frame is sound."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.end = end


def _inflate(window: _Source, at: int) -> tuple[bytes, int]:
    """A gzip member's content and its end; its checksum is checked."""
    press, out, pos = zlib.decompressobj(31), [], at
    try:
        while not press.eof:
            piece = window.source_bytes(pos, _CHUNK)
            if not piece:
                raise Damaged("the member is cut off")
            out.append(press.decompress(piece))
            pos += len(piece)
    except zlib.error as fault:
        raise Damaged(f"gzip: {fault}") from fault
    return b"".join(out), pos - len(press.unused_data)


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``data[at:]``; raises Damaged."""
    if not _VERSION_LINE.match(data, at):
        raise Damaged("no version line")
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        raise Damaged("the header does not end")
    lines = data[at:stop].decode("utf-8", "replace").split("\r\n")[1:]
    head = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    if not head.get("content-length", "").isdigit():
        raise Damaged("no content length")
    start, length = stop + 4, int(head["content-length"])
    block = data[start:start + length]
    if len(block) < length or data[start + length:start + length + 4] != b"\r\n\r\n":
        raise Damaged("the block's length is wrong")
    end = start + length + 4
    if not all(head.get(k) for k in ("warc-type", "warc-record-id", "warc-date")):
        raise Damaged("a mandatory header is missing", end)
    if not digest_holds(head.get("warc-block-digest", ""), block):
        raise Damaged("the block's digest is wrong", end)
    if head.get("warc-type") != "revisit" and not digest_holds(
            head.get("warc-payload-digest", ""), payload_of(head, block)):
        raise Damaged("the payload's digest is wrong", end)
    return head, block, end


def digest_holds(stated: str, content: bytes) -> bool:
    """Whether a labelled digest is that of ``content``; one of an unknown label or form is not checked."""
    label, _, value = stated.rpartition(":")
    name = label.lower().replace("-", "") or "sha1"
    if name not in ("md5", "sha1", "sha256", "sha512"):
        return True
    found = hashlib.new(name, content, usedforsecurity=False).digest()
    if len(value) == 2 * len(found):
        return value.lower() == found.hex()
    plain = base64.b32encode(found).decode().rstrip("=")
    return len(value.rstrip("=")) != len(plain) or value.rstrip("=").upper() == plain


def member_records(data: bytes) -> Iterator[tuple[int, int, dict[str, str] | None, bytes, str]]:
    """(offset, length, headers, block, reason) of the records and gaps of a member's content.

    After a fault the search goes on at the next version line.
    """
    at, gap, reason = 0, None, ""
    while at < len(data):
        try:
            head, block, end = parse(data, at)
        except Damaged as fault:
            if gap is None:
                gap, reason = at, str(fault)
            found = _VERSION_LINE.search(data, at + 1)
            at = fault.end if fault.end is not None else found.start() if found else len(data)
            continue
        if gap is not None:
            yield gap, at - gap, None, b"", reason
            gap = None
        yield at, end - at, head, block, ""
        at = end
    if gap is not None:
        yield gap, len(data) - gap, None, b"", reason


def payload_of(head: dict[str, str], block: bytes) -> bytes:
    """A record's payload: of an HTTP message, what follows its head."""
    if head.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def salvage(source, size: int) -> Iterator[tuple[int, int, dict[str, str] | None, bytes, str]]:
    """(offset, length, headers, block, reason) of records, and of gaps (headers None) with their reason.

    The records of one gzip member all have its offset; its length is that of the
    first, the others have 0. A gap between them has length 0 too, and its reason
    tells its place in the member's content.
    """
    window = _Source(source, size)
    at, gap, reason = 0, None, ""
    while at < size:
        try:
            found, end = _records_at(window, at)
        except Damaged as fault:
            if gap is None:
                gap, reason = at, str(fault)
            at = fault.end if fault.end is not None else window.next_start(at + 1)
            continue
        if gap is not None:
            yield gap, at - gap, None, b"", reason
            gap = None
        length = end - at
        for head, block, why in found:
            yield at, length, head, block, why
            length = 0
        at = end
    if gap is not None:
        yield gap, size - gap, None, b"", reason


def _records_at(window: _Source, at: int) -> tuple[list[tuple[dict[str, str] | None, bytes, str]], int]:
    """(headers, block, reason) of the record at an offset, or of all records of the member there, and the end."""
    if window.source_bytes(at, 3) != _GZIP:
        head, block, end = _record_at(window, at)
        return [(head, block, "")], end
    data, end = _inflate(window, at)
    found = [(head, block, f"bytes {pos} to {pos + n} of the member: {why}" if head is None else "")
             for pos, n, head, block, why in member_records(data)]
    sound = [r for r in found if r[0] is not None]
    if not sound:
        raise Damaged(found[0][2].partition("member: ")[2] if found else "an empty member", end)
    # records first: the member's length goes to one of them
    return sound + [r for r in found if r[0] is None], end


def _record_at(window: _Source, at: int) -> tuple[dict[str, str], bytes, int]:
    length = 1 << 16
    while True:
        data = window.source_bytes(at, length)
        try:
            head, block, used = parse(data)
            return head, block, at + used
        except Damaged as fault:
            wanted = _wanted(data)
            if fault.end is not None:
                raise Damaged(str(fault), at + fault.end) from fault
            if len(data) < length or not _VERSION_LINE.match(data) or wanted is not None and wanted <= length:
                raise
            length = min(max(2 * length, wanted or 0), window.size - at)


def _wanted(data: bytes) -> int | None:
    """Length that a plain record's header announces, if it can be read."""
    stop = data.find(b"\r\n\r\n")
    found = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)\r\n", data[:stop + 2]) if stop >= 0 else None
    return stop + 8 + int(found[1]) if found else None


def read_archives(spark: SparkSession, manifest: DataFrame, *, payloads: bool = True) -> DataFrame:
    """Records (status ``ok``) and quarantined gaps (status ``gap``) of all archives; one task reads an archive.

    Offsets and lengths are in bytes of the archive. Without ``payloads`` the
    payload is null, but still read and checked.
    """
    schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                        ("status", pa.string()), ("reason", pa.string()), ("record_type", pa.string()),
                        ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
                        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])

    def entry(name: str, found) -> dict:
        offset, length, head, block, reason = found
        row = {"archive": name, "offset": offset, "length": length, "status": "gap" if head is None else "ok",
               "reason": reason or None}
        if head is not None:
            kind = "revisit" if head.get("warc-type") == "revisit" else "response"
            body = payload_of(head, block)
            digest = base32_sha1(body) if kind == "response" else head.get("warc-payload-digest", "").removeprefix("sha1:")
            row |= {"record_type": kind, "record_id": head.get("warc-record-id"), "target_uri": head.get("warc-target-uri"),
                    "refers_to": head.get("warc-refers-to"), "payload_digest": digest,
                    "payload_bytes": len(body) if kind == "response" else None,
                    "payload": body if payloads and kind == "response" else None}
        return row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in batch.to_pylist():
                store, path = open_store(a["archive"])
                with store.open_input_file(path) as source:
                    held, size = [], 0
                    for found in salvage(source, a["bytes"]):
                        held.append(entry(a["archive"], found))
                        size += 200 + len(held[-1].get("payload") or b"")
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    listed = manifest.select("archive", "bytes")
    # a stated number of partitions: the names are so short that adaptive execution would merge them into one task
    return listed.repartitionByRange(max(1, listed.count()), "archive").mapInArrow(run, ENTRY)


def key_of(record_id_column: Column) -> Column:
    """The key that ``record_id`` wrote."""
    return F.regexp_extract(record_id_column, r"^<urn:record:(-?\d+)>$", 1).try_cast("long")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Records with the payload length of a revisit taken from the response of its digest."""
    responses = records.where("record_type = 'response'").groupBy("payload_digest").agg(
        F.max("payload_bytes").alias("response_bytes"))
    first = records.where("record_type = 'response'")
    revisits = records.where("record_type = 'revisit'").join(responses, "payload_digest", "left")
    revisits = revisits.withColumn("payload_bytes", F.col("response_bytes")).select(first.columns)
    return first.unionByName(revisits)
