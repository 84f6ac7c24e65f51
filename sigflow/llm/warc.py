"""WARC archives: writing, and a reader that salvages damaged files.

Writer: each task writes gzip archives (a member per record) of bounded size
to a folder that all executors share; the table of the finished files is what
counts, so files of lost attempts are never read.

Reader: one task per file reads it as a stream. A record is checked: member
checksum, version line, headers, length, closing line ends, block digest.
After a failed check the reader searches for the next gzip member or version
line at which a record passes, goes on there, and reports the bytes between
as a gap. A gzip member is inflated as a stream and its records are salvaged
in the same way, so damage in a member costs the records it touches. What is
held is one record that passed, and of a member a bounded part: a long block
is checked ahead, in steps, before it is held.

One rule for all sizes: a record that passes its checks is given out, and it
is ``verified`` if its block digest matched or if it is the only record of a
member whose checksum matched. The only record of a damaged member is a gap.
"""

from __future__ import annotations

import base64
import contextlib
import hashlib
import itertools
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigflow.llm.common import map_rows, staged, text_or_empty
from sigflow.session import new_scratch_dir

#: Payloads shorter than this are always stored.
REVISIT_BYTES = 1000
#: Keys that the rows of one payload are dealt over.
SALTS = 16
FILE_BYTES = 64 << 20
READ_BYTES = 1 << 20
HEADER_BYTES = 1 << 16
#: Compressed bytes inflated at a time, and kept behind to search them again.
INFLATE_BYTES = 1 << 16
KEPT_BYTES = 4 << 20
#: Blocks longer than this are checked ahead before they are read.
AHEAD_BYTES = 1 << 20
#: Longer blocks cannot be a value of a row.
BLOCK_BYTES = (1 << 31) - 1
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {key}')}>"


def encode_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [*headers, ("WARC-Block-Digest", _sha1(block)), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return head.encode() + block + END


def page_record(key, url: str, payload: bytes, refers_to, date: str) -> bytes:
    """The response record of a page, or its revisit record if it refers to
    another page with the same payload. A record of a null key has no key."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(key) if key is not None else f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", date),
        # White space and control characters cannot stand in a header line.
        ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", _sha1(payload)),
    ]
    if key is not None:
        headers.append(("X-Page-ID", str(key)))
    if refers_to is not None:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page", str(refers_to))]
        payload = b""
    return encode_record(headers, http + payload)


def compressed(record: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


# ------------------------------------------------------------------ reading
class FailedCheck(Exception):
    """Why no record could be read at a place."""


@dataclass
class Record:
    offset: int
    length: int
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""
    verified: bool = False

    @property
    def payload(self) -> bytes:
        """The HTTP body, or the whole block of other records."""
        if self.headers.get("content-type", "").startswith("application/http"):
            return self.block.partition(END)[2]
        return self.block

    @property
    def http_length(self) -> int | None:
        found = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", self.block.partition(END)[0])
        return int(found[1]) if found else None


@dataclass
class Gap:
    offset: int
    length: int
    reason: str


class Stream:
    """A file that can seek, read forward, with what was not yet dropped at
    hand."""

    def __init__(self, file):
        self.file, self.data, self.start, self.ended = file, bytearray(), 0, False

    def has(self, end: int) -> bool:
        """Read on, step by step, until the byte before ``end`` is at hand;
        False if the file ends first."""
        while self.start + len(self.data) < end and not self.ended:
            part = self.file.read(READ_BYTES)
            self.ended = not part
            self.data += part
        return self.start + len(self.data) >= end

    def get(self, begin: int, end: int) -> bytes:
        self.has(end)
        return bytes(memoryview(self.data)[begin - self.start : end - self.start])

    def ahead(self, begin: int) -> Iterator[bytes]:
        """What follows ``begin``, in parts that are not kept."""
        at = self.start + len(self.data)
        for i in range(begin, at, READ_BYTES):
            yield self.get(i, min(i + READ_BYTES, at))
        if isinstance(self.file, Inflated):
            yield from self.file.ahead()
            return
        place = self.file.tell()
        try:
            while part := self.file.read(READ_BYTES):
                yield part
        finally:
            self.file.seek(place)

    def drop(self, to: int) -> None:
        del self.data[: to - self.start]
        self.start = to

    def find(self, begin: int, marks: tuple[bytes, ...]) -> int | None:
        """The first place from ``begin`` on where one of the marks stands.
        What precedes it is dropped."""
        longest = max(map(len, marks))
        while self.has(begin + 1):
            self.drop(begin)
            self.has(begin + READ_BYTES)
            places = [p for p in map(self.data.find, marks) if p >= 0]
            if places:
                return begin + min(places)
            if self.ended:
                return None
            begin += max(1, len(self.data) - longest + 1)
        return None


class Inflated:
    """The content of the gzip member at ``begin`` of a stream, as a file.
    It ends with the member or at its damage (``error``)."""

    def __init__(self, stream: Stream, begin: int):
        self.stream, self.begin, self.at = stream, begin, begin
        self.z, self.raw, self.error, self.cut = zlib.decompressobj(31), b"", "", False

    def read(self, n: int) -> bytes:
        while not self.z.eof and not self.error:
            if not self.raw:
                self.raw = self.stream.get(self.at, self.at + INFLATE_BYTES)
                if not self.raw:
                    self.error, self.cut = "the file ends inside a member", True
                    break
                self.at += len(self.raw)
                if self.at - 2 * KEPT_BYTES > self.stream.start:
                    self.stream.drop(self.at - KEPT_BYTES)
            before = self.z.copy()
            try:
                part = self.z.decompress(self.raw, n)
                self.raw = self.z.unconsumed_tail
            except zlib.error as e:
                self.error = f"bad member: {e}"
                part = _until_error(before, self.raw)
            if part:
                return part
        return b""

    def ahead(self) -> Iterator[bytes]:
        """What follows in the member, up to its end or damage."""
        z = self.z.copy()
        with contextlib.closing(self.stream.ahead(self.at)) as more:
            for raw in itertools.chain((self.raw,), more):
                while raw and not z.eof:
                    try:
                        part = z.decompress(raw, READ_BYTES)
                    except zlib.error:
                        return
                    raw = z.unconsumed_tail
                    yield part
                if z.eof:
                    return

    @property
    def end(self) -> int:
        return self.at - len(self.z.unused_data)


def _until_error(z, raw: bytes) -> bytes:
    """What ``raw`` inflates to before its damage."""
    parts = []
    try:
        for i in range(len(raw)):
            parts.append(z.decompress(raw[i : i + 1]))
    except zlib.error:
        pass
    return b"".join(parts)


def _check_ahead(stream: Stream, first: int, last: int) -> None:
    """Raise unless line ends follow the block from ``first`` to ``last``."""
    left, tail = last - first, b""
    with contextlib.closing(stream.ahead(first)) as parts:
        for part in parts:
            tail += part[left:]
            left -= min(left, len(part))
            if len(tail) >= len(END):
                break
    if tail[: len(END)] != END:
        raise FailedCheck("the block does not end where its length says")


def _parse(stream: Stream, begin: int) -> tuple[Record, int]:
    """The record at ``begin`` of a stream, and its end."""
    size = 1024
    while (end := (head := stream.get(begin, begin + size)).find(END)) < 0:
        if not head.startswith(VERSION[: len(head)]) or not head:
            raise FailedCheck("no version line")
        if len(head) < size or size >= HEADER_BYTES:
            raise FailedCheck("headers without an end")
        size *= 2
    lines = head[:end].decode("utf-8", "replace").split("\r\n")
    if not re.fullmatch(r"WARC/1\.\d", lines[0]):
        raise FailedCheck("no version line")
    headers: dict[str, str] = {}
    name = ""
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and name:
            headers[name] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        name = name.strip().lower()
        if not colon:
            raise FailedCheck("a header without a colon")
        headers[name] = value.strip()
    if not headers.get("content-length", "").isdecimal() or "warc-type" not in headers:
        raise FailedCheck("no type or length")
    # Digits beyond these need no conversion, which is bounded as well.
    size = headers["content-length"].lstrip("0")
    if len(size) > 12 or int(size or 0) > BLOCK_BYTES:
        raise FailedCheck("the length is more than a block can have")
    first = begin + end + len(END)
    last = first + int(size or 0)
    if last - first > AHEAD_BYTES:
        _check_ahead(stream, first, last)
    if stream.get(last, last + len(END)) != END:
        raise FailedCheck("the block does not end where its length says")
    block = stream.get(first, last)
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha1:") and digest != _sha1(block):
        raise FailedCheck("the block differs from its digest")
    return Record(begin, last + len(END) - begin, headers, block, digest.startswith("sha1:")), last + len(END)


def _inside(content: Inflated) -> Iterator[Record | Gap]:
    """Records and gaps of a gzip member, with the member's place. The first
    record waits for a second one or the member's end: the only record of a
    member stands or falls with it. A gap at the damage is the caller's.
    """
    inner, at, gap, reason = Stream(content), 0, None, ""
    first: Record | None = None
    many = False

    def inner_gap(to: int) -> Gap:
        return Gap(0, 0, f"{reason} ({to - gap} bytes from byte {gap} of the member's content)" if gap or inner.has(to + 1) else reason)

    def placed(*items: Record | Gap | None) -> Iterator[Record | Gap]:
        for x in items:
            if x is not None:
                x.offset, x.length = content.begin, content.end - content.begin
                yield x

    while inner.has(at + 1):
        try:
            record, end = _parse(inner, at)
        except FailedCheck as e:
            if gap is None:
                gap, reason = at, str(e)
            found = inner.find(at + 1, (VERSION,))
            if found is None:
                break
            at = found
            continue
        skipped = inner_gap(at) if gap is not None else None
        gap = None
        if many or skipped or first:
            yield from placed(first, skipped, record)
            first, many = None, True
        else:
            first = record
        at = end
        inner.drop(at)
    left = inner_gap(inner.start + len(inner.data)) if gap is not None and not content.error else None
    if first is not None and (not content.error or gap is not None):
        first.verified |= not content.error
        yield from placed(first)
    yield from placed(left)


def salvage(file) -> Iterator[Record | Gap]:
    """Records and gaps of a binary file that can seek, in order of their place. The gap of
    a damaged member follows the records that it still gave."""
    stream, at, gap, reason = Stream(file), 0, None, ""
    while stream.has(at + 1):
        failed, items, content = "", iter(()), None
        if stream.get(at, at + len(MAGIC)) == MAGIC:
            content = Inflated(stream, at)
            items = _inside(content)
        else:
            try:
                record, end = _parse(stream, at)
                items = iter((record,))
            except FailedCheck as e:
                failed = str(e)
        for x in items:
            if gap is not None:
                yield Gap(gap, at - gap, reason)
                gap = None
            yield x
        if content is not None:
            failed, end = content.error, content.end
        if failed:
            if gap is None:
                gap, reason = at, failed
            found = stream.find(max(at + 1, stream.start), (MAGIC, VERSION))
            if found is None:
                break
            at = found
            continue
        if gap is not None:
            yield Gap(gap, at - gap, reason)
            gap = None
        at = end
        stream.drop(at)
    if gap is not None:
        yield Gap(gap, stream.start + len(stream.data) - gap, reason)


# -------------------------------------------------------------------- Spark
def with_revisits(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int = REVISIT_BYTES) -> DataFrame:
    """id, url, payload (binary), refers_to: of equal payloads of ``least``
    bytes or more the one with the largest id stays, others refer to it. Rows
    that share the largest id all stay, and so do rows whose id is null if no
    other has the payload. Shorter payloads meet no shuffle; the rows of one
    payload are dealt over SALTS keys."""
    payload = text_or_empty(F.col(payload_col)).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), text_or_empty(F.col(url_col)).alias("url"), payload.alias("payload"))
    short = rows.filter(F.octet_length("payload") < least).withColumn("refers_to", F.lit(None).cast(rows.schema["id"].dataType))
    salt = F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int")
    rows = rows.filter(F.octet_length("payload") >= least).withColumn("digest", F.sha1("payload")).withColumn("salt", salt)
    stays = rows.groupBy("digest").agg(F.max("id").alias("stays"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    stays = stays.select("digest", "stays", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    found = rows.join(stays, ["digest", "salt"], "left")
    refers_to = F.when(~F.col("id").eqNullSafe(F.col("stays")), F.col("stays"))
    return found.select("id", "url", "payload", refers_to.alias("refers_to")).unionByName(short)


def write_warc(records: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write rows (id, url, payload, refers_to) as archives below ``folder``,
    a URI that the driver and all executors reach. The table of the files
    (path, bytes, records), itself written to the scratch folder."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        task = TaskContext.get()
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        name, out, size, n, k = "", None, 0, 0, 0

        def closed() -> dict:
            out.close()
            return {"path": [f"{folder}/{name}"], "bytes": [size], "records": [n]}

        for b in batches:
            for key, url, payload, refers_to in zip(b["id"], b["url"], b["payload"], b["refers_to"], strict=True):
                if out is None:
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{k:04d}.warc.gz"
                    out, k = files.open_output_stream(f"{root}/{name}", compression=None), k + 1
                    info = encode_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    data = compressed(info)
                    out.write(data)
                    size, n = len(data), 0
                data = compressed(page_record(key, url, payload, refers_to, date))
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= file_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return staged(map_rows(records, run, "path string, bytes long, records long"), "warc-files")


def list_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The files (path, bytes) below a folder."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return found.select("path", F.col("length").alias("bytes"))


def read_warc(files: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records and gaps of the files (column ``path``), one task per file:
    path, offset, length, kind (record or gap), reason (of a gap), headers
    (lower-case names), payload_bytes and payload_digest (bare lower-case
    hex) of what the file holds, http_length, verified (of a record), payload.

    Empty files have neither; a file without any valid record is one gap.
    """

    def row(path: str, x: Record | Gap) -> tuple:
        if isinstance(x, Gap):
            return path, x.offset, x.length, "gap", x.reason, None, None, None, None, None, None
        payload = x.payload
        digest = hashlib.sha1(payload).hexdigest()
        return path, x.offset, x.length, "record", None, list(x.headers.items()), len(payload), digest, x.http_length, x.verified, payload

    names = ("path", "offset", "length", "kind", "reason", "headers", "payload_bytes", "payload_digest", "http_length", "verified", "payload")

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for path in (p for b in batches for p in b["path"]):
            source, place = fs.FileSystem.from_uri(path)
            rows, size = [], 0
            with source.open_input_file(place) as file:
                for x in salvage(file):
                    rows.append(row(path, x)[: len(names) - (not with_payload)])
                    size += 500 + (x.length if isinstance(x, Gap) or not with_payload else len(x.block))
                    if size > 16 << 20:
                        yield dict(zip(names, zip(*rows, strict=True)))
                        rows, size = [], 0
            if rows:
                yield dict(zip(names, zip(*rows, strict=True)))

    schema = (
        "path string, offset long, length long, kind string, reason string, headers map<string,string>, "
        "payload_bytes long, payload_digest string, http_length long, verified boolean" + ", payload binary" * with_payload
    )
    return map_rows(files.select("path").repartition(max(1, files.count())), run, schema)


def page_records(records: DataFrame, id_type: str = "bigint") -> DataFrame:
    """The pages of records that ``write_warc`` wrote: page_id, payload_bytes
    and payload_digest of the full payload, record_type, refers_to. A revisit
    has the digest of the header and the length of its HTTP headers."""
    h = F.col("headers")
    kind = h["warc-type"]
    revisit = kind == "revisit"
    base32 = F.substring_index(h["warc-payload-digest"], ":", -1)
    return records.filter((F.col("kind") == "record") & kind.isin("response", "revisit")).select(
        h["x-page-id"].cast(id_type).alias("page_id"),
        F.when(revisit, F.col("http_length")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, base32_to_hex(base32)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        kind.alias("record_type"),
        h["x-refers-to-page"].cast(id_type).alias("refers_to"),
    )


def base32_to_hex(col):
    """A 32-character base-32 digest as 40 hexadecimal digits: 8 characters
    are 40 bits are 10 digits."""
    digits = F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789abcdefghijklmnopqrstuv")
    parts = [F.lower(F.lpad(F.conv(F.substring(digits, i, 8), 32, 16), 10, "0")) for i in (1, 9, 17, 25)]
    return F.concat(*parts)


def archive_pages(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write a record per page, read the archives back, and return per page:
    page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null payloads and urls count as empty; a page with a null id comes back
    with a null id; repeated rows are records of their own; an empty table
    gives no file and an empty result; other columns are ignored.
    """
    spark = pages.sparkSession
    folder = folder or new_scratch_dir(spark, "llm-warc")
    if "://" not in folder:
        folder = "file://" + folder.removeprefix("file:")
    kind = pages.schema[id_col].dataType.simpleString()
    files = write_warc(with_revisits(pages, id_col, url_col, payload_col), folder)
    return page_records(read_warc(files, with_payload=False), kind).withColumnRenamed("page_id", id_col)
