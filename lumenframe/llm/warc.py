"""Web archives: pages to ARC files, ARC files of either version to WARC, and WARC files back to rows.

Files are written by Spark's text sink, a record a row and a gzip member a record (bytes pass unchanged; the line separator is
an empty gzip member), and read by its binary-file source, so they may lie on any store that Spark reaches. A reader unzips as
it goes, whatever the members, and cuts records by their declared lengths only; it holds a file as stored and one record. A file
is a row of that source, so one of 2 GB or more cannot be read.

An ARC record whose content begins with an HTTP status line is a response; any other (a DNS answer, a file without headers) is a
resource of the content type that its header line states; the version block becomes the file's warcinfo.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Records and bytes of records (before compression) from which a new archive file is begun; bytes unzipped at a time.
PER_FILE, FILE_BYTES, CHUNK = 1000, 32 << 20, 64 << 10
#: Payloads from which equal ones are stored once, and repeated digests up to which their table is broadcast (about 20 MB).
LEAST_BYTES, BROADCAST_MAX = 100, 200_000
#: Effort of compression.
LEVEL = 6
# Field names of ARC's version 1 and 2, WARC's profile of a revisit.
FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length", 2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_END = b"\r\n\r\n"
UNSAFE = re.compile(r"[^\x21-\x7e]")


def version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 lumenframe\n{FIELDS[version]}\n".encode()
    head = f"filedesc://{name} 0.0.0.0 {date} text/plain" + (f" 200 - - 0 {name}" if version == 2 else "") + f" {len(body)}\n"
    return head.encode() + body


def arc_record(version: int, url: str, date: str, content: bytes, offset: int) -> bytes:
    extra = f" 200 - - {offset} -" if version == 2 else ""
    return f"{url} 0.0.0.0 {date} text/html{extra} {len(content)}\n".encode() + content


class Archive:
    """An archive file taken from the front, plain or of any number of gzip members."""

    def __init__(self, data: bytes):
        self.data, self.at, self.held, self.zipped, self.member, self.taken = memoryview(data), 0, bytearray(), data[:2] == b"\x1f\x8b", None, 0

    def more(self) -> bool:
        chunk = self.data[self.at : self.at + CHUNK]
        self.at += len(chunk)
        if not self.zipped:
            self.held += chunk
        elif chunk:
            self.member = self.member or zlib.decompressobj(31)
            self.held += self.member.decompress(chunk)
            if self.member.eof:
                self.at -= len(self.member.unused_data)
                self.member = None
        elif self.member:
            raise ValueError("a gzip member is cut short")
        return len(chunk) > 0

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more():
                raise ValueError(f"a record is cut short: {n - len(self.held)} bytes are missing")
        out = bytes(self.held[:n])
        del self.held[:n]
        self.taken += n
        return out

    def until(self, end: bytes) -> bytes | None:
        """The bytes before ``end``, which is taken too; None at the end of the file."""
        seen = 0
        while (at := self.held.find(end, max(0, seen - len(end)))) < 0:
            seen = len(self.held)
            if not self.more():
                if self.held:
                    raise ValueError(f"a record's header is cut short: {bytes(self.held[:80])!r}")
                return None
        out = self.take(at)
        self.take(len(end))
        return out

    def skip(self, end: bytes) -> None:
        """Go past all repetitions of ``end`` that come next."""
        while True:
            while len(self.held) < len(end) and self.more():
                pass
            if self.held[: len(end)] != end:
                return
            self.take(len(end))


class Fault(ValueError):
    """What is wrong with a record, and where its header line begins (in bytes of the unzipped archive)."""

    def __init__(self, offset: int, reason: str):
        super().__init__(f"{reason} (at byte {offset})")
        self.offset, self.reason = offset, reason


def parse_arc(data: bytes, faults: list[Fault] | None = None) -> Iterator[dict]:
    """The records of an archive: its version block (a record whose URL begins with ``filedesc:``), whose second line says which
    fields the header lines have, then the others; an empty file has none. Each has its fields, ``offset`` and ``content``.

    A malformed record is an error; with a list of ``faults`` it is noted there, and the archive is read on behind it where its
    header line ends with a length, else no further. A URL may hold blanks; it takes what the other fields leave.
    """
    file, names = Archive(data), FIELDS[1].split()

    def note(offset: int, reason: str) -> None:
        fault = Fault(offset, reason)
        if faults is None:
            raise fault
        faults.append(fault)

    while True:
        file.skip(b"\n")
        file.skip(b"\r\n")
        offset = file.taken
        try:
            if (line := file.until(b"\n")) is None:
                return
            head = line.rstrip(b"\r")
            if not (length := head.rsplit(b" ", 1)[-1]).isdigit():
                raise ValueError(f"a header line without a length: {head[:120]!r}")
            content = file.take(int(length))
        except (ValueError, zlib.error) as e:
            note(offset, str(e))
            return
        if head.startswith(b"filedesc:"):
            names = (content.decode("utf-8", "replace").splitlines() + ["", ""])[1].split() or names
            fields = dict(zip(FIELDS[1].split()[:4], head.split(b" "), strict=False))
        else:
            values = head.rsplit(b" ", len(names) - 1)
            fields = dict(zip(names, values, strict=True)) if len(values) == len(names) else {}
        own = {k: quoted(v) for k, v in fields.items()}
        if not re.fullmatch("[0-9]{4}([0-9]{2}){0,5}", own.get("Archive-date", "")):
            note(offset, f"a header line without the fields {' '.join(names)}: {head[:120]!r}")
            continue
        yield own | {"offset": offset, "content": content}


def quoted(raw: bytes) -> str:
    """A header field as text; bytes that are no printable ASCII are percent-encoded."""
    return "".join(chr(b) if 0x21 <= b <= 0x7E else f"%{b:02X}" for b in raw)


def parse_warc(data: bytes) -> Iterator[tuple[dict, bytes]]:
    file = Archive(data)
    while (block := file.until(WARC_END)) is not None:
        lines = block.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:80]!r}")
        head = {k: v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        yield head, file.take(int(head["Content-Length"]))
        if file.take(4) != WARC_END:
            raise ValueError("a WARC record does not end where it says")


def http(page_id, payload: bytes) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nX-Page-Id: {'' if page_id is None else page_id}\r\nContent-Length: {len(payload)}\r\n\r\n".encode()


def parted(content: bytes) -> tuple[bytes, bytes]:
    """An HTTP response's header, with the blank line that ends it, and its payload; header lines end in CRLF or LF. Without a blank
    line all is header."""
    ends = [at + len(end) for end in (WARC_END, b"\n\n") if (at := content.find(end)) >= 0]
    cut = min(ends, default=len(content))
    return content[:cut], content[cut:]


def http_field(header: bytes, name: str) -> str:
    got = re.search(rf"(?:^|\n){name}:[ \t]*([^\r\n]*)".encode(), header, re.IGNORECASE)
    return got[1].decode("utf-8", "replace").strip() if got else ""


def page_of(header: bytes) -> int | None:
    """The page that a header of ours names."""
    named = http_field(header, "X-Page-Id")
    return int(named) if re.fullmatch("-?[0-9]{1,18}", named) else None


def record_id(path: str, offset: int) -> str:
    """A name of its own for each record: its archive's path and place there, so that repeated rows have different ones."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{path}#{offset}')}>"


def warc_date(arc: str) -> str:
    """An ARC date of 4 to 14 digits; what is missing is the first month or day, or midnight."""
    d = arc + "00000101000000"[len(arc) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def zipped(record: bytes) -> bytes:
    member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return member.compress(record) + member.flush()


class Files:
    """Numbers of the files that a task's records go to, in turn."""

    def __init__(self):
        self.file, self.records, self.size = -1, PER_FILE, 0

    def place(self, size: int) -> bool:
        """Count one more record; whether it begins a file."""
        new = self.records >= PER_FILE or self.size + size > FILE_BYTES
        if new:
            self.file, self.records, self.size = self.file + 1, 0, 0
        self.records, self.size = self.records + 1, self.size + size
        return new


def written(rows: DataFrame, path: str) -> None:
    """Rows (file, value binary) as files of their numbers, a folder for each number."""
    rows.select("file", F.col("value").cast("string")).write.partitionBy("file").option("encoding", "ISO-8859-1").option("lineSep", zipped(b"").decode("latin-1")).text(path)


def members(rows: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    """Batches of (file, value), bounded in bytes, of files' numbers and records."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1])
        if size > common.BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in held], pa.int32()), pa.array([v for _, v in held], pa.binary())], names=["file", "value"])
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in held], pa.int32()), pa.array([v for _, v in held], pa.binary())], names=["file", "value"])


def write_arc(pages: DataFrame, path: str, *, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = "20240101000000", version: int | None = None) -> str:
    """A record per page; files of version 1 and 2 in turn, or of ``version`` alone.

    A null html is empty, a null url is urn:page:ID, rows that repeat are records each; no rows make no files. A file has
    PER_FILE records and about FILE_BYTES at most, or one longer record.
    """

    def run(batches):
        files, offset = Files(), 0

        def rows():
            nonlocal offset
            for batch in batches:
                for i, u, h in zip(*(batch[k].to_pylist() for k in ("page_id", "url", "html")), strict=True):
                    payload, block = h or b"", b""
                    if files.place(len(payload)):
                        own = version or 1 + files.file % 2
                        block = version_block(own, "pages.arc", date)
                        offset = len(block) + 1
                    else:
                        own = version or 1 + files.file % 2
                    u = UNSAFE.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8", "surrogatepass")), u) if u else f"urn:page:{i}"
                    record = arc_record(own, u, date, http(i, payload) + payload, offset)
                    offset += len(record) + 1
                    yield files.file, (zipped(block + b"\n") if block else b"") + zipped(record + b"\n")

        yield from members(rows())

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).cast("binary").alias("html"))
    written(rows.mapInArrow(run, "file int, value binary"), path)
    return path


def parsed(spark: SparkSession, path: str, schema: str, rows) -> DataFrame:
    """Rows that ``rows(path, data)`` makes of each archive file, plain or gzip."""
    kinds = common.arrow_schema(spark, schema)

    def run(batches):
        for batch in batches:
            for name, file in zip(batch["path"], batch["content"], strict=True):
                held, size = [], 0
                for row in rows(name.as_py(), file.as_py()):
                    held.append(row)
                    size += 500 + len(row.get("block") or b"")
                    if size > common.BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema=kinds)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=kinds)

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content").mapInArrow(run, schema)


ARC = "record_id string, kind string, page_id long, url string, ip string, date string, content_type string, payload_bytes long, digest string"
WARC = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, target_uri string, warc_date string, content_type string"


def arc_rows(path: str, data: bytes, block: bool, skip: bool) -> Iterator[dict]:
    for r in parse_arc(data, [] if skip else None):
        content, kind, page = r["content"], "resource", None
        if r["URL"].startswith("filedesc:"):
            kind, payload = "warcinfo", content
        elif content[:5] == b"HTTP/":
            kind = "response"
            header, payload = parted(content)
            page = page_of(header)
        else:
            payload = content
        out = {"record_id": record_id(path, r["offset"]), "kind": kind, "page_id": page, "url": r["URL"], "ip": r["IP-address"], "date": r["Archive-date"], "content_type": r["Content-type"], "payload_bytes": len(payload), "digest": hashlib.sha256(payload).hexdigest()}
        yield out | {"block": content} if block else out


def arc_faults(spark: SparkSession, arc: str) -> DataFrame:
    """path, offset and reason of each malformed record: all that a conversion with ``malformed="skip"`` leaves out, but for what
    lies behind a record without a length or cut short, which ends its file."""

    def rows(path: str, data: bytes) -> Iterator[dict]:
        faults: list[Fault] = []
        for _ in parse_arc(data, faults):
            pass
        return ({"path": path, "offset": f.offset, "reason": f.reason} for f in faults)

    return parsed(spark, arc, "path string, offset long, reason string", rows)


def convert(spark: SparkSession, arc: str, path: str, *, malformed: str = "raise", broadcast_max: int = BROADCAST_MAX) -> str:
    """ARC files of version 1 or 2 to WARC 1.1: identifiers, timestamps, types and digests are made from the records.

    HTTP responses become responses, other content resources of its own content type, version blocks warcinfo records. Of equal
    payloads of pages of ours (LEAST_BYTES or more) the record of the smallest page is the response, the others are revisits of
    it without the payload; rows that repeat that page stay responses, and records without a page never become one for
    others, nor are they kept as revisits of each other. A malformed record is an error, or with ``malformed="skip"`` left
    out (``arc_faults`` lists them). An archive without records gives one without records.
    """
    if malformed not in ("raise", "skip"):
        raise ValueError("malformed records are raised or skipped")
    skip = malformed == "skip"
    known = parsed(spark, arc, ARC, lambda name, data: arc_rows(name, data, False, skip))
    first = known.filter((F.col("payload_bytes") >= LEAST_BYTES) & (F.col("kind") == "response")).groupBy("digest").agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "record_id"))).alias("x"), F.count("*").alias("n"))
    first = first.filter("n > 1 and x is not null").select("digest", F.col("x.page_id").alias("first"), F.col("x.record_id").alias("first_record"))
    first = common.stored(first, "repeated")
    first = F.broadcast(first) if first.count() <= broadcast_max else first
    rows = parsed(spark, arc, f"{ARC}, block binary", lambda name, data: arc_rows(name, data, True, skip)).join(first, "digest", "left")

    def run(batches):
        files = Files()

        def records():
            for batch in batches:
                for r in batch.to_pylist():
                    record = warc_record(r)
                    files.place(len(record))
                    yield files.file, zipped(record + WARC_END)

        yield from members(records())

    written(rows.mapInArrow(run, "file int, value binary"), path)
    return path


def warc_record(r: dict) -> bytes:
    block, kind = r["block"], r["kind"]
    if kind == "warcinfo":
        told = block.decode("utf-8", "replace").splitlines() or [""]
        block = f"software: lumenframe\r\nformat: WARC File Format 1.1\r\ndescription: converted from {r['url']}, ARC {told[0]}\r\n".encode()
    elif kind == "response" and r["first"] is not None and r["page_id"] != r["first"] and r["payload_bytes"] >= LEAST_BYTES:
        kind, block = "revisit", parted(block)[0]
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {r['record_id']}", f"WARC-Date: {warc_date(r['date'])}"]
    if kind == "warcinfo":
        head += [f"WARC-Filename: {r['url'].removeprefix('filedesc://')}"]
    else:
        head += [f"WARC-Target-URI: {r['url']}", *([f"WARC-IP-Address: {r['ip']}"] if r["ip"] and r["ip"] != "-" else []), f"WARC-Payload-Digest: sha256:{r['digest']}", f"Payload-Length: {r['payload_bytes']}"]
    head += [f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {r['first_record']}", f"Refers-To-Page-Id: {r['first']}"]
    own = r["content_type"] if r["content_type"] not in (None, "", "-", "no-type") else "application/octet-stream"
    head += [f"Content-Type: {'application/warc-fields' if kind == 'warcinfo' else own if kind == 'resource' else 'application/http; msgtype=response'}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + WARC_END + block


def warc_rows(path: str, data: bytes) -> Iterator[dict]:
    """What the archive says of each record; the payload of a response or resource must have the length and the digest stated."""
    for head, block in parse_warc(data):
        if (stated := head.get("WARC-Block-Digest", "")).startswith("sha256:") and hashlib.sha256(block).hexdigest() != stated.removeprefix("sha256:"):
            raise ValueError(f"the block of {head['WARC-Record-ID']} has another digest")
        kind, header, payload = head["WARC-Type"], b"", block
        if kind in ("response", "revisit") and block[:5] == b"HTTP/":
            header, payload = parted(block)
        size, digest = head.get("Payload-Length") or (http_field(header, "Content-Length") if kind == "revisit" else ""), head.get("WARC-Payload-Digest", "")
        if kind != "revisit":
            own = hashlib.sha256(payload).hexdigest()
            if (size.isdigit() and int(size) != len(payload)) or (digest.startswith("sha256:") and digest != f"sha256:{own}"):
                raise ValueError(f"the payload of {head['WARC-Record-ID']} is not the one stated")
            size, digest = str(len(payload)), own
        refers = head.get("Refers-To-Page-Id")
        yield {"page_id": page_of(header), "payload_bytes": int(size) if size.isdigit() else None, "payload_digest": digest.removeprefix("sha256:") or None, "record_type": kind, "refers_to": int(refers) if refers else None, "record_id": head["WARC-Record-ID"], "target_uri": head.get("WARC-Target-URI"), "warc_date": head["WARC-Date"], "content_type": head.get("Content-Type")}


def read_warc(spark: SparkSession, path: str, *, info: bool = False) -> DataFrame:
    """A row per record, those of ``warcinfo`` with ``info`` only."""
    rows = parsed(spark, path, WARC, warc_rows)
    return rows if info else rows.filter("record_type <> 'warcinfo'")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    arc = write_arc(common.table(spark, sf_dir, "pages"), common.shared_dir(spark, "arc"))
    warc = convert(spark, arc, common.shared_dir(spark, "warc"))
    return read_warc(spark, warc).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
d AS (SELECT page_id, n, sha256(h) AS digest FROM p),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to FROM f"""
