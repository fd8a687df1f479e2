"""Legacy archive converter (4): ARC files, version 1 and 2, to WARC files with equivalent records.

An ARC record is a header line whose fields depend on the file's version, and as many bytes as the line declares. Its
WARC record gets a synthesised identifier, an ISO timestamp, a type, and digests of payload and block. Of records with
equal payloads one stays a response and the others become revisits of it: decided by a grouped maximum over
(digest, length), so a payload that a third of all records share is pre-aggregated.

Archives are written by Spark's text sink (records are its lines, the separator closes a record, whole files may be
gzipped) and read by its binary-file source, so any file system that Spark knows will do. A file is one task's records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from godown.session import checkpoint_dir, cut_lineage

#: Header fields by ARC version.
FIELDS = {1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
          2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
              "Filename", "Archive-length")}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIRST_DAY = datetime(2001, 1, 1, tzinfo=timezone.utc)
#: The text sink's gzip at its fastest level: a third of the time for a few hundredths more bytes.
FAST = {"zlib.compress.level": "BEST_SPEED"}
#: Records of a version block and of an ARC file, each with its version blocks.
BLOCK_RECORDS, FILE_RECORDS = 100, 5000
#: Payload bytes that go through Arrow at once.
BATCH_BYTES = 8_000_000


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _sendable(batches: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in record batches of bounded size; a row is a tuple, its size that of its byte strings."""
    rows, size = [], 0
    for r in batches:
        rows.append(r)
        size += sum(len(v) for v in r if isinstance(v, bytes)) + 200
        if size >= BATCH_BYTES:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
            rows, size = [], 0
    if rows:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _opened(content: bytes) -> io.BufferedReader:
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw, 1 << 20)


# ---- ARC ----

def arc_version_block(name: str, version: int) -> bytes:
    body = f"{version} 0 godown\n{' '.join(FIELDS[version])}\n".encode()
    return f"filedesc://{name} 0.0.0.0 {FIRST_DAY:%Y%m%d%H%M%S} text/plain {len(body)}\n".encode() + body


def arc_record(version: int, url: str, date: str, content: bytes, offset: int, name: str) -> bytes:
    head = {"URL": url, "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": "text/html", "Result-code": "200",
            "Checksum": "-", "Location": "-", "Offset": str(offset), "Filename": name, "Archive-length": str(len(content))}
    return " ".join(head[f] for f in FIELDS[version]).encode() + b"\n" + content


_ADDRESS_DATE = re.compile(r" ([0-9A-Fa-f.:]+|-) (\d{4,14}) ")


def header_fields(text: str, version: int) -> dict[str, str] | None:
    """Fields of a header line by shape: URL, address and date from the left, the others from the right, so that the URL, the
    content type and the location may hold spaces. None if the line has not the shape of the version."""
    m = _ADDRESS_DATE.search(text)
    if not m or not m.start():
        return None
    rest = text[m.end():].split(" ")
    if not re.fullmatch(r"\d{1,18}", rest[-1]):
        return None
    found = {"URL": text[:m.start()], "IP-address": m[1], "Archive-date": m[2], "Archive-length": rest[-1]}
    if version == 1:
        return found | {"Content-type": " ".join(rest[:-1])} if len(rest) > 1 else None
    code = next((k for k in range(1, len(rest) - 5) if re.fullmatch(r"\d{3}|-", rest[k])), None)
    if code is None or not rest[-3].isdecimal():
        return None
    return found | {"Content-type": " ".join(rest[:code]), "Result-code": rest[code], "Checksum": rest[code + 1],
                    "Location": " ".join(rest[code + 2:-3]), "Offset": rest[-3], "Filename": rest[-2]}


def read_arc(stream: io.BufferedReader) -> Iterator[tuple[int, dict | None, bytes, bool]]:
    """(offset, header fields, content, whole) of every record after a version block.

    The fields are those of the file's version (by shape where the version block is missing). A line that is not blank and
    no header is given too, with None for its fields. A record that is longer than the rest of the file is given as far as
    it goes, not whole. Version blocks inside a file start anew.
    """
    version, offset = None, 0
    while line := stream.readline():
        start, offset = offset, offset + len(line)
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        fields = next((f for v in ([version] if version else [2, 1]) if (f := header_fields(text, v))), None)
        if text.startswith("filedesc:") and (m := re.search(r" (\d{1,9})$", text)):
            block = stream.read(int(m[1]))
            offset += len(block)
            version = 2 if block.startswith(b"2") else 1
        elif fields:
            content = stream.read(int(fields["Archive-length"]))
            offset += len(content)
            yield start, fields, content, len(content) == int(fields["Archive-length"])
        elif text.strip():
            yield start, None, line, False


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              compression: str = "gzip") -> None:
    """Write pages as ARC files (gzipped, or plain with ``compression`` none) of at most ``FILE_RECORDS`` records. A file has
    several version blocks, of version 1 and 2 in turn.

    The payload is the page in UTF-8 (null: empty) after an HTTP head that carries the page's id (none if null). White
    space and controls in URLs are percent-encoded; a null or empty URL is '-'. An empty table leaves no record.
    """
    def run(batches):
        def records():
            number = TaskContext.get().partitionId()
            name, offset, n = f"pages-{number:05d}.arc", 0, 0
            for b in batches:
                for page, url, html in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if n % (BLOCK_RECORDS - 1) == 0:  # the block itself is a record of the sink
                        version = 1 + n // (BLOCK_RECORDS - 1) % 2
                        block = arc_version_block(name, version)
                        offset = (offset if n % (FILE_RECORDS // BLOCK_RECORDS * (BLOCK_RECORDS - 1)) else 0) + len(block) + 1
                        yield (block,)
                    n += 1
                    url = re.sub(r"[\x00-\x20\x7f-\xa0]", lambda m: "".join(f"%{c:02X}" for c in m[0].encode()), url or "") or "-"
                    body = (html or "").encode()
                    own = b"" if page is None else f"X-Page-Id: {page}\r\n".encode()
                    content = b"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + own + b"\r\n" + body
                    day = FIRST_DAY + timedelta(seconds=(page or 0) % 10**9)
                    yield (r := arc_record(version, url, f"{day:%Y%m%d%H%M%S}", content, offset, name),)
                    offset += len(r) + 1
        yield from _sendable(records(), pa.schema([("record", pa.binary())]))

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    (rows.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.mode("error").option("lineSep", "\n").option("compression", compression).option("maxRecordsPerFile", FILE_RECORDS)
     .options(**FAST).text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


ARC_SCHEMA = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("ip", pa.string()),
                        ("date", pa.string()), ("mime", pa.string()), ("head", pa.binary()), ("payload", pa.binary()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("whole", pa.bool_()),
                        ("file", pa.string()), ("offset", pa.int64()), ("unparsed", pa.binary())])
ARC_DDL = ("record_id string, page_id long, url string, ip string, date string, mime string, head binary, payload binary, "
           "payload_bytes long, payload_digest string, whole boolean, file string, offset long, unparsed binary")


def iso_date(digits: str) -> str:
    """ISO form of an ARC date of 4 to 14 digits; what is missing is the earliest, an impossible date the epoch."""
    full = digits + "00000101000000"[len(digits):]
    try:
        return f"{datetime.strptime(full, '%Y%m%d%H%M%S'):%Y-%m-%dT%H:%M:%SZ}"
    except ValueError:
        return "1970-01-01T00:00:00Z"


def _page_id(head: bytes) -> int | None:
    m = re.search(rb"(?im)^X-Page-Id: *(-?\d+)\r?$", head)
    return int(m[1]) if m else None


def arc_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record of the ARC files under ``path``; without ``payloads`` only their lengths and digests. A line that is no
    header gives a row too: its bytes are in ``unparsed`` (else null) and all but file and offset is null."""
    def run(batches):
        def records():
            for b in batches:
                for k in range(b.num_rows):
                    name = b.column(0)[k].as_py().rpartition("/")[2]
                    for offset, f, content, whole in read_arc(_opened(b.column(1)[k].as_py())):
                        if f is None:
                            yield (*[None] * 10, False, name, offset, content)
                            continue
                        end = re.search(rb"\r?\n\r?\n", content) if content.startswith(b"HTTP/") else None
                        head, payload = (content[:end.end()], content[end.end():]) if end else (b"", content)
                        sha, date = digest(payload), iso_date(f["Archive-date"])
                        record = uuid.uuid5(uuid.NAMESPACE_URL, f"{f['URL']} {date} {sha} {name} {offset}")
                        yield (f"<urn:uuid:{record}>", _page_id(head), f["URL"], f["IP-address"], date, f["Content-type"],
                               head, payload if payloads else b"", len(payload), sha, whole, name, offset, None)
        yield from _sendable(records(), ARC_SCHEMA)
    return _files(spark, path).mapInArrow(run, ARC_DDL)


# ---- WARC ----

def warc_record(kind: str, r: dict) -> bytes:
    """A record without its closing two line ends. A revisit keeps the HTTP head and leaves out the payload."""
    http = bool(r["head"])
    block = r["head"] + (b"" if kind == "revisit" else r["payload"])
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {r['record_id']}", f"WARC-Date: {r['date']}",
             f"WARC-Target-URI: {r['url']}", f"WARC-IP-Address: {r['ip']}", f"WARC-Payload-Digest: sha1:{r['payload_digest']}",
             f"WARC-Block-Digest: sha1:{digest(block)}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {r['refers_to']}"]
    if not r["whole"]:
        lines.append("WARC-Truncated: unspecified")
    lines += [f"Content-Type: {'application/http; msgtype=response' if http else r['mime']}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def read_warc(stream: io.BufferedReader) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue  # the line ends that close a record
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, stream.read(int(fields.get("content-length", 0)))


def convert(spark: SparkSession, arc_path: str, warc_path: str, least_bytes: int = 0) -> DataFrame:
    """Convert the ARC files under ``arc_path`` to gzipped WARC files under ``warc_path``; returns the lines (file, offset,
    unparsed) that are neither a header nor within a record, from the written index.

    Of records with equal payloads of at least ``least_bytes`` bytes, the one with the largest page id is a response
    (of repeated rows, the one with the largest record id; null ids come last), the others are revisits of it.
    """
    read = cut_lineage(arc_records(spark, arc_path, payloads=False).select(
        "record_id", "page_id", "payload_bytes", "payload_digest", "file", "offset", "unparsed"))
    index = read.filter("unparsed is null")
    same = ["payload_digest", "payload_bytes"]
    groups = (index.filter(F.col("payload_bytes") >= least_bytes).groupBy(same)
              .agg(F.max(F.struct("page_id", "record_id")).alias("first"), F.count("*").alias("n")).filter("n > 1")
              .select(*same, F.col("first.record_id").alias("refers_to")))
    revisits = cut_lineage(index.join(groups, same).filter("record_id != refers_to").select("record_id", "refers_to"))

    def run(batches):
        def records():
            for b in batches:
                for r in b.to_pylist():
                    yield (warc_record("revisit" if r["refers_to"] else "response", r),)
        yield from _sendable(records(), pa.schema([("record", pa.binary())]))

    joined = arc_records(spark, arc_path).filter("unparsed is null").drop("unparsed", "file", "offset").join(revisits, "record_id", "left")
    (joined.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.mode("error").option("lineSep", "\r\n\r\n").option("compression", "gzip").options(**FAST).text(warc_path))
    return read.filter("unparsed is not null").select("file", "offset", "unparsed")


def warc_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the WARC files under ``path``: page_id, payload_bytes and payload_digest of the full payload,
    record_type, refers_to, url, date, record_id, and whether the digests declared match the bytes read."""
    names = ["record_id", "record_type", "refers_id", "page_id", "url", "date", "payload_bytes", "payload_digest", "digests_match"]
    schema = pa.schema([(n, pa.int64() if n in ("page_id", "payload_bytes") else pa.bool_() if n == "digests_match" else pa.string())
                        for n in names])

    def run(batches):
        def records():
            for b in batches:
                for k in range(b.num_rows):
                    for f, block in read_warc(_opened(b.column(1)[k].as_py())):
                        end = re.search(rb"\r?\n\r?\n", block) if "application/http" in f.get("content-type", "") else None
                        payload, kind = block[end.end():] if end else block, f["warc-type"]
                        declared = f.get("warc-payload-digest", "").removeprefix("sha1:")
                        good = f.get("warc-block-digest", "") == f"sha1:{digest(block)}"
                        own = kind != "revisit"
                        sha = digest(payload) if own else declared
                        yield (f["warc-record-id"], kind, f.get("warc-refers-to"), _page_id(block[:end.end()] if end else b""),
                               f.get("warc-target-uri"), f.get("warc-date"), len(payload) if own else None, sha,
                               good and sha == declared)
        yield from _sendable(records(), schema)

    ddl = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'boolean' if f.type == pa.bool_() else 'string'}" for f in schema)
    rows = cut_lineage(_files(spark, path).mapInArrow(run, ddl))
    targets = rows.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("full_bytes"))
    return (rows.join(targets, "refers_id", "left")
            .select("page_id", F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"), "payload_digest", "record_type",
                    "refers_to", "url", "date", "record_id", "digests_match"))


def op4_arc_to_warc(spark, sf_dir: str) -> DataFrame:
    """Pages as ARC files, converted to WARC files, which are read back."""
    at = f"{checkpoint_dir(spark).rstrip('/')}/archives-{uuid.uuid4().hex}"
    write_arc(spark.read.parquet(f"{sf_dir}/pages.parquet"), f"{at}/arc")
    convert(spark, f"{at}/arc", f"{at}/warc")
    return warc_records(spark, f"{at}/warc").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                                                   "digests_match")
