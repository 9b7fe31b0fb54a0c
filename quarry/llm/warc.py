"""Legacy web archives: ARC files are read by their header lines and declared lengths and rewritten as WARC files.

An ARC file begins with a version block whose definition line names the fields of
every header line (version 1: URL, IP address, date, content type, length; version
2 adds result code, checksum, location, offset and file name). Header lines are
parsed by that definition, and exactly the declared number of bytes is taken after
each, whatever they look like. The converter makes, for every ARC record,

* ``WARC-Record-ID``: a UUID of version 5 of the ARC file's path and the record's
  number, the same in every run over the same file;
* ``WARC-Date``: the ARC date (8 to 17 digits) in ISO form;
* ``WARC-Type``: ``warcinfo`` for version blocks, ``response`` for HTTP records,
  ``resource`` for others (DNS), ``revisit`` for responses whose payload an earlier one has;
* ``WARC-Payload-Digest`` and ``WARC-Block-Digest``: base32 SHA-1.

Both kinds of archive are written and read by Spark's text files, split at ``\\n``
and gzipped (so no file is split and its lines stay in order); a lost task leaves a whole file
or none, on any file system that Spark reaches, and a task holds one record at a
time. Records are compared on length, SHA-256 and SHA-1 of the payload, narrow rows only; the rows of
revisits are joined back to the records, by broadcast if their table is small.

Defined cases: null and empty bodies are payloads of 0 bytes and count as equal; of
equal payloads the smallest id (nulls last, then the record id) is the response; rows
that repeat an id are records of their own; a null url is ``urn:none``, and
white space in a url is percent-encoded; an empty table gives archives without records and an
empty result; extra columns are ignored. A header line that does not fit its definition and
a file that ends inside a record raise.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.arrow import columns, map_batches
from quarry.llm.store import saved

#: The field names of an ARC header line by version.
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"],
}
#: Fixed value: the profile of a revisit with an identical payload (WARC 1.0).
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
NO_URL = "urn:none"
ROW_ID = "X-Row-Id"
FIRST_DATE = datetime(2004, 1, 1)
_BATCH = 4 << 20  # bytes of records per Arrow batch


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _encoded_url(url: str | None) -> bytes:
    return re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], (url or "").encode()) or NO_URL.encode()


def split_http(block: bytes) -> tuple[bytes | None, bytes]:
    """Head (with its empty line) and payload of an HTTP response; head None where it is none."""
    if not block.startswith(b"HTTP/"):
        return None, block
    end = re.search(rb"\r?\n\r?\n", block)
    return (block[:end.end()], block[end.end():]) if end else (block, b"")


def http_header(head: bytes | None, name: str) -> str | None:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head or b"")
    return found[1].decode("utf-8", "replace").strip() if found else None


def _batched(rows: Iterator[tuple], schema: pa.Schema, weight) -> Iterator[pa.RecordBatch]:
    """Batches that hold about ``_BATCH`` bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + weight(row)
        if size > _BATCH:
            yield columns(held, schema)
            held, size = [], 0
    if held:
        yield columns(held, schema)


# ------------------------------------------------------------ text files ---

def _write_records(records: DataFrame, path: str) -> None:
    """Write ``value`` (bytes) row after row, a newline after each; gzip at its fastest level."""
    (records.select(F.col("value").cast("string")).write.option("lineSep", "\n")
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path))


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"))


def _line_pairs(batches) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for piece in range(0, batch.num_rows, 4096):
            part = batch.slice(piece, 4096)
            yield from zip(part.column("file").to_pylist(), part.column("line").to_pylist())


class Record:
    """A record being read: its parsed header and the body so far."""

    def __init__(self, file: str, number: int, head: dict, length: int):
        self.file, self.number, self.head, self.need, self.parts = file, number, head, length, []

    def take(self, chunk: bytes) -> bytes:
        """Use what is still needed of ``chunk``; the rest comes back."""
        self.parts.append(chunk[:self.need])
        rest = chunk[self.need:]
        self.need -= len(self.parts[-1])
        return rest

    @property
    def block(self) -> bytes:
        return b"".join(self.parts)


def _records(pairs: Iterator[tuple[str, bytes]], begin) -> Iterator[Record]:
    """Records of files whose lines come in order.

    ``begin(state, line)`` takes the lines before a body and returns the header and the declared
    length when they are complete; ``state`` is a dict per file.
    """
    file, state, open_record, number = None, {}, None, 0
    for at, line in pairs:
        if at != file:
            if open_record is not None:
                raise ValueError(f"{file}: the file ends inside record {open_record.number}")
            file, state, number = at, {}, 0
        if open_record is None:
            started = begin(state, line)
            if started is None:
                continue
            open_record = Record(file, number, *started)
            number += 1
        else:
            rest = open_record.take(line + b"\n")
            if rest.strip():
                raise ValueError(f"{file}: record {open_record.number} is longer than declared")
        if open_record.need == 0:
            yield open_record
            open_record = None
    if open_record is not None:
        raise ValueError(f"{file}: the file ends inside record {open_record.number}")


# ------------------------------------------------------------------- ARC ---

def _definition(names: list[str]) -> re.Pattern:
    """A header line by its definition: only urls and content types may hold spaces."""
    forms = {"URL": rb"(.*)", "Content-type": rb"(.*)", "Archive-date": rb"(\d{4,17})", "Archive-length": rb"(\d+)"}
    return re.compile(b" ".join(forms.get(n, rb"(\S+)") for n in names))


def _arc_begin(state: dict, line: bytes):
    line = line.rstrip(b"\r")
    if not line:
        return None
    names = state.get("names")
    for version in [None] if names else (2, 1):  # a version block tells its version only after its header line
        fields = names or FIELDS[version]
        match = _definition(fields).fullmatch(line)
        if match:
            head = dict(zip(fields, match.groups()))
            return head, int(head["Archive-length"])
    raise ValueError(f"not an ARC header line: {line[:200]!r}")


def _arc_records(pairs) -> Iterator[Record]:
    """ARC records; a version block sets how the later header lines of its file are read."""
    states: dict = {}

    def begin(state, line):
        states["now"] = state
        return _arc_begin(state, line)

    for record in _records(pairs, begin):
        if record.head["URL"].startswith(b"filedesc://"):
            version, definition = record.block.decode("latin-1").splitlines()[:2]
            if int(version.split()[0]) not in FIELDS:
                raise ValueError(f"{record.file}: ARC version {version.split()[0]}")
            states["now"]["names"] = definition.split()
        yield record


def write_arc(pages: DataFrame, path: str, version: int, id_col: str = "page_id", url_col: str = "url",
              body_col: str = "html") -> None:
    """One ARC file per task under ``path``; the row's id is a header of the HTTP response.

    Dates are ``FIRST_DATE`` plus the id in seconds (the table has none).
    """
    names = FIELDS[version]

    def record(values: dict, block: bytes) -> bytes:
        values |= {"Archive-length": len(block)}
        return b" ".join(v if isinstance(v := values[n], bytes) else str(v).encode() for n in names) + b"\n" + block

    def run(batches):
        task, at = TaskContext.get().partitionId(), 0
        name = f"pages-v{version}-{task:06d}.arc"

        def rows():
            nonlocal at
            for batch in batches:
                parts = (batch.slice(k, 256) for k in range(0, batch.num_rows, 256))
                for ident, url, body in (row for part in parts for row in zip(*(c.to_pylist() for c in part.columns))):
                    payload = (body or "").encode()
                    moment = FIRST_DATE + timedelta(seconds=(ident or 0) % 100_000_000)
                    values = {"IP-address": "0.0.0.0", "Archive-date": moment.strftime("%Y%m%d%H%M%S"),
                              "Result-code": 200, "Checksum": "-", "Location": "-", "Filename": name}
                    if at == 0:
                        block = f"{version} 0 quarry\n{' '.join(names)}\n".encode()
                        value = record(values | {"URL": f"filedesc://{name}", "Content-type": "text/plain",
                                                 "Offset": at}, block)
                        at += len(value) + 1
                        yield (value,)
                    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n" % len(payload)
                    if ident is not None:
                        head += f"{ROW_ID}: {ident}\r\n".encode()
                    value = record(values | {"URL": _encoded_url(url), "Content-type": "text/html", "Offset": at,
                                             "Checksum": f"sha1:{base32_sha1(payload)}"}, head + b"\r\n" + payload)
                    at += len(value) + 1
                    yield (value,)

        yield from _batched(rows(), pa.schema([("value", pa.binary())]), lambda r: len(r[0]))

    narrow = pages.select(F.col(id_col).cast("long"), F.col(url_col), F.col(body_col))
    _write_records(map_batches(narrow, run, "value binary"), path)


def iso_date(digits: str) -> str:
    """``WARC-Date`` of an ARC date: missing parts are the earliest, parts of seconds are dropped."""
    d = (digits + "00000101000000"[len(digits):])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _record_id(record: Record) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record.file}#{record.number}')}>"


# -------------------------------------------------------------- converter ---

_SEEN = pa.schema([("record_id", pa.string()), ("row_id", pa.int64()), ("uri", pa.string()), ("date", pa.string()),
                   ("bytes", pa.int64()), ("sha1", pa.string()), ("sha256", pa.binary())])


def _responses(batches) -> Iterator[pa.RecordBatch]:
    def rows():
        for record in _arc_records(_line_pairs(batches)):
            head, payload = split_http(record.block)
            if head is not None:
                ident = http_header(head, ROW_ID)
                yield (_record_id(record), int(ident) if ident else None, record.head["URL"].decode("utf-8", "replace"),
                       iso_date(record.head["Archive-date"].decode()), len(payload), base32_sha1(payload),
                       hashlib.sha256(payload).digest())
    yield from _batched(rows(), _SEEN, lambda r: 200)


_BODIES = pa.schema([("record_id", pa.string()), ("uri", pa.string()), ("ip", pa.string()), ("date", pa.string()),
                     ("mime", pa.string()), ("block", pa.binary())])


def _bodies(batches) -> Iterator[pa.RecordBatch]:
    def rows():
        for record in _arc_records(_line_pairs(batches)):
            head = {k: v.decode("utf-8", "replace") for k, v in record.head.items()}
            yield (_record_id(record), head["URL"], head["IP-address"], iso_date(head["Archive-date"]),
                   head["Content-type"], record.block)
    yield from _batched(rows(), _BODIES, lambda r: len(r[5]))


def _warc_record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), *fields, ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
            ("Content-Length", str(len(block)))]
    text = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return text.encode() + block + b"\r\n\r"  # the writer adds the last newline


def _converted(batches) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for piece in range(0, batch.num_rows, 256):
                part = batch.slice(piece, 256)
                for ident, uri, ip, date, mime, block, first, first_uri, first_date in zip(
                        *(c.to_pylist() for c in part.columns)):
                    fields = [("WARC-Record-ID", ident), ("WARC-Date", date)]
                    if uri.startswith("filedesc://"):
                        yield (_warc_record("warcinfo", [*fields, ("WARC-Filename", uri.removeprefix("filedesc://")),
                                                         ("Content-Type", "application/warc-fields")],
                                            b"software: quarry\r\nformat: WARC File Format 1.0\r\n"
                                            b"conformsTo: http://bibnum.bnf.fr/WARC/WARC_ISO_28500_version1_latestdraft.pdf\r\n"),)
                        continue
                    fields += [("WARC-Target-URI", uri), ("WARC-IP-Address", ip)]
                    head, payload = split_http(block)
                    fields.append(("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"))
                    if head is None:
                        yield (_warc_record("resource", [*fields, ("Content-Type", mime)], block),)
                        continue
                    fields.append(("Content-Type", "application/http;msgtype=response"))
                    if first is None:
                        yield (_warc_record("response", fields, block),)
                    else:
                        fields += [("WARC-Profile", IDENTICAL_PAYLOAD), ("WARC-Refers-To", first),
                                   ("WARC-Refers-To-Target-URI", first_uri), ("WARC-Refers-To-Date", first_date)]
                        yield (_warc_record("revisit", fields, head),)
    yield from _batched(rows(), pa.schema([("value", pa.binary())]), lambda r: len(r[0]))


def convert(spark: SparkSession, arc_paths: list[str], warc_path: str, least_bytes: int = 0) -> None:
    """Rewrite ARC files as WARC files; payloads of ``least_bytes`` or more that repeat become revisits."""
    seen = saved(map_batches(_lines(spark, arc_paths), _responses,
                             "record_id string, row_id long, uri string, date string, bytes long, sha1 string, "
                             "sha256 binary"), "warc-seen").where(F.col("bytes") >= least_bytes)
    order = F.struct(F.col("row_id").isNull().alias("unnamed"), "row_id", "record_id", "uri", "date")
    groups = seen.groupBy("bytes", "sha256", "sha1").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = groups.where("n > 1").select("bytes", "sha256", "sha1", F.col("first.record_id").alias("first_id"),
                                            F.col("first.uri").alias("first_uri"), F.col("first.date").alias("first_date"))
    revisits = saved(seen.select("record_id", "bytes", "sha256", "sha1").join(repeated, ["bytes", "sha256", "sha1"])
                     .where("record_id <> first_id").select("record_id", "first_id", "first_uri", "first_date"),
                     "warc-revisits")
    bodies = map_batches(_lines(spark, arc_paths), _bodies,
                         "record_id string, uri string, ip string, date string, mime string, block binary")
    whole = bodies.join(revisits, "record_id", "left").select(
        "record_id", "uri", "ip", "date", "mime", "block", "first_id", "first_uri", "first_date")
    _write_records(map_batches(whole, _converted, "value binary"), warc_path)


# ------------------------------------------------------------------ reader ---

def _warc_begin(state: dict, line: bytes):
    line = line.rstrip(b"\r")
    lines = state.setdefault("lines", [])
    if not lines and not line:
        return None
    if line:
        lines.append(line.decode("utf-8", "replace"))
        return None
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:200]!r}")
    head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    state["lines"] = []
    return head, int(head["content-length"])


_READ = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("uri", pa.string()),
                   ("date", pa.string()), ("row_id", pa.int64()), ("bytes", pa.int64()), ("digest", pa.string()),
                   ("first_id", pa.string())])


def _read(batches) -> Iterator[pa.RecordBatch]:
    def rows():
        for record in _records(_line_pairs(batches), _warc_begin):
            kind, get = record.head["warc-type"], record.head.get
            if kind == "warcinfo":
                continue
            block = record.block
            head, payload = split_http(block)
            digest = get("warc-payload-digest", "").removeprefix("sha1:")
            if get("warc-block-digest") != f"sha1:{base32_sha1(block)}" or (
                    kind != "revisit" and digest != base32_sha1(payload)):
                raise ValueError(f"{record.file}: record {record.number} does not have its digest")
            ident = http_header(head, ROW_ID)
            yield (get("warc-record-id"), kind, get("warc-target-uri"), get("warc-date"), int(ident) if ident else None,
                   None if kind == "revisit" else len(payload), digest, get("warc-refers-to"))
    yield from _batched(rows(), _READ, lambda r: 200)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of WARC files, without the warcinfo records; digests are checked."""
    return map_batches(_lines(spark, [path]), _read, "record_id string, record_type string, uri string, date string, "
                                                     "row_id long, bytes long, digest string, first_id string")


def resolved(records: DataFrame) -> DataFrame:
    """Rows of :func:`read_warc` as ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``.

    A revisit has no payload: its length and the id it refers to come from the record it names.
    """
    records = saved(records, "warc-read")
    own = records.where("record_type <> 'revisit'")
    first = own.where("record_type = 'response'").select(
        F.col("record_id").alias("first_id"), F.col("row_id").alias("refers_to"), F.col("bytes").alias("first_bytes"))
    again = records.where("record_type = 'revisit'").join(first, "first_id", "left")
    names = F.col("row_id").alias("page_id"), F.col("digest").alias("payload_digest"), "record_type"
    return own.select(*names, F.col("bytes").alias("payload_bytes"), F.lit(None).cast("long").alias("refers_to")).union(
        again.select(*names, F.col("first_bytes").alias("payload_bytes"), "refers_to")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hex, sha256(body) AS full,
  first_value(page_id) OVER w AS first_id, row_number() OVER w AS k FROM p
  WINDOW w AS (PARTITION BY sha256(body) ORDER BY page_id NULLS LAST))
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN first_id END AS refers_to FROM d
"""
