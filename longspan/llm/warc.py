"""Legacy web archives: ARC files to WARC files, written, converted and read back by Spark.

An ARC record is a header line (version 1: URL, address, date, type, length; version 2 adds result code, checksum, location,
offset and file name before the length) and as many bytes as the line declares. The converter parses line and length, takes the
payload out of the HTTP message and gives each WARC record an identifier, date, type and digests that depend on the record
alone. Files are written and read as Spark text with their own separators, so any store that Spark reaches will do; they are
compressed as a whole, so a file is read by one task, in order and without holding it. A file holds what a task has: one
partition of the input.

Readers put the stream together again from the pieces that Spark cuts and take as many bytes as each record declares, so a
payload may hold anything, even the lines of another record.

A null payload is empty. A record repeats another if the SHA-256 of both payloads agree; of those, the one with the smallest
page id is the response and the others refer to it; rows that share this id, or that have no id where no other row has one, are
all responses. Short payloads are never told as repeats. Other columns take no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from longspan.llm.words import map_batches
from longspan.session import pin, scratch_path

#: Payloads of fewer bytes are stored every time.
MIN_REVISIT_BYTES = 100
#: Capture date of pages that come without one.
DATE = "19961231235959"
#: Where the streams are cut for reading; any text would do that no file ends with.
_ARC_CUT, _WARC_CUT = "\nhttp", "\r\n\r\nWARC/1.1\r\n"
_VERSIONS = {1: "1 0 spark\nURL IP-address Archive-date Content-type Archive-length\n",
             2: "2 0 spark\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"}
_DATE = re.compile(r"\d{14}")
_OPTIONS = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def arc_url(url: str | None) -> str:
    """A URL without white space and control characters, as header lines need it."""
    return quote(url or "", safe="".join(map(chr, range(0x21, 0x7F)))) or "unknown:"


def _arc(url: str, kind: str, message: bytes, date: str, version: int) -> bytes:
    extra = "" if version == 1 else "200 - - 0 pages.arc "
    return f"{url} 0.0.0.0 {date} {kind} {extra}{len(message)}\n".encode() + message


def arc_record(page_id: int | None, url: str | None, payload: str | None, date: str = DATE, version: int = 1) -> bytes:
    """One ARC record of an HTML page, without the line end between records."""
    body = (payload or "").encode()
    head = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n"
    head += f"X-Page-Id: {page_id}\r\n" if page_id is not None else ""
    return _arc(arc_url(url), "text/html", head.encode() + b"\r\n" + body, date, version)


def parse_arc_line(line: str) -> dict:
    """Fields of a header line of either version. The length is always the last field, the URL the first."""
    fields = line.split(" ")
    names = {5: ("url", "address", "date", "type", "length"),
             10: ("url", "address", "date", "type", "status", "checksum", "location", "offset", "file", "length")}.get(len(fields))
    if names is None or not fields[-1].isdigit():
        raise ValueError(f"not an ARC header line: {line[:200]!r}")
    out = dict(zip(names, fields, strict=True))
    out["length"] = int(out["length"])
    return out


def split_http(message: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields, header block with its empty line, and payload of an HTTP message; a bare payload has no header."""
    if not message.startswith(b"HTTP/"):
        return {}, b"", message
    head, mark, body = message.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    return fields, head + mark, body


def warc_date(date: str) -> str:
    """ISO form of a 14-digit date; digits that a short date lacks are those of the year's first moment."""
    digits = date if _DATE.fullmatch(date) else (re.sub(r"\D", "", date) + "19960101000000"[len(re.sub(r"\D", "", date)):])[:14]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def _urn(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def warc_record(line: dict, message: bytes, refers_to: str | None = None) -> bytes:
    """The WARC record of a parsed ARC record, without the line ends after it. A revisit keeps the HTTP header only."""
    fields, head, body = split_http(message)
    digest = hashlib.sha256(body).hexdigest()
    page = fields.get("x-page-id", "")
    kind = "revisit" if refers_to is not None else "response" if head else "resource"
    block = head if refers_to is not None else message
    out = [f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(line['url'], line['date'], page, digest)}", f"WARC-Date: {warc_date(line['date'])}",
           f"WARC-Target-URI: {line['url']}", f"WARC-IP-Address: {line['address']}",
           f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    if refers_to is not None:
        out += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {refers_to}"]
    out += [f"Content-Type: {'application/http; msgtype=response' if head else line['type']}", f"Content-Length: {len(block)}"]
    return ("\r\n".join(["WARC/1.1", *out]) + "\r\n\r\n").encode() + block


def _write(records: DataFrame, path: str, between: str) -> None:
    """One binary column, its rows on end; the cast keeps every byte."""
    records.select(F.col("record").cast("string")).write.options(lineSep=between, **_OPTIONS).text(path)


def write_arc(pages: DataFrame, path: str, *, page_id: str = "page_id", url: str = "url", payload: str = "html",
              version: int = 1) -> None:
    """The pages as gzipped ARC files, each with its version block."""
    out = pa.schema([("record", pa.binary())])

    def run(batches):
        def rows():
            first = True
            for batch in batches:
                for row in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                    if first:
                        yield (_arc("filedesc://pages.arc", "text/plain", _VERSIONS[version].encode(), DATE, version),)
                        first = False
                    yield (arc_record(*row, version=version),)
        yield from _batched(rows(), out)

    source = pages.select(F.col(page_id).cast("bigint"), F.col(url).cast("string"), F.col(payload).cast("string"))
    _write(map_batches(source, run, "record binary"), path, "\n")


class _Bytes:
    """The bytes of one archive file after another, put together from pieces of text with their file names."""

    def __init__(self, batches, cut: str):
        self.rows = ((p, f) for b in batches for p, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        self.cut, self.held, self.at, self.file, self.ahead = cut.encode(), b"", 0, None, None

    def _more(self) -> bool:
        piece, name = self.ahead or next(self.rows, (None, None))
        self.ahead = None
        if piece is None:
            return False
        if self.file is not None and name != self.file:
            self.ahead = (piece, name)
            return False
        self.held = self.held[self.at:] + (self.cut if self.file is not None else b"") + piece
        self.at, self.file = 0, name
        return True

    def next_file(self) -> bool:
        """Go on to the next file, if there is one; the one before must be used up."""
        self.file, self.held, self.at = None, b"", 0
        return self._more()

    def skip(self, ends: bytes) -> bool:
        """Pass over any of these bytes; false at the end of the file."""
        while True:
            while self.at < len(self.held) and self.held[self.at] in ends:
                self.at += 1
            if self.at < len(self.held):
                return True
            if not self._more():
                return False

    def until(self, mark: bytes) -> bytes:
        while (i := self.held.find(mark, self.at)) < 0:
            if not self._more():
                raise ValueError(f"an archive record has no end of header: {self.held[self.at:self.at + 200]!r}")
        out, self.at = self.held[self.at:i], i + len(mark)
        return out

    def take(self, n: int) -> bytes:
        parts, missing = [self.held[self.at:self.at + n]], n - (len(self.held) - self.at)
        while missing > 0:
            self.at = len(self.held)
            if not self._more():
                raise ValueError(f"an archive file ends {missing} bytes before a declared length")
            parts.append(self.held[:missing])
            missing -= len(self.held)
            n = len(parts[-1])
        self.at += n
        return b"".join(parts)


def arc_records(batches):
    """Header fields and message of every record but the version blocks."""
    stream = _Bytes(batches, _ARC_CUT)
    while stream.next_file():
        while stream.skip(b"\r\n"):
            fields = parse_arc_line(stream.until(b"\n").decode("utf-8", "replace").rstrip("\r"))
            message = stream.take(fields["length"])
            if not fields["url"].startswith("filedesc:"):
                yield fields, message


def warc_records(batches):
    """Header fields and block of every record."""
    stream = _Bytes(batches, _WARC_CUT)
    while stream.next_file():
        while stream.skip(b"\r\n"):
            lines = stream.until(b"\r\n\r\n").decode("utf-8", "replace").split("\r\n")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            yield fields, stream.take(int(fields["content-length"]))


def _stream(spark: SparkSession, path: str, cut: str) -> DataFrame:
    """The pieces of gzipped archive files; such files are never split, so a task sees its pieces in order."""
    return spark.read.option("lineSep", cut).text(path).select(F.col("value").cast("binary"), F.col("_metadata.file_path"))


def _batched(rows, schema: pa.Schema, most_bytes: int = 8 << 20):
    """Rows as record batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, (bytes, str))) + 64
        if size >= most_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def convert(spark: SparkSession, arc: str, warc: str, *, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Read ARC files and write WARC files, with repeated payloads as revisits."""
    facts = pa.schema([("page_id", pa.int64()), ("digest", pa.string()), ("urn", pa.string())])

    def look(batches):
        def rows():
            for line, message in arc_records(batches):
                fields, head, body = split_http(message)
                if head and len(body) >= min_revisit_bytes:
                    page, digest = fields.get("x-page-id", ""), hashlib.sha256(body).hexdigest()
                    yield int(page) if page else None, digest, _urn(line["url"], line["date"], page, digest)
        yield from _batched(rows(), facts)

    stream = _stream(spark, arc, _ARC_CUT)
    known = map_batches(stream, look, "page_id bigint, digest string, urn string")
    first = known.groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "urn")).alias("first"),
                                        F.count("*").alias("n")).where("n > 1")
    first = pin(first.select("digest", F.col("first.page_id").alias("first_id"), F.col("first.urn").alias("first_urn")))

    whole = pa.schema([("page_id", pa.int64()), ("digest", pa.string()), ("line", pa.string()), ("message", pa.binary())])

    def parse(batches):
        def rows():
            for line, message in arc_records(batches):
                fields, head, body = split_http(message)
                page = fields.get("x-page-id", "")
                digest = hashlib.sha256(body).hexdigest()
                yield int(page) if page else None, digest, " ".join(str(line[k]) for k in ("url", "address", "date", "type", "length")), message
        yield from _batched(rows(), whole)

    parsed = map_batches(stream, parse, "page_id bigint, digest string, line string, message binary")
    joined = parsed.join(first, "digest", "left").select(
        "line", "message", F.when(F.col("first_urn").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_urn")))

    def run(batches):
        out = pa.schema([("record", pa.binary())])

        def rows(batch):
            for line, message, refers_to in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                yield (warc_record(parse_arc_line(line), message, refers_to),)
        for batch in batches:
            yield from _batched(rows(batch), out)

    _write(map_batches(joined, run, "record binary"), warc, "\r\n\r\n")


def read_warc(spark: SparkSession, warc: str) -> DataFrame:
    """``page_id, urn, payload_bytes, payload_digest, record_type, refers_to_urn, url, date`` of each record."""
    schema = pa.schema([("page_id", pa.int64()), ("urn", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to_urn", pa.string()), ("url", pa.string()), ("date", pa.string())])

    def run(batches):
        def rows():
            for fields, block in warc_records(batches):
                http, _, body = split_http(block)
                kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
                if kind != "revisit" and hashlib.sha256(body).hexdigest() != digest:
                    raise ValueError(f"payload and digest differ: {fields['warc-record-id']}")
                size = int(http.get("content-length", len(body))) if kind == "revisit" else len(body)
                page = http.get("x-page-id")
                yield (int(page) if page else None, fields["warc-record-id"], size, digest, kind, fields.get("warc-refers-to"),
                       fields["warc-target-uri"], fields["warc-date"])
        yield from _batched(rows(), schema)

    return map_batches(_stream(spark, warc, _WARC_CUT), run, "page_id bigint, urn string, payload_bytes bigint, payload_digest string, "
                       "record_type string, refers_to_urn string, url string, date string")


def digest(pages: DataFrame) -> DataFrame:
    """The contract's columns, read from the archives that the pages were written to."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc)
    convert(spark, arc, warc)
    records = pin(read_warc(spark, warc))
    answers = records.where("record_type = 'response'").select(F.col("urn").alias("refers_to_urn"), F.col("page_id").alias("refers_to"))
    revisited = records.where("record_type = 'revisit'").select("refers_to_urn").distinct()
    answers = answers.join(revisited, "refers_to_urn", "left_semi").groupBy("refers_to_urn").agg(F.min("refers_to").alias("refers_to"))
    return records.join(answers, "refers_to_urn", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
