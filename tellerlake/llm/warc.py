"""Legacy archives to WARC: ARC headers and declared lengths in, equivalent WARC records out.

An ARC archive begins with a version block whose second line tells the version:
records of version 1 have five header fields, those of version 2 ten. Fields
are cut from the right, as only the address may hold blanks; the last one is
the length of the content that follows. From these the converter makes the
WARC record's identifier, timestamp, type and payload digest, and from the version
block a warcinfo record. Of records with equal payloads of MIN_REVISIT bytes or
more, the one with the smallest number is the response and the others revisit it.
Records of other makers have no number: they are named by address, date, place in
their archive and digest, and the earliest capture is the response.

Archives are written by Spark's text writer, a record a row with the blank
lines that end a record as separator, so every file is committed as any Spark
output is and any store will do. Files are rebalanced to Spark's advisory size;
reading takes one file at a time and follows the declared lengths.

Defined results: a null payload is empty; a null address is an address made of
the number; records without a number never become the response while another
record has one, and of pages are all responses if none has; rows that repeat the
smallest number are all responses; what a date leaves out is its least value; an
archive that is given twice gives the same records twice; an empty table gives
no record; other columns play no part. A header that cannot be read, or content
that is shorter than declared, raises.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator
from urllib.parse import quote
from uuid import UUID

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.operators.joins import on_hot_key, written
from tellerlake.sources.workspace import new_dir

MIN_REVISIT = 100
#: Fixed values of the formats.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
END_OF_RECORD = "\r\n\r\n"
NUMBER = "X-Page-Id"
#: Bytes of the payload that a revisit leaves out.
SIZE = "X-Payload-Bytes"
#: The synthetic tables have no time of capture.
CAPTURED, ADDRESS = "20260101000000", "0.0.0.0"

RECORDS = (
    "page_id long, target string, ip string, date string, block binary, payload_at int, payload_bytes long, "
    "payload_digest string, kind string, record_id string"
)
READ = (
    "page_id long, target string, date string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, kind string, record_id string, refers_to_id string"
)
#: Kind of the record that describes an archive.
ABOUT = "application/warc-fields"


def record_id(number: int | None, digest: str) -> UUID:
    """An identifier that depends only on the record, and from which its number can be read."""
    mark, low = (0, int(digest[16:32], 16)) if number is None else (1, number % 2**64)
    middle = 8 << 12 | (low >> 62) << 10 | mark << 9 | int(digest[12:15], 16) & 0x1FF
    return UUID(int=int(digest[:12], 16) << 80 | middle << 64 | 2 << 62 | low & (2**62 - 1))


def foreign_id(target: str, date: str, place: str, digest: str) -> UUID:
    """An identifier of a record without a number."""
    named = "\n".join([target, date, place, digest]).encode("utf-8", "surrogateescape")
    return record_id(None, hashlib.sha256(named).hexdigest())


def number_of(identifier: UUID) -> int | None:
    middle = identifier.int >> 64 & 0xFFFF
    if not middle >> 9 & 1:
        return None
    value = (middle >> 10 & 3) << 62 | identifier.int & (2**62 - 1)
    return value - 2**64 if value >> 63 else value


def arc_archive(records: list[tuple[str, str, str, str, bytes]], version: int, name: str) -> bytes:
    """An archive of (address, ip, 14-digit date, type, content)."""
    about = f"{version} 0 tellerlake\n{FIELDS[version]}\n".encode()

    def header(target, ip, date, kind, content, offset):
        extra = ["200", "-", "-", str(offset), name] if version == 2 else []
        return " ".join([target, ip, date, kind, *extra, str(len(content))]).encode() + b"\n"

    out = bytearray(header(f"filedesc://{name}", ADDRESS, CAPTURED, "text/plain", about, 0) + about + b"\n")
    for target, ip, date, kind, content in records:
        out += header(target, ip, date, kind, content, len(out)) + content + b"\n"
    return bytes(out)


def _plain(data: bytes) -> bytes:
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def parse_arc(data: bytes, about: bool = False) -> Iterator[tuple[str, str, str, str, bytes]]:
    """(address, ip, date, type, content) of every record of an archive, compressed or not; with ``about`` its version block first."""
    data = _plain(data)
    at, version = 0, None
    while at < len(data):
        end = data.find(b"\n", at)
        if end == at:
            at += 1
            continue
        line = data[at : end if end >= 0 else len(data)].decode("utf-8", "surrogateescape")
        if version is None:
            if not line.startswith("filedesc://") or end < 0:
                raise ValueError("an archive must begin with its version block")
            version = int(data[end + 1 : end + 2] or b"0")
            if version not in FIELDS:
                raise ValueError(f"unknown archive version {version}")
        fields = line.rsplit(" ", len(FIELDS[version].split()) - 1)
        if end < 0 or len(fields) != len(FIELDS[version].split()) or not fields[-1].isdigit():
            raise ValueError(f"bad header at byte {at}: {line[:200]!r}")
        start, size = end + 1, int(fields[-1])
        if start + size > len(data):
            raise ValueError(f"the content at byte {start} is shorter than the declared {size}")
        if about or not line.startswith("filedesc://"):
            yield fields[0], fields[1], fields[2], fields[3], data[start : start + size]
        at = start + size


def http_parts(block: bytes) -> tuple[dict[str, str], int]:
    """Header fields (names in lower case) of an HTTP response, and where its payload begins."""
    if not block.startswith(b"HTTP/"):
        return {}, 0
    end = block.find(b"\r\n\r\n")
    head = block[: end if end >= 0 else len(block)].decode("latin-1").split("\r\n")[1:]
    fields = (line.partition(":") for line in head)
    return {k.strip().lower(): v.strip() for k, _, v in fields}, end + 4 if end >= 0 else len(block)


def _iso(date: str) -> str:
    """A date of up to 14 digits; month and day that it lacks, or has as zero, are the first."""
    d = date + "00000101000000"[len(date) :]
    d = d[:4] + "".join("01" if part == "00" else part for part in (d[4:6], d[6:8])) + d[8:]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _to_arc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        waiting: dict[int, list] = {1: [], 2: []}
        for number, url, html in zip(ids, urls, batch.column(2).cast(pa.binary())):
            payload = html.as_py() or b""
            own = "" if number is None else f"{NUMBER}: {number}\r\n"
            head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n"
            target = quote(url, safe=":/?#[]@!$&'()*+,;=%~") if url else f"urn:page:{number}"
            waiting[1 + (number or 0) % 2].append((target, ADDRESS, CAPTURED, "text/html", head.encode() + payload))
        made = [arc_archive(records, version, f"v{version}.arc") for version, records in waiting.items() if records]
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["archive"])


def pages_to_arc(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """ARC archives (binary ``archive``) of both versions that hold the pages."""
    named = pages.select(F.col(f"`{id}`").cast("long"), F.col(f"`{url}`").cast("string"), F.col(f"`{html}`").cast("string"))
    return named.mapInArrow(_to_arc, "archive binary")


def _described(target: str, content: bytes) -> bytes:
    """The fields of a warcinfo record from a version block."""
    first, _, rest = content.decode("utf-8", "replace").partition("\n")
    version, _, maker = (*first.split(" ", 2), "", "")[:3]
    fields = {"description": f"converted from {target.removeprefix('filedesc://')}", "conformsTo": f"ARC/{version}"}
    fields |= {"operator": maker.strip(), "isPartOf": rest.partition("\n")[0].strip()}
    return "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v).encode()


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    kinds = [pa.int64(), *[pa.string()] * 3, pa.binary(), pa.int32(), pa.int64(), *[pa.string()] * 3]
    names = [part.split()[0] for part in RECORDS.split(", ")]
    for batch in batches:
        for archive in batch.column(0):
            rows, data = [], archive.as_py()
            mark = xxhash.xxh64_hexdigest(data)
            for at, (target, ip, date, kind, block) in enumerate(parse_arc(data, about=True)):
                if not at:
                    block, kind = _described(target, block), ABOUT
                fields, begin = http_parts(block)
                number = fields.get(NUMBER.lower())
                number = int(number) if number and number.lstrip("-").isdigit() else None
                payload = memoryview(block)[begin:]
                digest, iso = hashlib.sha256(payload).hexdigest(), _iso(date)
                named = foreign_id(target, iso, f"{mark}:{at}", digest) if number is None else record_id(number, digest)
                rows.append((number, target, ip, iso, block, begin, len(payload), digest, kind, str(named)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def convert(archives: DataFrame, column: str = "archive") -> DataFrame:
    """The records of ARC archives in a binary column, such as ``content`` of Spark's binaryFile source."""
    return archives.select(F.col(f"`{column}`")).mapInArrow(_convert, RECORDS)


def warc_record(target, ip, date, block, payload_at, digest, kind, own, response) -> bytes:
    """A WARC record without its closing blank lines; ``response`` is the identifier that a revisit refers to."""
    revisit, size = response is not None and response != own, len(block) - payload_at
    if revisit:
        block = block[:payload_at]
    http = block.startswith(b"HTTP/")
    form = "revisit" if revisit else "warcinfo" if kind == ABOUT else "response" if http else "resource"
    head = ["WARC/1.0", f"WARC-Type: {form}", f"WARC-Record-ID: <urn:uuid:{own}>", f"WARC-Date: {date}"]
    if form == "warcinfo":
        head += [f"WARC-Filename: {target.removeprefix('filedesc://')}"]
    else:
        head += [f"WARC-Target-URI: {target}", f"WARC-IP-Address: {ip}", f"WARC-Payload-Digest: sha256:{digest}"]
    head += [f"Content-Type: {'application/http;msgtype=response' if http else kind}"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:uuid:{response}>", f"WARC-Profile: {PROFILE}", f"{SIZE}: {size}"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode("utf-8", "surrogateescape") + block


def _as_string(values: list[bytes]) -> pa.Array:
    """Bytes as Spark strings, unchecked: the writer passes them on as they are."""
    return pa.array(values, pa.binary()).view(pa.string())


def write(records: DataFrame, path: str, compression: str = "gzip", unnumbered: bool = True) -> None:
    """Write converted records as WARC files below ``path``, by default compressed file by file.

    ``unnumbered``: whether among equal payloads without any number the earliest capture is revisited by the others.
    """

    def run(batches):
        for columns in batches:
            yield _as_string([warc_record(*(v.as_py() for v in row)) for row in zip(*columns)])

    run.__annotations__ = {"batches": Iterator[tuple[(pa.Array,) * 9]], "return": Iterator[pa.Array]}
    # Only what came by HTTP has a header of its own that a revisit keeps.
    large = records.where((F.col("payload_bytes") >= MIN_REVISIT) & (F.col("payload_at") > 0))
    # A number goes before none, then date, address and identifier decide.
    order = F.struct(F.col("page_id").isNull().alias("without"), "page_id", "date", "target", "record_id")
    shared = large.groupBy(F.col("payload_digest").alias("digest")).agg(F.min(order).alias("first"), F.count("*").alias("n"))
    shared = shared.where(F.lit(unnumbered) | ~F.col("first.without")).where("n > 1")
    shared = written(shared.select("digest", F.col("first.record_id").alias("response")), "warc-shared")
    described = F.col("kind") == ABOUT
    shared = shared.withColumn("http", F.lit(True))
    same = on_hot_key("payload_digest", "digest") & ((F.col("payload_at") > 0) == F.col("http"))
    placed = records.where(~described).join(shared, same, "left")
    placed = placed.unionByName(records.where(described), allowMissingColumns=True)
    made = F.arrow_udf(run, "string")(
        "target", "ip", "date", "block", "payload_at", "payload_digest", "kind", "record_id", "response"
    )
    placed.select(made.alias("record")).hint("rebalance").write.text(path, compression=compression, lineSep=END_OF_RECORD)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record of an archive, by the declared lengths."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record header at byte {at}")
        lines = data[at:end].decode("utf-8", "surrogateescape").split("\r\n")[1:]
        fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        start, size = end + 4, int(fields["content-length"])
        if data[start + size : start + size + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it declares")
        yield fields, data[start : start + size]
        at = start + size + 4


def _named(reference: str | None) -> str | None:
    return reference.strip("<>").removeprefix("urn:uuid:") if reference else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), *[pa.string()] * 3, pa.int64(), pa.int64(), *[pa.string()] * 4]
    names = [part.split()[0] for part in READ.split(", ")]
    for batch in batches:
        for content in batch.column(0):
            rows = []
            for fields, block in parse_warc(_plain(content.as_py())):
                if fields["warc-type"] == "warcinfo":
                    continue
                digest = fields["warc-payload-digest"].removeprefix("sha256:")
                http, at = http_parts(block)
                if fields["warc-type"] == "revisit":
                    size = int(fields.get(SIZE.lower()) or http.get("content-length", 0))
                else:
                    size = len(block) - at
                    if hashlib.sha256(memoryview(block)[at:]).hexdigest() != digest:
                        raise ValueError(f"the payload of {fields['warc-record-id']} is not what was archived")
                own, refers = _named(fields["warc-record-id"]), _named(fields.get("warc-refers-to"))
                number, first = number_of(UUID(own)), refers and number_of(UUID(refers))
                form, target = fields["warc-type"], fields["warc-target-uri"]
                rows.append((number, target, fields["warc-date"], form, first, size, digest, fields["content-type"], own, refers))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of the WARC files below ``path``; payloads are checked against their digests."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(_read, READ)


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Pages through ARC archives into WARC files, and those read back."""
    path = path or new_dir(pages.sparkSession, "warc")
    write(convert(pages_to_arc(pages)), path, unnumbered=False)
    return read(pages.sparkSession, path)
