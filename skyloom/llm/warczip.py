"""WARC records in ZIP packages: written by partition, read back by ranges without unpacking.

A package holds ``archive/data.warc.gz`` and ``indexes/index.cdxj``, both stored, so a record's place in the
package is the place of the member plus that in the index.  Every record is a gzip member of its own.
"""

import base64
import gzip
import hashlib
import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import written
from skyloom.session import scratch

PACKAGE_BYTES = 16 << 20
MOST_TASKS = 20_000
# Fixed values of the ZIP format.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
ALL16, ALL32 = 0xFFFF, 0xFFFFFFFF


@dataclass
class Member:
    """An entry of a central directory."""

    name: str
    method: int
    size: int
    packed: int
    header: int


def typed(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Which pages are responses: of equal payloads of ``least_bytes`` or more the one with the largest page_id.

    Only digests are grouped, and maxima are formed before the shuffle; a payload that very many pages share is an
    ordinary skewed join.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"), F.sha1(payload).alias("sha1"))
    largest = rows.groupBy("sha1").agg(F.max("page_id").alias("first"))
    revisit = (F.octet_length("payload") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(largest, "sha1").select(
        "page_id", "url", "payload", "sha1", revisit.alias("revisit"), F.when(revisit, F.col("first")).alias("refers_to")
    )


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP header, with the full payload's length, and no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>"]
    if url is not None:
        fields.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%')}")
    fields += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        fields += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def package(members: list[tuple[str, bytes]]) -> bytes:
    """A ZIP file with stored members; sizes and places are always given in ZIP64 fields."""
    import zlib

    out, central = bytearray(), bytearray()
    for name, data in members:
        at, crc, raw = len(out), zlib.crc32(data), name.encode()
        sizes = struct.pack("<HHQQ", 1, 16, len(data), len(data))
        out += LOCAL + struct.pack("<HHHHHIIIHH", 45, 0x800, 0, 0, 33, crc, ALL32, ALL32, len(raw), len(sizes)) + raw + sizes + data
        extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), at)
        head = struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0x800, 0, 0, 33, crc, ALL32, ALL32, len(raw), len(extra), 0, 0, 0, 0, ALL32)
        central += CENTRAL + head + raw + extra
    start, n = len(out), len(members)
    out += central
    out += END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, len(central), start)
    out += LOCATOR64 + struct.pack("<IQI", 0, start + len(central), 1)
    out += END + struct.pack("<HHHHIIH", 0, 0, ALL16, ALL16, ALL32, ALL32, 0)
    return bytes(out)


def write_packages(records: DataFrame, folder: str, most_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write the rows of :func:`typed` into packages of about ``most_bytes`` in ``folder``; returns their paths.

    Names are random and a package is one write, so a task that runs again leaves a file nobody lists.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        data, index = bytearray(), []

        def close() -> pa.RecordBatch:
            name, n = f"{root}/{uuid.uuid4().hex}.wacz", len(index)
            lines = "".join(json.dumps(x) + "\n" for x in index).encode()
            with store.open_output_stream(name) as out:
                out.write(package([("archive/data.warc.gz", bytes(data)), ("indexes/index.cdxj", lines)]))
            data.clear()
            index.clear()
            return pa.RecordBatch.from_pydict({"package": [name], "records": [n]})

        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url", "payload", "sha1", "revisit", "refers_to")]
            for row in range(batch.num_rows):
                page_id, url, payload, sha1, revisit, refers_to = (c[row].as_py() for c in columns)
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                raw = gzip.compress(record(page_id, url, payload, digest, revisit, refers_to), 1, mtime=0)
                index.append({"offset": len(data), "length": len(raw)})
                data += raw
                if len(data) >= most_bytes:
                    yield close()
        if index:
            yield close()

    return written(records.mapInArrow(write, "package string, records long"), "packages")


def directory(file) -> list[Member]:
    """The central directory of an open ZIP file, read from its end; ZIP64 records are followed where they are there."""
    size = file.size()
    tail_at = max(0, size - 22 - ALL16 - 20)
    tail = file.read_at(size - tail_at, tail_at)
    end = tail.rfind(END)
    if end < 0:
        raise ValueError("no end of a central directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if end >= 20 and tail[end - 20 : end - 16] == LOCATOR64:
        (at,) = struct.unpack_from("<Q", tail, end - 12)
        record64 = file.read_at(56, at)
        if record64[:4] != END64:
            raise ValueError("no ZIP64 end of a central directory")
        count, length, start = struct.unpack_from("<QQQ", record64, 32)
    raw, at, found = file.read_at(length, start), 0, []
    for _ in range(count):
        if raw[at : at + 4] != CENTRAL:
            raise ValueError("no entry of a central directory")
        method, packed, full, name_n, extra_n, note_n, header = struct.unpack_from("<10xH8xIIHHH8xI", raw[at:], 0)[:7]
        name = raw[at + 46 : at + 46 + name_n].decode()
        extra = raw[at + 46 + name_n : at + 46 + name_n + extra_n]
        full, packed, header = _wide(extra, full, packed, header)
        found.append(Member(name, method, full, packed, header))
        at += 46 + name_n + extra_n + note_n
    return found


def _wide(extra: bytes, *values: int) -> list[int]:
    """Replace values that are full in 32 bits by those of the ZIP64 field, which stand there in the same order."""
    values, at = list(values), 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            inner = at + 4
            for i, value in enumerate(values):
                if value == ALL32:
                    (values[i],) = struct.unpack_from("<Q", extra, inner)
                    inner += 8
        at += 4 + size
    return values


def data_start(file, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method != 0:
        raise ValueError(f"{member.name} is not stored, so its records have no place of their own")
    head = file.read_at(30, member.header)
    if head[:4] != LOCAL:
        raise ValueError(f"no local header for {member.name}")
    name_n, extra_n = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + name_n + extra_n


def parse_record(raw: bytes) -> dict:
    """The fields of a record; of a response also its payload, which must have the digest that the record names."""
    text = gzip.decompress(raw)
    head, _, block = text.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    lengths = [line for line in http.decode().split("\r\n") if line.lower().startswith("content-length: ")]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not have its digest")
    return {
        "page_id": _page(fields["WARC-Record-ID"]),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": int(lengths[0].split(": ")[1]) if lengths else len(payload),
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": _page(fields.get("WARC-Refers-To", "")),
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_packages(packages: DataFrame, folder: str, most_bytes: int = 8 << 20) -> DataFrame:
    """All records of the packages of a table (package): directory, index, then one range for each record."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        names = [x.split()[0] for x in READ.split(", ")]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        schema = pa.schema(list(zip(names, types, strict=True)))
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, total = [], 0
                with store.open_input_file(path) as file:
                    members = {m.name: m for m in directory(file)}
                    data = data_start(file, next(m for n, m in members.items() if n.startswith("archive/")))
                    listed = next(m for n, m in members.items() if n.startswith("indexes/"))
                    lines = file.read_at(listed.size, data_start(file, listed)).decode().splitlines()
                    for entry in map(json.loads, lines):
                        raw = file.read_at(entry["length"], data + entry["offset"])
                        rows.append(parse_record(raw))
                        total += rows[-1]["payload_bytes"] + 200
                        if total >= most_bytes:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, total = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    # A fixed number of tasks: the rows are few and small, so Spark would put them all into one.
    tasks = max(1, min(packages.count(), MOST_TASKS))
    return packages.select("package").repartition(tasks).mapInArrow(read, READ)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC records into ZIP packages in the shared folder and read them back.

    Returns what the records say: page_id, url, payload_bytes, payload_digest, record_type, refers_to and, of
    responses, the payload.  A null html is an empty payload; rows that repeat the page_id and payload of a response
    are responses too; a null page_id stands below all others; a null url is left out; an empty
    table gives an empty one; other columns are not looked at.
    """
    folder = scratch(pages.sparkSession, "archives")
    return read_packages(write_packages(typed(pages, least_bytes), folder), folder)
