"""WARC records in ZIP-packaged archives: written by Spark tasks, read back by byte ranges.

An archive is a ZIP whose members are stored, not deflated: ``archive/data.warc.gz`` (each
record its own gzip member) and ``indexes/index.cdxj`` (offset and length of each record).
Because members are stored, a record is a byte range of the ZIP itself.

*Writing.* Each task writes archives of about ``ARCHIVE_BYTES`` under names of its own to the
shared folder and returns their names; the names of successful tasks form a manifest
table, so files of lost or repeated tasks are never read.

*Reading.* One pass reads each archive's tail: end record, ZIP64 locator and record where
sizes or counts overflow, then the central directory, which gives members and indexes. Index
lines become byte ranges of about ``RANGE_BYTES``; a second pass, spread over all tasks,
reads ranges, so one large archive occupies many tasks and nothing is extracted. A WARC member that no
index covers becomes one range that is scanned record by record.

Payloads of ``MIN_REVISIT`` bytes or more that occur more than once are stored once: the row with
the largest page_id is the response, the others revisit it. Defined results: null html is an
empty payload; rows that share the largest page_id are all responses; a null page_id never is one
that others refer to; an empty table gives an empty result; other columns are not read, whatever their
names. Archives are reached through ``pyarrow.fs`` by the URI of the shared folder.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.shared import fresh_path, partitions, stored

MIN_REVISIT, ARCHIVE_BYTES, RANGE_BYTES, MAX_TAIL = 1000, 32 << 20, 4 << 20, 22 + 65535
#: Bytes given to a decompressor at once, and shares that pages with one payload are dealt to.
PIECE, SALTS = 1 << 14, 32
WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"


# ---- what to write --------------------------------------------------------------------

def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, html and refers_to: the page that holds the payload, null for responses.

    Only digests and ids are grouped; pages meet the repeated digests in one join, dealt by digest and ``SALTS`` shares
    of the page ids, so a payload with many copies is no single key; pages below ``min_bytes`` meet none.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).alias("html"))
    key = F.when(F.octet_length("html") >= min_bytes, F.sha1(F.col("html").cast("binary")))
    share = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))
    # Small pages have keys that no digest equals, so that they are dealt by themselves.
    rows = rows.withColumn("key", key).withColumn("share", share)
    repeated = (rows.filter("key is not null").groupBy("key")
                .agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n"))
                .filter("n > 1").select("key", "holder", F.explode(F.sequence(
                    F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("share")))
    rows = rows.withColumn("key", F.coalesce("key", F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))))
    return rows.join(repeated, ["key", "share"], "left").select(
        "page_id", "url", "html",
        F.when(~F.col("holder").eqNullSafe(F.col("page_id")), F.col("holder")).alias("refers_to"))


# ---- records --------------------------------------------------------------------------

def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    number = urn.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP header, with the payload's length, and no payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_urn(page_id)}", "WARC-Date: 2000-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_urn(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one record; raises where a response's payload does not have the digest it states."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {n.strip().lower(): v.strip() for n, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next((int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")),
                  len(payload))
    digest = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload in {fields['warc-record-id']}")
    refers = fields.get("warc-refers-to")
    return {"page_id": _page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "record_type": kind,
            "payload_bytes": length, "payload_digest": digest, "refers_to": _page(refers) if refers else None,
            "payload": payload if kind == "response" else None}


# ---- writing --------------------------------------------------------------------------

def _archive(warc: bytes, index: list[dict]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr(WARC_MEMBER, warc)
        z.writestr(INDEX_MEMBER, "".join(json.dumps(x) + "\n" for x in index))
        z.writestr("datapackage.json", json.dumps({"profile": "data-package", "wacz_version": "1.1.1"}))
    return out.getvalue()


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes page_id, url, html, refers_to; the manifest: name, n_records, n_bytes of each archive of this run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = fs.FileSystem.from_uri(folder)
        where.create_dir(base, recursive=True)
        held, index, size = [], [], 0

        def flush() -> pa.RecordBatch:
            name = f"pages-{uuid.uuid4().hex}.wacz"
            raw = _archive(b"".join(held), index)
            with where.open_output_stream(f"{base}/{name}") as out:
                out.write(raw)
            return pa.RecordBatch.from_pydict({"name": [name], "n_records": pa.array([len(index)], pa.int64()),
                                               "n_bytes": pa.array([len(raw)], pa.int64())})

        for batch in batches:
            for page_id, url, html, refers in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to")),
                                                  strict=True):
                one = gzip.compress(record(page_id.as_py(), url.as_py(), html.as_buffer().to_pybytes(),
                                           refers.as_py()), 6, mtime=0)
                index.append({"filename": WARC_MEMBER.rpartition("/")[2], "offset": size, "length": len(one)})
                held.append(one)
                size += len(one)
                if size >= archive_bytes:
                    yield flush()
                    held, index, size = [], [], 0
        if index:
            yield flush()

    return stored(pages.mapInArrow(run, "name string, n_records long, n_bytes long"), "manifest")


# ---- reading --------------------------------------------------------------------------

def _read(f: pa.NativeFile, at: int, n: int) -> bytes:
    f.seek(at)
    return f.read(n)


def directory(f: pa.NativeFile) -> dict[str, tuple[int, int, int]]:
    """Members by name: method, offset of the local header, stored size; from the central directory or its ZIP64 form."""
    size = f.size()
    tail = _read(f, max(0, size - MAX_TAIL), min(size, MAX_TAIL))
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack("<HLL", tail[end + 10: end + 20])
    at = max(0, size - MAX_TAIL) + end
    if (count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF) and at >= 20:
        locator = _read(f, at - 20, 20)
        if locator[:4] == b"PK\x06\x07":
            record64 = _read(f, struct.unpack("<Q", locator[8:16])[0], 56)
            if record64[:4] != b"PK\x06\x06":
                raise ValueError("damaged ZIP64 end record")
            count, length, start = struct.unpack("<QQQ", record64[32:56])
    raw, members, p = _read(f, start, length), {}, 0
    for _ in range(count):
        if raw[p: p + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        method, = struct.unpack("<H", raw[p + 10: p + 12])
        packed, plain, n_name, n_extra, n_note = struct.unpack("<LLHHH", raw[p + 20: p + 34])
        offset, = struct.unpack("<L", raw[p + 42: p + 46])
        name = raw[p + 46: p + 46 + n_name].decode("utf-8")
        extra = raw[p + 46 + n_name: p + 46 + n_name + n_extra]
        while len(extra) >= 4:
            tag, n = struct.unpack("<HH", extra[:4])
            if tag == 1:  # ZIP64: present, in this order, for the fields that overflow
                wide = list(struct.unpack(f"<{n // 8}Q", extra[4: 4 + n // 8 * 8]))
                if plain == 0xFFFFFFFF:
                    plain = wide.pop(0)
                if packed == 0xFFFFFFFF:
                    packed = wide.pop(0)
                if offset == 0xFFFFFFFF:
                    offset = wide.pop(0)
            extra = extra[4 + n:]
        members[name] = (method, offset, packed)
        p += 46 + n_name + n_extra + n_note
    return members


def data_start(f: pa.NativeFile, offset: int) -> int:
    head = _read(f, offset, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("damaged local header")
    return offset + 30 + sum(struct.unpack("<HH", head[26:30]))


def ranges(f: pa.NativeFile, range_bytes: int = RANGE_BYTES) -> list[tuple[int, int, bool]]:
    """Byte ranges of whole records (start, length, indexed); together they cover every stored WARC member."""
    members, out, spans = directory(f), [], {}
    for name, (method, offset, size) in members.items():
        if name.startswith("indexes/") and name.endswith((".cdxj", ".cdx")) and method == 0:
            for line in _read(f, data_start(f, offset), size).splitlines():
                x = json.loads(line[line.index(b"{"):])
                spans.setdefault(x["filename"], []).append((int(x["offset"]), int(x["length"])))
    for name, (method, offset, size) in members.items():
        if not (name.startswith("archive/") and name.endswith((".warc", ".warc.gz"))):
            continue
        if method:
            raise ValueError(f"{name} is not stored")
        start = data_start(f, offset)
        known = sorted(set(spans.get(name.rpartition("/")[2], [])))
        if sum(n for _, n in known) != size:
            out.append((start, size, False))
            continue
        first = total = None
        for at, n in known:
            if first is not None and total + n > range_bytes:
                out.append((start + first, total, True))
                first = None
            if first is None:
                first, total = at, 0
            total += n
        if first is not None:
            out.append((start + first, total, True))
    return out


def records(raw: bytes) -> Iterator[bytes]:
    """Records of a range: gzip members one after the other, or plain records; what is not yet read is never copied whole."""
    view, at = memoryview(raw), 0
    while at < len(raw):
        if raw[at: at + 2] == b"\x1f\x8b":
            d, out = zlib.decompressobj(31), []
            while not d.eof:
                if at >= len(raw):
                    raise ValueError("a gzip member is cut off")
                piece = view[at: at + PIECE]
                out.append(d.decompress(piece))
                at += len(piece) - len(d.unused_data)
            yield b"".join(out)
        else:
            head = raw.index(b"\r\n\r\n", at) + 4
            length = next(int(x.partition(b":")[2]) for x in raw[at: head].split(b"\r\n")
                          if x.lower().startswith(b"content-length:"))
            yield raw[at: head + length + 4]
            at = head + length + 4


RECORD = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
          "refers_to long, payload binary")
_FIELDS = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(),
           "payload_digest": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}


def read_archives(manifest: DataFrame, folder: str, range_bytes: int = RANGE_BYTES,
                  payloads: bool = True) -> DataFrame:
    """A row for each record of the archives named by ``manifest.name``."""

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                with where.open_input_file(f"{base}/{name}") as f:
                    found = ranges(f, range_bytes)
                yield pa.RecordBatch.from_pydict({
                    "name": [name] * len(found), "start": pa.array([x[0] for x in found], pa.int64()),
                    "length": pa.array([x[1] for x in found], pa.int64())})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for x in batch.to_pylist():
                with where.open_input_file(f"{base}/{x['name']}") as f:
                    raw = _read(f, x["start"], x["length"])
                rows = []
                for r in records(raw):
                    row = parse_record(r)
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[n] for r in rows], kind) for n, kind in _FIELDS.items()], names=list(_FIELDS))

    n = partitions(manifest.sparkSession)
    return (manifest.select("name").repartition(n, "name")
            .mapInArrow(located, "name string, start long, length long")
            .repartition(n, "name", "start").mapInArrow(read, RECORD))


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written to archives in the shared folder and read back, a row for each record."""
    folder = fresh_path(pages.sparkSession, "archives")
    return read_archives(write_archives(with_revisits(pages), folder), folder, payloads=False)


def digest(read: DataFrame) -> DataFrame:
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
