"""WARC archives of pages, with revisits, segmented records and chunked framing.

Writing: of equal payloads one record is the response, the others are revisits of it. A response
block longer than a segment is cut into continuation records. Each record is a gzip member.
Reading: pieces of records are grouped by origin identifier, ordered by segment number, joined,
checked against the total length, and freed from chunked transfer framing.

Rows reach a task sorted, so a task that runs again writes the same bytes under the same names.
Defined results: a null payload is empty; a null URL is written as an empty one; null page ids
sort below all others and are never preferred as response; rows equal in id and payload to the
response are responses themselves. A record that is damaged, misses a segment, or fails its
total length or digest keeps its row, with the fault in ``problem`` and no payload; a member or
record that cannot be read at all gives one such row without an id, and reading goes on with the
next. No pages give an archive without records; other columns of the pages have no effect.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from contextlib import suppress
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import attach, put_file, stored

SEGMENT = 32 * 1024
CHUNK = 8 * 1024
FILE_BYTES = 16 * 1024 * 1024
STEP = 8 * 1024
DATE = "2024-01-01T00:00:00Z"

_PIECE = pa.schema(
    [("origin", pa.string()), ("number", pa.int32()), ("last", pa.bool_()), ("total", pa.int64()),
     ("type", pa.string()), ("record_id", pa.string()), ("uri", pa.string()), ("refers_to", pa.string()),
     ("digest", pa.string()), ("block", pa.binary()), ("problem", pa.string())]
)
_RECORD = pa.schema(
    [("record_id", pa.string()), ("type", pa.string()), ("uri", pa.string()), ("refers_to", pa.string()),
     ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
     ("problem", pa.string())]
)
PIECE = (
    "origin string, number int, last boolean, total long, type string, record_id string, uri string, "
    "refers_to string, digest string, block binary, problem string"
)
RECORD = (
    "record_id string, type string, uri string, refers_to string, payload_digest string, "
    "payload_bytes long, payload binary, problem string"
)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(body: bytes, size: int = CHUNK) -> bytes:
    parts = [body[i : i + size] for i in range(0, len(body), size)]
    return b"".join([b"%x\r\n%s\r\n" % (len(p), p) for p in parts]) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """Undo chunked framing; ValueError where the framing is damaged."""
    at, out = 0, []
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size missing")
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        at = end + 2
        if size < 0 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk cut short")
        out.append(body[at : at + size])
        at += size + 2


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _address(url: str | None) -> str:
    return quote(url or "", safe=":/?#[]@!$&'()*+,;=%-._~")


def page_records(
    record_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None, segment: int
) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response with its continuations."""
    fields = [("WARC-Date", DATE), ("WARC-Target-URI", _address(url)),
              ("WARC-Payload-Digest", f"sha1:{digest}")]
    http = [("Content-Type", "application/http; msgtype=response")]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        block = head + b"Content-Length: %d\r\n\r\n" % len(payload)
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield record(
            [("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{record_id}>"), *fields,
             ("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", profile), *http], block
        )
        return
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    for n, part in enumerate(parts, 1):
        kind = "response" if n == 1 else "continuation"
        own = record_id if n == 1 else f"{record_id}:{n}"
        more: list[tuple[str, object]] = [("WARC-Segment-Number", n)] if len(parts) > 1 else []
        if n > 1:
            more.append(("WARC-Segment-Origin-ID", f"<{record_id}>"))
            if n == len(parts):
                more.append(("WARC-Segment-Total-Length", len(block)))
        yield record([("WARC-Type", kind), ("WARC-Record-ID", f"<{own}>"), *fields, *http, *more], part)


def _name(page_id: int | None, digest: str, url: str | None) -> str:
    mark = hashlib.sha1(f"{digest}|{url}".encode("utf-8", "surrogatepass")).hexdigest()[:16]
    return f"urn:page:{'' if page_id is None else page_id}:{mark}"


def write_pages(
    pages: DataFrame,
    path: str,
    min_bytes: int = 0,
    segment: int = SEGMENT,
    file_bytes: int = FILE_BYTES,
    id_col: str = "page_id",
    url: str = "url",
    text: str = "html",
) -> DataFrame:
    """Write archives under ``path``; a stored manifest: file, records.

    Payloads of at least ``min_bytes`` bytes that are equal are written once.
    """
    payload = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url).alias("url"), payload.alias("payload"),
        F.sha1(payload).alias("sha"),
    )
    # Per payload: the greatest id with its URL and number of rows, and the number of all rows.
    by_page = rows.groupBy("sha", "id").agg(F.max("url").alias("url"), F.count(F.lit(1)).alias("rows"))
    firsts = stored(
        by_page.groupBy("sha").agg(
            F.max(F.struct("id", "url", "rows")).alias("first"), F.sum("rows").alias("n")
        ),
        "firsts",
    )
    total = firsts.agg(F.sum("n")).first()[0] or 0
    joined = attach(rows, firsts, "sha", "n", total).sortWithinPartitions("id", "sha", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), str(context.taskAttemptId())
        held: list[bytes] = []
        number = records = size = named = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, records, size
            name = f"pages-{part:06d}-{number:05d}.warc.gz"
            info = record(
                [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:file:{name}>"), ("WARC-Date", DATE),
                 ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC 1.1\r\n"
            )
            put_file(f"{path}/{name}", b"".join([_member(info), *held]), attempt)
            row = pa.RecordBatch.from_pydict({"file": [name], "records": pa.array([records], pa.int64())})
            held.clear()
            number, records, size = number + 1, 0, 0
            return row

        for batch in batches:
            for row in _rows(batch):
                digest = base64.b32encode(bytes.fromhex(row["sha"])).decode()
                first = row["first"]
                revisit = len(row["payload"]) >= min_bytes and first["id"] is not None and row["id"] != first["id"]
                name = _name(row["id"], digest, row["url"])
                if row["id"] != first["id"] or first["id"] is None or first["rows"] > 1:
                    # Only the one row that revisits refer to has the plain name.
                    named += 1
                    name = f"{name}:{part}.{named}"
                refers = _name(first["id"], digest, first["url"]) if revisit else None
                for made in page_records(name, row["url"], row["payload"], digest, refers, segment):
                    held.append(_member(made))
                    records += 1
                    size += len(held[-1])
                if size >= file_bytes:
                    yield flush()
        if held:
            yield flush()

    manifest = stored(joined.mapInArrow(run, "file string, records long"), "warc_manifest")
    # Without a page there is no archive, but still a folder to read.
    put_file(f"{path}/_written", b"", "driver")
    return manifest


def _member(body: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(body) + packer.flush()


_GZIP = b"\x1f\x8b\x08"


def _member_at(view: memoryview, at: int) -> tuple[bytes, int]:
    """The gzip member at a place, and the place behind it."""
    # Fed in short steps, as what lies behind a member is copied with each.
    unpacker, out = zlib.decompressobj(31), []
    while not unpacker.eof:
        if at >= len(view):
            raise ValueError("archive cut short")
        out.append(unpacker.decompress(view[at : at + STEP]))
        at += len(view[at : at + STEP]) - len(unpacker.unused_data)
    return b"".join(out), at


def _members(body: bytes) -> Iterator[tuple[int, bytes | Exception]]:
    """The places and contents of the gzip members of a file; a plain file is one.

    A damaged member gives its fault, and reading goes on at the next place where a whole member
    begins. Bytes between the two belong to the fault.
    """
    if body[:2] != b"\x1f\x8b":
        yield 0, body
        return
    view, at = memoryview(body), 0
    while at < len(view):
        try:
            data, end = _member_at(view, at)
        except (ValueError, zlib.error) as e:
            yield at, e
            data = None
            while data is None:
                at = body.find(_GZIP, at + 1)
                if at < 0:
                    return
                with suppress(ValueError, zlib.error):
                    data, end = _member_at(view, at)
                    if not data.startswith(b"WARC/"):
                        data = None  # what looked like a member inside the damaged one
        yield at, data
        at = end


def _record_at(data: bytes, at: int) -> tuple[dict, int]:
    """The record at a place as a piece, and the place behind it."""
    end = data.find(b"\r\n\r\n", at)
    if not data.startswith(b"WARC/", at) or end < 0:
        raise ValueError("not a record")
    fields = {}
    for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
        key, _, value = line.partition(":")
        fields[key.strip().lower()] = value.strip()
    size = int(fields["content-length"]) if fields.get("content-length", "").isdigit() else -1
    block = data[end + 4 : end + 4 + size]
    if size < 0 or len(block) < size:
        raise ValueError("record cut short")
    own = fields.get("warc-record-id", "").strip("<>")
    total = fields.get("warc-segment-total-length")
    number = int(fields.get("warc-segment-number", 1))
    piece = {
        "origin": fields.get("warc-segment-origin-id", own).strip("<>"),
        "number": number,
        "segmented": "warc-segment-number" in fields,
        "last": total is not None or "warc-segment-number" not in fields,
        "total": None if total is None else int(total),
        "type": fields.get("warc-type"),
        "record_id": own,
        "uri": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to", "").strip("<>") or None,
        "digest": fields.get("warc-payload-digest"),
        "block": block,
        "problem": None,
    }
    return piece, end + 4 + size


def parse(data: bytes) -> Iterator[tuple[int, dict | ValueError]]:
    """Records of uncompressed WARC data as pieces with their places; a damaged one gives its
    fault, and reading goes on at the next line that begins a record."""
    at = 0
    while True:
        while data[at : at + 1] in (b"\r", b"\n"):
            at += 1
        if at >= len(data):
            return
        try:
            piece, end = _record_at(data, at)
        except ValueError as e:
            yield at, e
            following = data.find(b"\nWARC/", at)
            if following < 0:
                return
            at = following + 1
        else:
            yield at, piece
            at = end


def _pieces_of(body: bytes) -> Iterator[tuple[str, dict | Exception]]:
    """The pieces of a file, and a fault for each stretch that cannot be read, with their places."""
    for place, data in _members(body):
        if isinstance(data, Exception):
            yield str(place), data
        else:
            yield from ((f"{place}.{at}", piece) for at, piece in parse(data))


def pieces(spark: SparkSession, path: str, segmented: bool | None = None) -> DataFrame:
    """The records of the archives under ``path``, one row each.

    A damaged member, or record of a plain file, gives a problem row, and reading goes on behind it.

    ``segmented`` asks for the pieces of cut records only, or for the other records only.
    """
    files = spark.read.schema("path string, modificationTime timestamp, length long, content binary")
    files = files.format("binaryFile").option("pathGlobFilter", "*.warc*").load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                held: list[dict] = []
                size = 0
                for place, piece in _pieces_of(body.as_py()):
                    if isinstance(piece, Exception):
                        if segmented:
                            continue
                        piece = {"origin": f"{name}#{place}", "number": 1, "last": True, "problem": str(piece), "block": b""}
                    elif segmented is not None and segmented != piece["segmented"]:
                        continue
                    held.append(piece)
                    size += len(piece["block"])
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=_PIECE)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=_PIECE)

    return files.select("path", "content").mapInArrow(run, PIECE)


def _joined(group: list[dict]) -> dict:
    """One record from its pieces, in order of their numbers."""
    first, last = group[0], group[-1]
    out = {k: first[k] for k in ("record_id", "type", "uri", "refers_to", "problem")}
    out |= {"payload_digest": (first["digest"] or "").removeprefix("sha1:") or None,
            "payload_bytes": None, "payload": None}
    if out["problem"]:
        return out
    block = b"".join(p["block"] for p in group)
    if [p["number"] for p in group] != list(range(1, len(group) + 1)) or not last["last"]:
        return out | {"problem": "segment missing"}
    if last["total"] is not None and last["total"] != len(block):
        return out | {"problem": "total length differs"}
    if not block.startswith(b"HTTP/"):
        return out | {"payload": block, "payload_bytes": len(block)}
    head, _, body = block.partition(b"\r\n\r\n")
    if first["type"] == "revisit":
        size = re.search(rb"\r\ncontent-length:\s*(\d+)", head, re.I)
        return out | {"payload_bytes": int(size[1]) if size else None}
    if re.search(rb"\r\ntransfer-encoding:[^\r]*chunked", head, re.I):
        try:
            body = dechunked(body)
        except ValueError as e:
            return out | {"problem": str(e)}
    if out["payload_digest"] and out["payload_digest"] != digest_of(body):
        return out | {"problem": "digest differs"}
    return out | {"payload": body, "payload_bytes": len(body)}


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Whole records (without warcinfo): record_id, type, uri, refers_to, payload_digest,
    payload_bytes, payload, problem.

    Only the pieces of cut records are shuffled; a task holds those of one record at a time.
    """
    whole = pieces(spark, path, segmented=False).filter("type is null or type <> 'warcinfo'")
    cut = pieces(spark, path, segmented=True)
    cut = cut.repartition("origin").sortWithinPartitions("origin", "number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []
        for batch in batches:
            out = []
            for piece in _rows(batch):
                if group and (piece["origin"] != group[0]["origin"] or piece["number"] == group[0]["number"] == 1):
                    out.append(_joined(group))
                    group = []
                group.append(piece)
            yield pa.RecordBatch.from_pylist(out, schema=_RECORD)
        if group:
            yield pa.RecordBatch.from_pylist([_joined(group)], schema=_RECORD)

    return whole.mapInArrow(run, RECORD).unionByName(cut.mapInArrow(run, RECORD))


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for at in range(0, batch.num_rows, 64):
        yield from batch.slice(at, 64).to_pylist()
