"""WARC archives: writing with revisits and segments, reading with segment reassembly.

Writing: an HTTP response with chunked transfer framing per page. Of pages with equal payloads of at least ``REVISIT_BYTES``, the one with the
largest id is the response and the others are revisit records that refer to it. A block longer than ``segment_bytes`` goes on in
continuation records, which carry their origin's id and their number, the last one also the total length. Every record is a gzip member.
A page's record id follows from its id and payload, so a revisit names the record that it refers to.

Reading: archives are parsed as streams, record by record. Unsegmented records are complete at once; segments are grouped by
their origin (and the copy of it, where a record was written twice) and sorted by number across all archives, their total length is verified, the chunked framing
is decoded, and the payload's digest is compared with the record's.

Defined results: a null payload is empty; a null url leaves the header out; a null page id is kept as null and is a response; rows that repeat the
largest id are each the response; an empty table gives no archives and no rows; other columns aren't read, whatever their names. Missing, repeated or short segments and wrong digests raise an error.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import files
from .shared import looked_up, quoted, shared_dir, staged, width

REVISIT_BYTES, SEGMENT_BYTES, CHUNK_BYTES, BROADCAST_ROWS = 1000, 32 << 10, 8 << 10, 200_000
DATE = "2024-01-01T00:00:00Z"
_END = b"\r\n\r\n"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    out = [b"%x\r\n%b\r\n" % (len(c), c) for c in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join([*out, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        n = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not n:
            return b"".join(out)
        if len(body) < at + n + 2 or body[at + n : at + n + 2] != b"\r\n":
            raise ValueError("broken chunk")
        out.append(body[at : at + n])
        at += n + 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response."""
    head, _, body = block.partition(_END)
    return dechunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head.replace(b"\r", b"")) else body


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    z = zlib.compressobj(1, wbits=31)
    return z.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + _END) + z.flush()


def _base32(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record_id(page: int | None, digest: str) -> str:
    """The id of a page's record; that of a page without an id is random."""
    return f"<urn:uuid:{uuid.uuid4() if page is None else uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}')}>"


def records(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, segment_bytes: int) -> Iterator[bytes]:
    """The records of a page."""
    name, copy = record_id(page, digest), uuid.uuid4().hex
    target = [] if url is None else [("WARC-Target-URI", re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url))]
    common = [("WARC-Record-ID", name), ("WARC-Date", DATE), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", _base32(digest)), ("X-Payload-Length", str(len(payload))), *target]
    if page is not None:
        common.append(("X-Page-Id", str(page)))
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if refers_to is not None:
        refers = [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(refers_to, digest)), ("WARC-Refers-To-Date", DATE), ("X-Refers-To-Page-Id", str(refers_to))]
        yield _record([("WARC-Type", "revisit"), *common, *refers], head)
        return
    block = head + chunked(payload)
    if len(block) <= segment_bytes:
        yield _record([("WARC-Type", "response"), *common], block)
        return
    pieces = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    yield _record([("WARC-Type", "response"), *common, ("X-Copy", copy), ("WARC-Segment-Number", "1")], pieces[0])
    for n, piece in enumerate(pieces[1:], 2):
        last = [("WARC-Segment-Total-Length", str(len(block)))] if n == len(pieces) else []
        own = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), *target, ("X-Copy", copy)]
        yield _record([*own, ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(n)), *last], piece)


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Archives of all pages below the folder: (path, records), a row for each archive."""
    rows = pages.select(F.col(quoted(id_col)).cast("long").alias("page_id"), F.col(quoted(url_col)).alias("url"), F.coalesce(F.col(quoted(html_col)), F.lit("")).cast("binary").alias("body"))
    rows = rows.withColumn("digest", F.sha1("body")).withColumn("size", F.octet_length("body"))
    best = rows.where(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("digest", "first")
    best = staged(best)
    # beyond that size the payloads that have copies are dealt by digest, a digest of very many rows still by broadcast
    dealt = rows.join(F.broadcast(best), "digest", "left") if best.count() <= BROADCAST_ROWS else looked_up(rows, best, ["digest"], "left")
    dealt = dealt.select("page_id", "url", "body", "digest", F.when(F.col("page_id") < F.col("first"), F.col("first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, n = None, None, 0
        for b in batches:
            for page, url, body, digest, refers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    path, out = files.create(folder, ".warc.gz")
                    out.write(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                for r in records(page, url, body, digest, refers, segment_bytes):
                    out.write(r)
                    n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], ["path", "records"])

    return staged(dealt.mapInArrow(run, "path string, records bigint"))


def parse(stream, piece: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a gzipped archive, read as a stream."""
    data, left = b"", b""
    z = zlib.decompressobj(31)
    while left or (left := stream.read(piece)):
        data += z.decompress(left)
        left = z.unused_data
        if not z.eof:
            continue
        z = zlib.decompressobj(31)
        head, _, rest = data.partition(_END)
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        n = int(headers["content-length"])
        if len(rest) != n + len(_END):
            raise ValueError("a record is cut off")
        yield headers, rest[:n]
        data = b""
    if data:
        raise ValueError("an archive is cut off")


_OUT = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _whole(headers: dict[str, str], block: bytes) -> tuple:
    page, refers = (int(headers[k]) if k in headers else None for k in ("x-page-id", "x-refers-to-page-id"))
    digest = base64.b32decode(headers["warc-payload-digest"].partition(":")[2]).hex()
    n = int(headers["x-payload-length"])
    if headers["warc-type"] == "response":
        payload = payload_of(block)
        if len(payload) != n or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"page {page}: payload and digest differ")
    return page, n, digest, headers["warc-type"], refers


def _rows(rows: list[tuple]) -> list[pa.Array]:
    cols = list(zip(*rows, strict=True)) or [[]] * 5
    return [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)]


def read(archives: DataFrame) -> DataFrame:
    """A row per page from the archives in ``path``."""
    spark = archives.sparkSession
    names = [x.split()[0] for x in _OUT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                done, parts, held = [], [], 0

                def out() -> pa.RecordBatch:
                    n, m = len(done), len(parts)
                    cols = [pa.concat_arrays([a, pa.nulls(m, a.type)]) for a in _rows(done)]
                    segs = list(zip(*parts, strict=True)) or [[]] * 5
                    more = [pa.concat_arrays([pa.nulls(n, t), pa.array(c, t)]) for c, t in zip(segs, (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.binary()), strict=True)]
                    return pa.RecordBatch.from_arrays([*cols, *more], [*names, "origin", "number", "total", "headers", "block"])

                with files.read(path) as stream:
                    for headers, block in parse(stream):
                        kind = headers["warc-type"]
                        if kind == "continuation" or "warc-segment-number" in headers:
                            origin = headers["warc-segment-origin-id" if kind == "continuation" else "warc-record-id"]
                            total = headers.get("warc-segment-total-length")
                            parts.append((f"{origin} {headers.get('x-copy', '')}", int(headers["warc-segment-number"]), int(total) if total else None, None if kind == "continuation" else "\n".join(f"{k}: {v}" for k, v in headers.items()), block))
                            held += len(block)
                        elif kind in ("response", "revisit"):
                            done.append(_whole(headers, block))
                        if len(done) >= 5000 or held > 8 << 20:
                            yield out()
                            done, parts, held = [], [], 0
                yield out()

    more = "origin string, number int, total bigint, headers string, block binary"
    n = max(1, min(archives.count(), 4 * width(spark)))
    parsed = staged(archives.select("path").repartition(n).mapInArrow(run, f"{_OUT}, {more}"))
    segments = parsed.where("origin is not null").select(*(x.split()[0] for x in more.split(", "))).repartition(width(spark), "origin").sortWithinPartitions("origin", "number")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        origin, head, block, total, due = None, None, [], None, 0

        def close() -> tuple:
            if head is None or total is None or sum(map(len, block)) != total:
                raise ValueError(f"{origin}: segments are missing")
            return _whole(dict(x.split(": ", 1) for x in head.split("\n")), b"".join(block))

        for b in batches:
            done = []
            for o, number, t, h, piece in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if o != origin:
                    if origin is not None:
                        done.append(close())
                    origin, head, block, total, due = o, h, [], None, 0
                due += 1
                if number != due:
                    raise ValueError(f"{o}: segment {number} comes where {due} is due")
                block.append(piece)
                total = t if t is not None else total
            yield pa.RecordBatch.from_arrays(_rows(done), names)
        if origin is not None:
            yield pa.RecordBatch.from_arrays(_rows([close()]), names)

    whole = parsed.where("origin is null").select(*names)
    return whole.unionByName(segments.mapInArrow(join, _OUT))


def round_trip(pages: DataFrame) -> DataFrame:
    return read(write(pages, shared_dir(pages.sparkSession)))
