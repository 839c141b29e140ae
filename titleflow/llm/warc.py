"""WARC archives: distributed writer and sequential reader.

Writer: every task streams its pages into archives below a shared folder,
one gzip member per record, a new archive after ``archive_mb`` MB. Only the
manifest rows of successful task attempts name archives, so what a lost or
repeated attempt left behind is never read. Equal payloads are found by
their SHA-1 beforehand (thin rows: digest and page id, combined map-side):
the copy with the largest page id is the ``response``, the others become
``revisit`` records that refer to it.

Reader: an archive is read front to back in blocks; one zlib decompressor
per member, records cut by their declared Content-Length, block and payload
digests verified. Memory is one record plus one block.

Files are opened through Arrow's file systems, so the folder may be any
URI that Arrow can open (file, HDFS, object stores).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleflow.llm.common import folder as shared_folder
from titleflow.llm.common import stored

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BLOCK = 1 << 16
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:page-record")


class WarcError(ValueError):
    """An archive that breaks the framing or whose digests don't fit."""


@dataclass(frozen=True)
class Record:
    kind: str
    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str, *more: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, ':'.join(map(str, (page_id, digest, *more))))}>"


def _escaped(url: str) -> str:
    """Header text is UTF-8; only line ends, which no URL may hold, are escaped."""
    return url.replace("\r", "%0D").replace("\n", "%0A")


def pack(page_id: int | None, url: str | None, payload: bytes, keeper: int | None, revisit: bool,
         date: str, place: str = "") -> bytes:
    """One record as one gzip member. A revisit carries the HTTP headers
    (with the full payload's length) but no payload."""
    digest = base32_sha1(payload)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    own = record_id(page_id, digest, place) if revisit else record_id(page_id, digest)
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {own}",
             f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_escaped(url)}")
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(keeper, digest)}",
                  f"Refers-To-Page-ID: {keeper}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + packer.flush()


def members(stream) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, read block by block."""
    rest = b""
    while True:
        rest = rest or stream.read(_BLOCK)
        if not rest:
            return
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not rest and not (rest := stream.read(_BLOCK)):
                raise WarcError("archive ends inside a gzip member")
            try:
                parts.append(unpacker.decompress(rest))
            except zlib.error as e:
                raise WarcError(f"damaged gzip member: {e}") from e
            rest = b""
        rest = unpacker.unused_data
        yield b"".join(parts)


def _headers(raw: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in raw.decode().split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse(member: bytes) -> Record:
    """Cut a record out of its member by Content-Length and verify it."""
    head, found, body = member.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/1."):
        raise WarcError("no record header")
    headers = _headers(head)
    try:
        size = int(headers["content-length"])
    except (KeyError, ValueError) as e:
        raise WarcError("no content length") from e
    if len(body) != size + 4 or body[size:] != b"\r\n\r\n":
        raise WarcError(f"record of {len(body) - 4} bytes declares {size}")
    block = body[:size]
    if headers.get("warc-block-digest") != f"sha1:{base32_sha1(block)}":
        raise WarcError(f"block digest of {headers.get('warc-record-id')} doesn't fit")
    http_head, _, payload = block.partition(b"\r\n\r\n")
    kind = headers.get("warc-type", "")
    if kind == "response" and headers.get("warc-payload-digest") != f"sha1:{base32_sha1(payload)}":
        raise WarcError(f"payload digest of {headers.get('warc-record-id')} doesn't fit")
    return Record(kind, headers, _headers(http_head), payload)


def read_records(stream) -> Iterator[Record]:
    """All records of an archive, in order."""
    return map(parse, members(stream))


def _open(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def plan_records(pages: DataFrame, id_col: str = "page_id", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """``pages`` with ``__revisit`` and ``__keeper`` (the response's id).

    Only digests that occur twice or more go into the lookup. Its key may
    be hot (one page copied a million times): the lookup has one row per
    digest, so Spark may broadcast it or split the hot side.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.withColumn("__sha", F.unhex(F.sha1(payload)))
    long_enough = F.octet_length(payload) >= min_bytes
    groups = (rows.where(long_enough).groupBy("__sha")
              .agg(F.max(id_col).alias("__keeper"), F.count(F.lit(1)).alias("__n"))
              .where("__n > 1").drop("__n"))
    joined = rows.join(groups, "__sha", "left")
    revisit = (F.col("__keeper").isNotNull() & long_enough
               & ~F.col(id_col).eqNullSafe(F.col("__keeper")))
    return joined.withColumn("__revisit", revisit).drop("__sha")


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = 0, archive_mb: int = 64, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write all pages below ``folder``; the manifest (path, records, bytes).

    Null html is an empty payload, null url and id leave their headers out.
    Of pages with equal payloads of ``min_bytes`` bytes or more, those with
    the largest id are responses (several rows if that id repeats; all rows
    if every id is null), the others revisits; smaller ones are responses.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open(folder)
        files.create_dir(base, recursive=True)
        task = TaskContext.get()
        stem = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        done: list[tuple[str, int, int]] = []
        out, name, records, size = None, "", 0, 0
        for batch in batches:
            ids, urls, texts, keepers, revisits = (c.to_pylist() for c in batch.columns)
            for page_id, address, text, keeper, revisit in zip(ids, urls, texts, keepers, revisits, strict=True):
                if out is None:
                    name = f"{stem}-{len(done):04d}.warc.gz"
                    out, records, size = files.open_output_stream(f"{base}/{name}"), 0, 0
                member = pack(page_id, address, (text or "").encode(), keeper, revisit, date, f"{name}:{records}")
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= archive_mb << 20:
                    out.close()
                    out = None
                    done.append((name, records, size))
        if out is not None:
            out.close()
            done.append((name, records, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{folder}/{d[0]}" for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()),
             pa.array([d[2] for d in done], pa.int64())], ["path", "records", "bytes"])

    rows = plan_records(pages.select(id_col, url, html), id_col, html, min_bytes)
    return stored(rows.select(id_col, url, html, "__keeper", "__revisit").mapInArrow(
        run, "path string, records long, bytes long"))


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """One row per record of the archives in ``manifest``: page_id, url,
    payload_bytes, payload_digest (both of the full payload, also for
    revisits), record_type, refers_to and, if asked for, the payload of
    responses. A damaged archive raises :class:`WarcError`.

    One task per archive: archives have a bounded size, and the explicit
    partition count keeps the tiny manifest rows from being put together.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = _open(path)
                with files.open_input_stream(name) as stream:
                    yield from _rows(stream, payloads)

    n = max(1, manifest.count())
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long" + ", payload binary" * payloads)
    return manifest.select("path").repartition(n).mapInArrow(run, schema)


def _rows(stream, payloads: bool) -> Iterator[pa.RecordBatch]:
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                 ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
        kinds += [("payload", pa.binary())] * payloads
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(kinds)],
                                          [k for k, _ in kinds])

    rows, held = [], 0
    for r in read_records(stream):
        h = r.headers
        if (size := int(r.http["content-length"])) != len(r.payload) and r.kind == "response":
            raise WarcError(f"payload of {len(r.payload)} bytes declares {size}")
        digest = h["warc-payload-digest"].removeprefix("sha1:")
        number = lambda k: int(h[k]) if k in h else None
        rows.append((number("page-id"), h.get("warc-target-uri"), size, digest, r.kind, number("refers-to-page-id"))
                    + ((r.payload if r.kind == "response" else None),) * payloads)
        held += len(r.payload) * payloads
        if len(rows) >= 4096 or held >= 16 << 20:
            yield batch(rows)
            rows, held = [], 0
    if rows:
        yield batch(rows)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages into archives below the shared folder, read them back."""
    manifest = write_archives(pages, shared_folder(pages.sparkSession) + "-warc", min_bytes=min_bytes)
    return read_archives(manifest)
