import base64
import hashlib
import io
import zlib

import pytest

from titleflow.llm import warc as W
from titleflow.llm.common import folder

ROWS = [(1, "http://a/1?x=%41&y=ü", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (3, None, "<p>same</p>"),
        (4, "http://a/4", None), (5, "http://a/5", ""), (6, "", "\r\n\r\nWARC/1.1\r\n é \x00 " * 50),
        (7, "http://a/\n7", "z" * 300_000), (8, "http://a/8", "ab"), (9, "http://a/9", "ab"), (None, "u", "ab"),
        (None, "v", "alone")]


def expected(min_bytes):
    out = []
    for page, _, html in ROWS:
        raw = (html or "").encode()
        same = [p for p, _, h in ROWS if (h or "") == (html or "")]
        keeper = max((p for p in same if p is not None), default=None)
        revisit = len(raw) >= min_bytes and keeper is not None and page != keeper
        sha = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page, len(raw), sha, "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 3])
def test_round_trip(spark, min_bytes):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, payload string")
    out = W.round_trip(pages, min_bytes).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out), key=str)
    assert got == expected(min_bytes)
    urls = {r.page_id: r.url for r in out if r.page_id is not None}
    assert urls == {p: u.replace("\n", "%0A") if u is not None else None for p, u, _ in ROWS if p is not None}
    assert W.round_trip(pages.limit(0)).count() == 0


def test_archives_rotate_and_keep_payloads(spark):
    import os
    pages = spark.createDataFrame(
        [(i, f"http://a/{i}", base64.b64encode(os.urandom(60_000)).decode()) for i in range(60)],
        "page_id long, url string, html string").coalesce(1)
    pages = pages.checkpoint()
    manifest = W.write_archives(pages, folder(spark) + "-w", archive_mb=1)
    assert manifest.count() > 1 and manifest.agg({"records": "sum"}).first()[0] == 60
    back = {r.page_id: bytes(r.payload).decode() for r in W.read_archives(manifest, payloads=True).collect()}
    assert back == {r.page_id: r.html for r in pages.collect()}


class Trickle(io.BytesIO):
    """A stream that hands out a few bytes at a time."""

    def read(self, n=-1):
        return super().read(min(n, 7) if n > 0 else n)


def archive():
    return b"".join(W.pack(i, f"http://a/{i}", t, None, False, "2024-01-01T00:00:00Z")
                    for i, t in enumerate((b"", b"one", b"x" * 70_000)))


def test_reader_is_incremental_and_one_member_a_record():
    records = list(W.read_records(Trickle(archive())))
    assert [r.payload for r in records] == [b"", b"one", b"x" * 70_000]
    assert list(W.read_records(io.BytesIO(b""))) == []
    one = zlib.decompressobj(31)
    one.decompress(archive())
    assert one.eof and one.unused_data  # the first member ends before the second record


def remade(change):
    raw = zlib.decompress(W.pack(1, "http://a", b"payload", None, False, "d"), 31)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(change(raw)) + packer.flush()


@pytest.mark.parametrize("bad", [
    lambda: archive()[:-9],
    lambda: archive()[:40] + b"\x00\xff\x00" + archive()[43:],
    lambda: remade(lambda r: r.replace(b"payload\r\n\r\n", b"paYload\r\n\r\n")),
    lambda: remade(lambda r: r[:-4]),
    lambda: remade(lambda r: r + b"more"),
    lambda: remade(lambda r: r.replace(b"WARC/1.1", b"WORC/1.1")),
    lambda: remade(lambda r: r.replace(b"Content-Length", b"Content-Size")),
])
def test_damage_is_found(bad):
    with pytest.raises(W.WarcError):
        list(W.read_records(io.BytesIO(bad())))
