"""WARC archives: exact round trip, chunks, digests and revisits."""

import base64
import hashlib
import random

import pytest

from shopstrata.llm import warc

SCHEMA = "page_id long, url string, html string, archive string, last string"


def rows():
    rng = random.Random(8)
    texts = [None, "", "a", "<p>ä</p>\r\n\r\nWARC/1.1\r\n", "x" * 999, "".join(chr(rng.randrange(32, 900)) for _ in range(5000))]
    found = [(i, f"http://h/{i}?q=ü\r\nX: 1", rng.choice(texts), "p", "q") for i in range(60)]
    found += [(None, None, "only without id", "p", "q"), (None, None, "a", "p", "q")]
    return found + [(70, "u", "twice", "p", "q")] * 2


def expected(min_bytes=0):
    newest = {}
    for page, _, html, *_ in rows():
        html = html or ""
        if page is not None:
            newest[html] = max(newest.get(html, page), page)
    out = []
    for page, _, html, *_ in rows():
        data = (html or "").encode()
        last = newest.get(html or "")
        revisit = len(data) >= min_bytes and last is not None and last != page
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "revisit" if revisit else "response", last if revisit else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("chunk,min_bytes", [(64, 0), (warc.CHUNK, 2)])
def test_pages(spark, chunk, min_bytes):
    pages = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    found = warc.archived_pages(pages, min_bytes, chunk).collect()
    assert sorted(str(tuple(r)[:5]) for r in found) == expected(min_bytes)
    assert all(r["chunks"] == max(1, -(-r["payload_bytes"] // chunk)) for r in found if r["record_type"] == "response")


def test_chunks_restore_payloads(spark):
    pages = spark.createDataFrame(rows(), SCHEMA)
    manifest = warc.write_archives(warc.decide(pages))
    assert sum(r["records"] for r in manifest.collect()) == len(rows())
    chunks = warc.read_chunks(manifest, chunk=100).where("record_type = 'response'").collect()
    whole = {}
    for r in sorted(chunks, key=lambda r: r["chunk_no"]):
        assert len(r["data"]) <= 100
        at = (r["archive"], r["record_id"])
        if r["record_id"] not in ("<urn:page:null>", "<urn:page:70>"):
            whole[at] = whole.get(at, b"") + r["data"]
            assert r["payload_bytes"] == len(whole[at])
            assert r["payload_digest"] == base64.b32encode(hashlib.sha1(whole[at]).digest()).decode()
    assert set(whole.values()) == {(h or "").encode() for p, _, h, *_ in rows() if p not in (None, 70)}


def test_any_reader_can_parse_the_archive(spark):
    import gzip

    pages = spark.createDataFrame([(1, "http://a", "<p>x</p>", "", "")], SCHEMA)
    path = warc.write_archives(warc.decide(pages)).first()["archive"].removeprefix("file://")
    data = gzip.open(path).read()
    assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"<p>x</p>\r\n\r\n")


def test_empty(spark):
    assert warc.archived_pages(spark.createDataFrame([], SCHEMA)).collect() == []
