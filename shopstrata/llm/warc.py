"""WARC archives as a chunked record table.

A record travels as rows (record_id, chunk_no) of bounded size, each with the digest of the payload
up to and including that chunk. Writing and reading go through gzip members chunk by chunk, so no
buffer has the length of a record. Every task writes one archive under a name of its own and returns
a manifest row; only archives of tasks that succeeded are in the manifest, so files of lost executors
are never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstrata.llm.common import open_store, stored
from shopstrata.sources.layers import shared_folder

CHUNK = 1 << 18
DATE = "1970-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
MANIFEST = "archive string, records long, bytes long"
CHUNKS = (
    "archive string, record_id string, chunk_no int, last boolean, record_type string, refers_to string, "
    "payload_bytes long, payload_digest string, data binary"
)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def decide(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with _type and _refers.

    Among equal payloads of at least ``min_bytes`` the largest page_id is the response. Where ids are
    missing altogether, or the largest is repeated, all rows that hold it are responses. The payloads
    are compared by length and SHA-1; only those travel to be grouped, and copies collapse first.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"),
        F.concat_ws(":", F.octet_length(html), F.sha1(html.cast("binary"))).alias("_digest"),
    )
    newest = stored(
        rows.where(F.octet_length("html") >= min_bytes).groupBy("_digest")
        .agg(F.max("page_id").alias("_newest"))
    )
    revisit = (F.octet_length("html") >= min_bytes) & F.col("_newest").isNotNull() & ~F.col("page_id").eqNullSafe(
        F.col("_newest")
    )
    return rows.join(newest, "_digest", "left").select(
        "page_id", "url", "html",
        F.when(revisit, "revisit").otherwise("response").alias("_type"),
        F.when(revisit, F.col("_newest")).alias("_refers"),
    )


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _header(page_id, url, kind, refers, digest, length) -> bytes:
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {length}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%~-._"))
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_name(refers)}")
    block = len(HTTP) + (length if kind == "response" else 0)
    lines.append(f"Content-Length: {block}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def write_archives(records: DataFrame, folder: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """Write the rows of ``decide``, one gzipped archive per task; returns the stored manifest."""
    folder = folder or shared_folder(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        name = f"{base}/{uuid.uuid4().hex}.warc.gz"
        count = size = 0
        sink = None
        for batch in batches:
            ids, urls, texts, kinds, refers = batch.columns
            for i in range(batch.num_rows):
                if sink is None:
                    sink = store.open_output_stream(name, compression=None)
                # The bytes of the Arrow buffer, cut into chunks without a copy.
                payload = memoryview(texts[i].as_buffer() or b"")
                digest = hashlib.sha1()
                for at in range(0, len(payload), chunk):
                    digest.update(payload[at : at + chunk])
                kind = kinds[i].as_py()
                member = zlib.compressobj(4, wbits=31)
                head = _header(
                    ids[i].as_py(), urls[i].as_py(), kind, refers[i].as_py(),
                    base32(digest.digest()), len(payload),
                )
                size += sink.write(member.compress(head + HTTP)) or 0
                if kind == "response":
                    for at in range(0, len(payload), chunk):
                        sink.write(member.compress(payload[at : at + chunk]))
                sink.write(member.compress(b"\r\n\r\n"))
                sink.write(member.flush())
                count += 1
        if sink is not None:
            size = sink.tell()
            sink.close()
            yield pa.RecordBatch.from_pydict(
                {"archive": [f"{folder}/{name.rsplit('/', 1)[1]}"], "records": [count], "bytes": [size]}
            )

    return stored(records.mapInArrow(run, MANIFEST))


class _Members:
    """The bytes of a file of gzip members, handed out in bounded pieces."""

    def __init__(self, source, chunk: int):
        self.source, self.chunk = source, chunk
        self.member = zlib.decompressobj(wbits=31)
        self.raw = self.ready = b""

    def more(self) -> bool:
        """Decompress one more piece; False at the end of the file."""
        while True:
            if self.member.eof:
                self.raw = self.member.unused_data
                self.member = zlib.decompressobj(wbits=31)
            if not self.raw:
                self.raw = self.source.read(self.chunk)
                if not self.raw:
                    return False
            piece = self.member.decompress(self.raw, self.chunk)
            self.raw = self.member.unconsumed_tail
            if piece:
                self.ready += piece
                return True

    def until(self, mark: bytes) -> bytes | None:
        while mark not in self.ready:
            if not self.more():
                return None
        head, self.ready = self.ready.split(mark, 1)
        return head

    def take(self, count: int) -> bytes:
        """At most ``count`` bytes, at least one."""
        if not self.ready and not self.more():
            raise ValueError("an archive ends within a record")
        piece, self.ready = self.ready[:count], self.ready[count:]
        return piece


def _records(source, chunk: int) -> Iterator[tuple]:
    """Chunk rows of an open archive; a payload is passed on in pieces of at most ``chunk`` bytes."""
    members = _Members(source, chunk)
    while (head := members.until(b"\r\n\r\n")) is not None:
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        left = int(fields["Content-Length"])
        http = members.until(b"\r\n\r\n")
        left -= len(http) + 4
        record = (fields["WARC-Record-ID"], fields["WARC-Type"], fields.get("WARC-Refers-To"))
        stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        length = int(fields["X-Payload-Length"])
        digest, number, held = hashlib.sha1(), 0, b""
        if record[1] == "revisit":
            yield (*record, 0, True, length, stated, b"")
        else:
            done = 0
            while True:
                want = min(chunk, left - done)
                while len(held) < want:
                    held += members.take(want - len(held))
                digest.update(held)
                done += len(held)
                last = done == left
                found = base32(digest.digest())
                if last and (found != stated or done != length):
                    raise ValueError(f"record {record[0]} does not have the payload that its header states")
                yield (*record, number, last, done, found, held)
                if last:
                    break
                number, held = number + 1, b""
        if members.until(b"\r\n\r\n") != b"":
            raise ValueError(f"record {record[0]} does not end where its header says")


def read_chunks(manifest: DataFrame, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunked record table of all archives in ``manifest``.

    ``payload_bytes`` and ``payload_digest`` (bare base32 SHA-1) cover the payload up to this chunk; the
    last chunk of a record has them for the whole. A revisit is one row with the values of its header.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("archive", pa.string()), ("record_id", pa.string()), ("chunk_no", pa.int32()), ("last", pa.bool_()),
             ("record_type", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
             ("payload_digest", pa.string()), ("data", pa.binary())]
        )
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                store, path = open_store(archive)
                with store.open_input_stream(path, compression=None) as source:
                    rows, held = [], 0
                    for name, kind, refers, number, last, done, digest, data in _records(source, chunk):
                        rows.append((archive, name, number, last, kind, refers, done, digest, data if with_data else None))
                        held += 200 + (len(data) if with_data else 0)
                        if held > 8 * CHUNK:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                            )
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                        )

    # A task per archive: the manifest is so small that adaptive execution would make one task of it.
    files = manifest.select("archive").repartitionByRange(max(1, manifest.count()), "archive")
    return files.mapInArrow(run, CHUNKS)


def page_of(record_id: str):
    """The page_id in a record id, as a long; null for a record without one."""
    number = F.regexp_extract(record_id, r"<urn:page:(-?\d+)>", 1)
    return F.when(number != "", number.cast("long"))


def archived_pages(pages: DataFrame, min_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Write ``pages`` to archives and read them back: one row per record.

    (page_id, payload_bytes, payload_digest, record_type, refers_to, chunks). A null html is an empty
    payload; a null url leaves the target out; a null page_id comes back as null. Repeated rows are
    records of their own. An empty table gives no archive and an empty result.
    """
    manifest = write_archives(decide(pages, min_bytes), chunk=chunk)
    return (
        read_chunks(manifest, chunk, with_data=False).where("last")
        .select(
            page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
            page_of("refers_to").alias("refers_to"), (F.col("chunk_no") + 1).alias("chunks"),
        )
    )


def restored_payloads(manifest: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(page_id, chunk_no, data) of the response records, for readers that want the bytes."""
    return read_chunks(manifest, chunk).where("record_type = 'response'").select(
        page_of("record_id").alias("page_id"), "chunk_no", "data"
    )


