"""Token ids as length-delimited binary records with an offset index.

A record is framed as

    length of the payload, unsigned 64 bits | masked checksum of these 8 bytes, unsigned 32 bits
    payload                                 | masked checksum of the payload, unsigned 32 bits

all little-endian. The payload is 1 or 0 (whether there is a doc_id), the doc_id (signed 64 bits) and the
ids, unsigned 16 or 32 bits as the vocabulary needs; the index says which. Checksums are CRC-32 (that of
zlib), rotated right by 15 bits plus a constant, so that a checksum stored within data is not mistaken
for one over it. The index has one unsigned 64-bit offset per record behind an 8-byte head, so a reader
can take records in any order.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstrata.llm.common import open_store, stored
from shopstrata.llm.ordering import block_bounds, with_block
from shopstrata.sources.layers import shared_folder

# Fixed value: the mask of the checksum.
MASK_DELTA = 0xA282EAD8
# Bytes that are not surely split as below: UTF-8 beyond U+00C0 to U+017F, the signs for times and divided
# by, the control characters that some count as white space, and an apostrophe in front of s, t, m, d, r, v, l.
ODD = re.compile(rb"[\x1c-\x1f\xc2\xc6-\xff]|\xc3[\x97\xb7]|'[stmdrvl]")
HASH_BASE = 0x9E3779B97F4A7C15
END_ID = 0
# Pieces that a worker remembers before it starts anew.
CACHE = 600_000
CHARS_AT_ONCE = 1 << 21
MANIFEST = "path string, block int, first_id long, records long, tokens long, bytes long"


def masked(data) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


class Encoder:
    """The ids of whole texts as bytes, exactly as ``Tokenizer.encode`` gives them.

    The tokenizer first splits a text into words (with the space before them), runs of digits, marks and white
    space, and never merges across; most of these occur again and again. So texts are split here, a word is
    encoded when it is new and remembered by a 64-bit hash, and the ids of a batch are gathered at once. Texts
    with characters beyond Latin letters, special tokens, or an apostrophe that may start a contraction
    are encoded as they are.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        names = self.tokenizer.get_vocab()
        self.width = np.zeros(max(names.values()) + 1, np.int64)
        for name, i in names.items():
            self.width[i] = len(name)  # byte-level names have one character per byte
        powers = np.full(CHARS_AT_ONCE + 1, HASH_BASE, np.uint64)
        powers[0] = 1
        self.up = np.multiply.accumulate(powers)
        powers[1:] = pow(HASH_BASE, -1, 2**64)
        self.down = np.multiply.accumulate(powers)
        self.values = np.random.Generator(np.random.PCG64(7)).integers(0, 2**64, 256, dtype=np.uint64)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.used = 0
        self.ids = np.empty(1 << 16, self.kind)
        self.first = np.zeros(1 << 16, np.int64)
        self.count = np.zeros(1 << 16, np.int64)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _learn(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Encode new pieces; returns their slots. Words behind a space do not change if others stand around them, so they go in one string."""
        joint = (data[start] == 32) & (size > 1) & (_KINDS[data[np.minimum(start + 1, len(data) - 1)]] == _LETTER)
        order = np.argsort(~joint, kind="stable")
        start, size, keys, n = start[order], size[order], keys[order], int(joint.sum())
        parts = []
        if n:
            ends = np.cumsum(size[:n])
            at = np.arange(ends[-1]) + np.repeat(start[:n] - ends + size[:n], size[:n])
            text = data[at].tobytes().decode()
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
            cuts = np.searchsorted(np.cumsum(self.width[ids]), ends) + 1
            counts = [np.diff(cuts, prepend=0)]
            parts.append(ids.astype(self.kind))
        else:
            counts = []
        if n < len(start):
            texts = [data[a : a + k].tobytes().decode() for a, k in zip(start[n:].tolist(), size[n:].tolist())]
            found = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            counts.append(np.array([len(f) for f in found], np.int64))
            parts.append(np.array([i for f in found for i in f], self.kind))
        fresh, count = np.concatenate(parts), np.concatenate(counts)
        slot = len(self.known)
        while self.used + len(fresh) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
        while slot + len(count) > len(self.first):
            self.first = np.concatenate((self.first, np.zeros_like(self.first)))
            self.count = np.concatenate((self.count, np.zeros_like(self.count)))
        self.ids[self.used : self.used + len(fresh)] = fresh
        self.first[slot : slot + len(count)] = self.used + np.cumsum(count) - count
        self.count[slot : slot + len(count)] = count
        self.used += len(fresh)
        self.known.update(zip(keys.tolist(), range(slot, slot + len(count))))
        slots = np.empty(len(count), np.int64)
        slots[order] = np.arange(slot, slot + len(count))
        return slots

    def _batch(self, raw: list[bytes]) -> list[bytes]:
        """Texts that can be split, together at most CHARS_AT_ONCE bytes and none of them empty."""
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(r) for r in raw])
        start = pieces(data, ends)
        size = np.diff(np.append(start, len(data)))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=sums[1:])
        keys = (sums[start + size] - sums[start]) * self.down[start]
        keys ^= keys >> np.uint64(29)
        keys += size.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
        which, unique = pd.factorize(keys)
        if len(self.known) + len(unique) > CACHE:
            self._forget()
        slots = np.fromiter(map(self.known.get, unique.tolist(), repeat(-1)), np.int64, len(unique))
        new = np.flatnonzero(slots < 0)
        if len(new):
            place = np.empty(len(unique), np.int64)
            place[which[::-1]] = np.arange(len(which) - 1, -1, -1)
            slots[new] = self._learn(data, start[place[new]], size[place[new]], unique[new])
        slot = slots[which]
        count = self.count[slot]
        upto = np.cumsum(count)
        ids = self.ids[np.arange(upto[-1]) + np.repeat(self.first[slot] - upto + count, count)].tobytes()
        cuts = (upto[np.searchsorted(start, ends) - 1] * self.kind.itemsize).tolist()
        return [ids[a:b] for a, b in zip([0, *cuts[:-1]], cuts)]

    def encode(self, texts: list[str]) -> list[bytes]:
        out = [b""] * len(texts)
        todo: list[int] = []
        raw: list[bytes] = []
        held = 0

        def flush():
            for i, found in zip(todo, self._batch(raw) if raw else []):
                out[i] = found
            todo.clear()
            raw.clear()

        for i, text in enumerate(texts):
            data = text.encode()
            if not data:
                continue
            if len(data) > CHARS_AT_ONCE or ODD.search(data) or any(s in data for s in self.special):
                out[i] = self._whole(text)
                continue
            if held + len(data) > CHARS_AT_ONCE:
                flush()
                held = 0
            todo.append(i)
            raw.append(data)
            held += len(data)
        flush()
        return out


# Kinds of bytes: letters (all of those beyond ASCII that are not ODD), digits, white space, marks.
_LETTER, _DIGIT, _SPACE, _MARK = range(4)
_KINDS = np.full(256, _MARK, np.uint8)
_KINDS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_KINDS[list(range(48, 58))] = _DIGIT
_KINDS[[9, 10, 11, 12, 13, 32]] = _SPACE


def pieces(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the tokenizer's split starts a piece, for texts (ending at ``ends``) one after the other.

    A run of one kind is a piece, with the space in front of it if there is one. Of white space in front of
    something else, the last character is a piece of its own if it is not that space.
    """
    kind = _KINDS[data]
    new = np.ones(len(data), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[ends[:-1]] = True
    # The last white space before another run, unless the text ends there.
    last = np.zeros(len(data), bool)
    last[:-1] = (kind[:-1] == _SPACE) & (kind[1:] != _SPACE)
    last[ends - 1] = False
    attached = last & (data == 32)
    new |= last
    new[1:] &= ~attached[:-1]
    return np.flatnonzero(new)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process; what it remembers serves later tasks as well."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class _Writer:
    """One file of records and its index."""

    def __init__(self, store, base: str, folder: str, block: int, kind: np.dtype):
        self.name = f"{block:06d}-{uuid.uuid4().hex}"
        self.path, self.block, self.kind = f"{folder}/{self.name}.rec", block, kind
        self.file = store.open_output_stream(f"{base}/{self.name}.rec", compression=None)
        self.index = store.open_output_stream(f"{base}/{self.name}.idx", compression=None)
        self.index.write(struct.pack("<Q", kind.itemsize))
        self.records = self.tokens = self.bytes = 0
        self.first = None

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if not self.records:
            self.first = doc_id
        payload = struct.pack("<Bq", doc_id is not None, doc_id or 0) + ids
        length = struct.pack("<Q", len(payload))
        frame = length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))
        self.index.write(struct.pack("<Q", self.bytes))
        self.file.write(frame)
        self.bytes += len(frame)
        self.records += 1
        self.tokens += len(ids) // self.kind.itemsize

    def close(self) -> dict:
        self.file.close()
        self.index.close()
        return {
            "path": [self.path], "block": [self.block], "first_id": [self.first],
            "records": [self.records], "tokens": [self.tokens], "bytes": [self.bytes],
        }


def write_records(docs: DataFrame, tokenizer: str, end_id: int = END_ID, folder: str | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write them in ascending order of doc_id; returns the manifest.

    Every block of ids is one file under a name of its own; the manifest lists files of tasks that
    succeeded only, so those of lost executors are never read. Null ids come first; rows with equal
    ids follow the order of their texts.
    """
    folder = folder or shared_folder(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    schema = pa.schema(
        [("path", pa.string()), ("block", pa.int32()), ("first_id", pa.int64()), ("records", pa.int64()),
         ("tokens", pa.int64()), ("bytes", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        codec = encoder(tokenizer)
        end = np.array([end_id], codec.kind).tobytes()
        writer = None
        for batch in batches:
            ids, blocks = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            at = 0
            while at < batch.num_rows:
                texts, held = [], 0
                while at + len(texts) < batch.num_rows and held < CHARS_AT_ONCE:
                    texts.append(batch.column(1)[at + len(texts)].as_py())
                    held += len(texts[-1])
                for i, found in enumerate(codec.encode(texts), at):
                    if writer is None or writer.block != blocks[i]:
                        if writer is not None:
                            yield pa.RecordBatch.from_pydict(writer.close(), schema)
                        writer = _Writer(store, base, folder, blocks[i], codec.kind)
                    writer.add(ids[i], found + end)
                at += len(texts)
        if writer is not None:
            yield pa.RecordBatch.from_pydict(writer.close(), schema)

    placed = with_block(rows, "doc_id", block_bounds(rows, "doc_id"))
    ordered = placed.repartition("_block").sortWithinPartitions("_block", "doc_id", "text")
    return stored(ordered.mapInArrow(run, MANIFEST))


def open_records(path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of all records of a file, in order, with every checksum verified."""
    store, name = open_store(path)
    with store.open_input_stream(name[: -len("rec")] + "idx", compression=None) as index:
        kind = np.dtype("<u2" if struct.unpack("<Q", index.read(8))[0] == 2 else "<u4")
    with store.open_input_stream(name, compression=None, buffer_size=1 << 20) as source:
        while head := source.read(12):
            yield _record(head, source, kind)


def read_record(path: str, number: int) -> tuple[int | None, np.ndarray]:
    """One record of a file by its number, found through the index."""
    store, name = open_store(path)
    with store.open_input_file(name[: -len("rec")] + "idx") as index:
        size = struct.unpack("<Q", index.read_at(8, 0))[0]
        offset = struct.unpack("<Q", index.read_at(8, 8 + 8 * number))[0]
    with store.open_input_file(name) as source:
        source.seek(offset)
        return _record(source.read(12), source, np.dtype("<u2" if size == 2 else "<u4"))


def _record(head: bytes, source, kind: np.dtype) -> tuple[int | None, np.ndarray]:
    length, check = struct.unpack("<QI", head)
    if masked(head[:8]) != check:
        raise ValueError("the length of a record is damaged")
    payload = source.read(length)
    if len(payload) != length or struct.unpack("<I", source.read(4))[0] != masked(payload):
        raise ValueError("a record is damaged")
    there, doc_id = struct.unpack_from("<Bq", payload)
    return (doc_id if there else None), np.frombuffer(payload, kind, offset=9)


def read_records(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, read back from the files.

    ``start`` counts the ids of all documents before it: those of the files before (there is one line of
    the manifest per file) and those before it in its own file.
    """
    files = sorted(manifest.select("block", "path", "tokens").collect())
    starts = accumulate((f["tokens"] for f in files), initial=0)
    spark = manifest.sparkSession
    todo = spark.createDataFrame([(f["path"], s) for f, s in zip(files, starts)], "path string, start long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns)):
                out = [[], [], [], []]
                for doc_id, ids in open_records(path):
                    for column, value in zip(out, (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4")))):
                        column.append(value)
                    start += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in out], ["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    # A task per file: the list is so small that adaptive execution would make one task of it.
    return todo.repartitionByRange(max(1, len(files)), "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def recorded_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` as token records and read them back, one row per document.

    A null or empty text is the end id alone; a null doc_id comes back as null, in front of all others;
    repeated rows are records of their own; an empty table gives no file and an empty result. Columns
    other than doc_id and text are ignored.
    """
    return read_records(write_records(docs, tokenizer, end_id))
