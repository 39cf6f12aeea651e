"""Repeated byte strings by sorted suffixes.

Every byte that lies in a string of LENGTH bytes which also starts earlier is found, over all documents.
Sorting a suffix for every byte would move a hundred times the corpus, so suffixes are sampled by content:
of the grams of GRAM bytes within each string, the one with the smallest hash (the leftmost of equals) is
its anchor. Equal strings have the same anchor at the same place, and an anchor serves a run of strings.

1. Each document yields its anchors with the hash of the gram and the hash of all bytes that the run of
   strings covers (the context). Anchors are dealt by gram. Of equal contexts the earliest stays and the runs
   of the others are repeated; copies within a task collapse before they are sent. A gram with many contexts
   in one task needs its bytes in any case: all but two of these are dealt by context, not by gram, so that no
   task gets all places of a very frequent gram.
2. Grams with two different contexts or more are the edges of repeated passages (and single edits). Only for
   those the bytes are fetched. Their suffixes from the anchor on are range-partitioned by sampled splitters
   over their leading bytes, so that a gram with very many contexts is spread over many tasks.
3. Consecutive sorted suffixes make buckets that end between two grams if they can. The strings of a bucket's
   runs are sorted by a multikey quicksort over characters of eight bytes, and of equal strings all but the
   earliest are repeated.
4. Where one gram goes on in another bucket, a string can have an equal there if its part of the suffix is
   shared with the suffix at the boundary. Runs with such strings are sorted once more, by the bytes in
   front of the anchor, and compared in the same way. What may still cross a boundary then has its part on
   both sides in common with the whole bucket, so few strings per bucket are left; they meet by their bytes.

Steps 3 and 4 compare bytes; step 1 relies on 128 bits of hash for equality of contexts, and
rows are told apart by their id and 128 bits of hash of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstrata.llm.common import shuffle_partitions, stored
from shopstrata.llm.ordering import LEAST_LONG

LENGTH = 100
GRAM = 24
# Bytes that are hashed at once; the place within them takes that many bits of a key.
PLACE_BITS = 20
PIECE = 1 << PLACE_BITS
# Anchors that a task gathers before it sends them, and suffixes of one gram that it compares at once.
HELD = 1 << 19
BUCKET = 10_000
# Contexts of one gram in a task above which they are spread.
SPREAD = 32
# What a packed row holds: contexts by gram, repeated runs that are only passed on, contexts that need bytes.
_PLAIN, _SETTLED, _SPREAD = range(3)
_MASK = np.uint64(PIECE - 1)
# Odd multipliers and byte values of the polynomial hash: any would do, all tasks need the same.
_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.Generator(np.random.PCG64(20240501)).integers(0, 2**64, 256, dtype=np.uint64)
_LEFT, _RUN = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA5A5A5A5A5A5A5A7)
# A row of the table: its id and 128 bits of hash of its text, so that rows with one id or none stay apart.
ROW = ["_id", "_hash", "_more"]
PACKED = "bucket int, kind int, ids binary, hashes binary, more binary, counts binary, code binary, grams binary, contexts binary"
RUNS = "_id long, _hash long, _more long, need boolean, code long"
SUFFIXES = "right binary, left binary, _id long, _hash long, _more long, code long"
OPEN = SUFFIXES + ", key binary, settled boolean, first long, last long"
FOUND = "key binary, settled boolean, _id long, _hash long, _more long, first long, last long"


def _powers(base: int) -> np.ndarray:
    found = np.full(PIECE + 1, base, np.uint64)
    found[0] = 1
    return np.multiply.accumulate(found)


_cache: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    if not _cache:
        _cache["up"], _cache["down"] = _powers(_BASE), _powers(pow(_BASE, -1, 2**64))
    return _cache["up"], _cache["down"]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def _least_in_windows(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours, by doubling."""
    span = 1
    while 2 * span <= width:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    return np.minimum(keys[: len(keys) - (width - span)], keys[width - span :]) if span < width else keys


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of strings with a common anchor in the texts that ``data`` holds one after the other.

    ``ends`` are the ends of the texts; strings do not cross them. Returns, per run, the text, the start
    of its first string, the distance to the anchor, the number of further strings, and both hashes.
    """
    up, down = _tables()
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[:n], out=sums[1:])
    grams = (sums[gram:] - sums[:-gram]) * down[: n - gram + 1]
    keys = _mixed(grams) & ~_MASK | np.arange(len(grams), dtype=np.uint64)
    owner = (_least_in_windows(keys, length - gram + 1) & _MASK).astype(np.int64)
    starts = np.concatenate(([0], ends[:-1]))
    # Strings that end within the text in which they start.
    inside = np.zeros(len(owner) + 1, np.int64)
    have = ends - starts >= length
    np.add.at(inside, starts[have], 1)
    np.add.at(inside, ends[have] - length + 1, -1)
    valid = np.cumsum(inside[:-1]) > 0
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (valid[1:] != valid[:-1])
    new[starts[have]] = True
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(owner)) - 1
    first, last = first[valid[first]], last[valid[first]]
    middle = owner[first]
    context = (sums[last + length] - sums[first]) * down[first]
    context = _mixed(context + (middle - first).astype(np.uint64) * _LEFT + (last - first).astype(np.uint64) * _RUN)
    text = np.searchsorted(ends, first, side="right")
    return text, first - starts[text], middle - first, last - first, grams[middle], context


def coded(first, left, further):
    """A run in one long: start of its first string, distance to the anchor, number of further strings."""
    return first.astype(np.int64) << 16 | left.astype(np.int64) << 8 | further.astype(np.int64)


def _texts(raw: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(data, ends, number of each text, offset of each text) in pieces of bounded size.

    A text longer than a piece is cut so that every string of it lies in one of the parts.
    """
    parts, numbers, offsets, held = [], [], [], 0

    def out():
        return (
            np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts]),
            np.array(numbers, np.int64), np.array(offsets, np.int64),
        )

    for number, text in enumerate(raw):
        at = 0
        while len(text) - at >= length:
            part = text[at : at + PIECE]
            if parts and held + len(part) > PIECE:
                yield out()
                parts, numbers, offsets, held = [], [], [], 0
            parts.append(part)
            numbers.append(number)
            offsets.append(at)
            held += len(part)
            at += len(part) - length + 1
    if parts:
        yield out()


def _ordered(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """The columns in the order of the first, then the second, and so on."""
    order = np.lexsort(columns[::-1])
    return tuple(c[order] for c in columns)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where any of the columns differs from the row before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def _pack(bucket: int, kind: int, ids, hashes, more, code, grams, contexts) -> tuple:
    """One row for many anchors; ids of one document are written once."""
    new = _changes(ids, hashes, more)
    counts = np.diff(np.append(np.flatnonzero(new), len(ids)))
    return (
        bucket, kind, ids[new].tobytes(), hashes[new].tobytes(), more[new].tobytes(), counts.astype(np.uint32).tobytes(),
        code.tobytes(), grams.tobytes(), contexts.tobytes(),
    )


def _unpack(row: dict) -> tuple[np.ndarray, ...]:
    counts = np.frombuffer(row["counts"], np.uint32)
    return (
        *(np.repeat(np.frombuffer(row[c], np.int64), counts) for c in ("ids", "hashes", "more")),
        np.frombuffer(row["code"], np.int64), np.frombuffer(row["grams"], np.uint64),
        np.frombuffer(row["contexts"], np.uint64),
    )


def _packed_schema() -> pa.Schema:
    return pa.schema(
        [("bucket", pa.int32()), ("kind", pa.int32())]
        + [(n, pa.binary()) for n in ("ids", "hashes", "more", "counts", "code", "grams", "contexts")]
    )


def _gather(length: int, gram: int, buckets: int, spread: int):
    """Step 1 in the tasks that read the documents: anchors, copies within the task already settled."""
    schema = _packed_schema()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def send(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        grams, contexts, ids, hashes, more, code = _ordered(*(np.concatenate(c) for c in zip(*held)))
        distinct = _changes(grams, contexts, ids, hashes, more, code)  # repeated rows of the table are one document
        grams, contexts, ids, hashes, more, code = (c[distinct] for c in (grams, contexts, ids, hashes, more, code))
        earliest = _changes(grams, contexts)
        # Runs that are settled here are spread by document and carry no hashes.
        kind = np.where(earliest, _PLAIN, _SETTLED)
        bucket = np.where(earliest, (grams % np.uint64(buckets)).astype(np.int64), ids % buckets)
        group = np.cumsum(_changes(grams)) - 1
        upto = np.cumsum(earliest)
        before = upto[np.flatnonzero(_changes(grams))] - 1
        many = earliest & (np.bincount(group, weights=earliest)[group] > spread) & (upto - before[group] > 2)
        kind[many] = _SPREAD
        bucket[many] = (contexts[many] % np.uint64(buckets)).astype(np.int64)
        bucket, kind, ids, hashes, more, code, grams, contexts = _ordered(
            bucket, kind, ids, hashes, more, code, grams, contexts
        )
        cuts = np.flatnonzero(_changes(bucket, kind))
        for a, b in zip(cuts, np.append(cuts[1:], len(bucket))):
            c = a if kind[a] == _SETTLED else b
            yield batch_of(
                [_pack(int(bucket[a]), int(kind[a]), *(x[a:b] for x in (ids, hashes, more, code)), grams[a:c], contexts[a:c])]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids, hashes, more = (part.column(i).to_numpy(zero_copy_only=False) for i in range(3))
                raw = [t.as_buffer().to_pybytes() for t in part.column(3)]
                for data, ends, numbers, offsets in _texts(raw, length):
                    text, first, left, further, grams, contexts = anchors(data, ends, length, gram)
                    row = numbers[text]
                    code = coded(first + offsets[text], left, further)
                    held.append((grams, contexts, ids[row], hashes[row], more[row], code))
                    count += len(first)
                    if count >= HELD:
                        yield from send(held)
                        held, count = [], 0
        if count:
            yield from send(held)

    return run


def _settle():
    """Step 1 where a bucket of grams has come together: repeated runs, and those that need bytes."""

    def rows(ids, hashes, more, code, need: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(hashes), pa.array(more), pa.array(np.full(len(ids), need)), pa.array(code)],
            ["_id", "_hash", "_more", "need", "code"],
        )

    def joined(held: list[tuple]) -> tuple[np.ndarray, ...]:
        """All places of the distinct contexts, earliest first, and which of them are the earliest."""
        ids, hashes, more, code, grams, contexts = (np.concatenate(c) for c in zip(*held))
        grams, contexts, ids, hashes, more, code = _ordered(grams, contexts, ids, hashes, more, code)
        distinct = _changes(grams, contexts, ids, hashes, more, code)
        grams, contexts, ids, hashes, more, code = (c[distinct] for c in (grams, contexts, ids, hashes, more, code))
        return grams, (ids, hashes, more, code), _changes(grams, contexts)

    def plain(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        # Grams that occur once are the bulk; they go before anything is sorted as a whole.
        grams = np.concatenate([part[4] for part in held])
        order = np.argsort(grams, kind="stable")
        group = np.cumsum(_changes(grams[order])) - 1
        often = np.zeros(len(grams), bool)
        often[order] = np.bincount(group)[group] > 1
        cuts = np.cumsum([len(part[4]) for part in held])[:-1]
        held = [tuple(c[use] for c in part) for part, use in zip(held, np.split(often, cuts))]
        if not often.any():
            return
        grams, places, earliest = joined(held)
        yield rows(*(c[~earliest] for c in places), need=False)
        group = np.cumsum(_changes(grams[earliest])) - 1
        need = np.flatnonzero(earliest)[np.bincount(group)[group] > 1]
        yield rows(*(c[need] for c in places), need=True)

    def spread(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        _, places, earliest = joined(held)
        for need, use in ((False, ~earliest), (True, earliest)):
            yield rows(*(c[use] for c in places), need=need)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, {_PLAIN: [], _SPREAD: []}

        def finish() -> Iterator[pa.RecordBatch]:
            if held[_PLAIN]:
                yield from plain(held[_PLAIN])
            if held[_SPREAD]:
                yield from spread(held[_SPREAD])
            held[_PLAIN], held[_SPREAD] = [], []

        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    yield from finish()
                    bucket = row["bucket"]
                parts = _unpack(row)
                if row["kind"] == _SETTLED:
                    yield rows(*parts[:4], need=False)
                else:
                    held[row["kind"]].append(parts)
        yield from finish()

    return run


def _cut(length: int):
    """The bytes of runs: the suffix from the anchor on and what lies before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, more, texts, codes = (batch.column(n) for n in ("_id", "_hash", "_more", "text", "codes"))
            out: list[tuple] = []
            for i in range(batch.num_rows):
                data = texts[i].as_buffer().to_pybytes()
                for code in set(codes[i].as_py()):
                    first, left, further = code >> 16, code >> 8 & 255, code & 255
                    out.append((data[first + left : first + further + length], data[first : first + left],
                                ids[i].as_py(), hashes[i].as_py(), more[i].as_py(), code))
                if len(out) > 20_000 or (out and i == batch.num_rows - 1):
                    kinds = (pa.binary(), pa.binary(), *[pa.int64()] * 4)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["right", "left", "_id", "_hash", "_more", "code"]
                    )
                    out = []

    return run


def equal_runs(group: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort over rows of 64-bit characters, within groups.

    One character at a time, rows that still tie are parted into equal stretches by numpy's sort; rows that
    stand alone are finished and leave. Returns the rows that equal another one in all characters, in
    stretches, and the number of the stretch of each.
    """
    rows = np.argsort(group, kind="stable")
    stretch = group[rows]
    for k in range(-1, words.shape[1]):
        if k >= 0:
            value = words[rows, k]
            order = np.lexsort((value, stretch))
            rows, stretch, value = rows[order], stretch[order], value[order]
            stretch = np.cumsum(_changes(stretch, value)) - 1
        else:
            stretch = np.cumsum(_changes(stretch)) - 1 if len(rows) else stretch
        if not len(rows):
            break
        tie = np.bincount(stretch)[stretch] > 1
        rows, stretch = rows[tie], stretch[tie]
    return rows, stretch


def _common(block: np.ndarray, sizes: np.ndarray, row: int) -> np.ndarray:
    """Length of the common prefix of every row of padded bytes with one of them."""
    differs = block != block[row]
    at = np.where(differs.any(1), differs.argmax(1), block.shape[1])
    return np.minimum(at, np.minimum(sizes, sizes[row]))


def _padded(parts: list[bytes], width: int, right: bool) -> np.ndarray:
    """Bytes as rows of ``width``, filled up with zeros in front (``right``) or behind."""
    fill = bytes.rjust if right else bytes.ljust
    return np.frombuffer(b"".join([fill(p, width, b"\0") for p in parts]), np.uint8).reshape(len(parts), width)


def _cuts(batches: Iterator[pa.RecordBatch], gram: int, most: int) -> Iterator[tuple[pa.Table, bool, bool]]:
    """Buckets of sorted suffixes, and whether their first and last gram may go on in another bucket."""
    held, opened = None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows]).combine_chunks()
        grams = pc.binary_slice(rows.column("right"), 0, gram)
        last = pc.index(grams, grams[-1]).as_py()
        if last:
            yield rows.slice(0, last), opened, False
            opened = False
        held = rows.slice(last)
        if held.num_rows >= most:
            yield held, opened, True
            held, opened = None, True
    if held is not None:
        yield held, opened, True


def _compare(rows: pa.Table, length: int, gram: int, ends: list[int], by_left: bool) -> dict[str, np.ndarray]:
    """The strings of a bucket: their row, distance to the anchor and start, whether they are repeated
    within it, and whether they may have an equal beyond the rows ``ends`` at its open boundaries."""
    reach, words, n = length - gram, -(-length // 8), rows.num_rows
    right, left = rows.column("right").to_pylist(), rows.column("left").to_pylist()
    ids, hashes, more, code = (rows.column(c).to_numpy() for c in ("_id", "_hash", "_more", "code"))
    tails, heads = _padded(right, length, False), _padded(left, reach, True)
    grams = tails[:, :gram]
    group = np.cumsum(_changes(*grams.T)) - 1
    shared = np.full(n, -1)
    for end in ends:
        if by_left:
            common = _common(heads[:, ::-1], np.array([len(x) for x in left]), end)
        else:
            common = _common(tails, np.array([len(x) for x in right]), end)
        shared = np.maximum(shared, np.where(group == group[end], common, -1))
    further = (code & 255) + 1
    row = np.repeat(np.arange(n), further)
    step = np.arange(len(row)) - np.repeat(np.cumsum(further) - further, further)
    ahead = (code[row] >> 8 & 255) - step
    start = (code[row] >> 16) + step
    crossing = (ahead if by_left else length - ahead) <= shared[row]
    use = (np.bincount(group)[group] > 1)[row] | crossing
    row, ahead, start, crossing = row[use], ahead[use], start[use], crossing[use]
    repeated = np.zeros(len(row), bool)
    strings = np.empty((0, length), np.uint8)
    if len(row):
        block = np.concatenate((heads, tails), axis=1)
        strings = np.lib.stride_tricks.sliding_window_view(block, length, axis=1)[row, reach - ahead]
        wide = np.zeros((len(row), 8 * words), np.uint8)
        wide[:, :length] = strings
        ties, stretch = equal_runs(group[row] * (reach + 1) + ahead, wide.view(">u8").astype(np.uint64))
        if len(ties):
            order = np.lexsort((start[ties], more[row[ties]], hashes[row[ties]], ids[row[ties]], stretch))
            ties, stretch = ties[order], stretch[order]
            head = np.flatnonzero(_changes(stretch))
            top = ties[np.repeat(head, np.diff(np.append(head, len(ties))))]
            same = start[ties] == start[top]
            for part in (ids, hashes, more):
                same &= part[row[ties]] == part[row[top]]
            repeated[ties[~same]] = True
    return {"row": row, "ahead": ahead, "start": start, "repeated": repeated, "crossing": crossing & ~repeated,
            "strings": strings, "ids": ids, "hashes": hashes, "more": more}


def _stretches(found: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First and last string of each stretch of repeated strings that follow each other in a run."""
    at = np.flatnonzero(found["repeated"])
    if not len(at):
        return at, at
    row, start = found["row"], found["start"]
    new = np.ones(len(at), bool)
    new[1:] = (row[at[1:]] != row[at[:-1]]) | (start[at[1:]] != start[at[:-1]] + 1)
    return at[new], at[np.append(np.flatnonzero(new)[1:], len(at)) - 1]


def _batch(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    """A batch of ``n`` rows; columns that are not given are null."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema
    )


def _ends(first: bool, last: bool, n: int) -> list[int]:
    return [0] * first + [n - 1] * last


def _by_suffix(length: int, gram: int, most: int):
    """Step 3: repeated strings of sorted suffixes, and the runs that are to be sorted from the other side."""
    schema = pa.schema(
        [("right", pa.binary()), ("left", pa.binary()), ("_id", pa.int64()), ("_hash", pa.int64()), ("_more", pa.int64()),
         ("code", pa.int64()), ("key", pa.binary()), ("settled", pa.bool_()), ("first", pa.int64()), ("last", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, first, last in _cuts(batches, gram, most):
            found = _compare(rows, length, gram, _ends(first, last, rows.num_rows), by_left=False)
            row, start, ahead = found["row"], found["start"], found["ahead"]
            low, high = _stretches(found)
            if len(low):
                yield _batch(
                    schema, len(low), settled=np.full(len(low), True), _id=found["ids"][row[low]],
                    _hash=found["hashes"][row[low]], _more=found["more"][row[low]], first=start[low], last=start[high],
                )
            at = np.flatnonzero(found["crossing"])
            if len(at):
                new = _changes(row[at])
                low, high = at[new], at[np.append(np.flatnonzero(new)[1:], len(at)) - 1]
                right, left = rows.column("right"), rows.column("left")
                tails = [right[r].as_py()[: length - a] for r, a in zip(row[low].tolist(), ahead[high].tolist())]
                heads = [left[r].as_py()[len(left[r].as_py()) - a :] for r, a in zip(row[low].tolist(), ahead[low].tolist())]
                yield _batch(
                    schema, len(low), settled=np.full(len(low), False), _id=found["ids"][row[low]],
                    _hash=found["hashes"][row[low]], _more=found["more"][row[low]], right=tails, left=heads,
                    key=[t[:gram] + h[::-1] for t, h in zip(tails, heads)],
                    code=coded(start[low], ahead[low], start[high] - start[low]),
                )

    return run


def _by_left(length: int, gram: int, most: int):
    """Step 4: the same for runs sorted by what lies in front of the anchor; strings still open by their bytes."""
    schema = pa.schema(
        [("key", pa.binary()), ("settled", pa.bool_()), ("_id", pa.int64()), ("_hash", pa.int64()),
         ("_more", pa.int64()), ("first", pa.int64()), ("last", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, first, last in _cuts(batches, gram, most):
            found = _compare(rows, length, gram, _ends(first, last, rows.num_rows), by_left=True)
            row, start = found["row"], found["start"]
            low, high = _stretches(found)
            if len(low):
                ids = found["ids"][row[low]]
                yield _batch(
                    schema, len(low), key=[i.to_bytes(8, "big", signed=True) for i in ids.tolist()],
                    settled=np.full(len(low), True), _id=ids, _hash=found["hashes"][row[low]], _more=found["more"][row[low]],
                    first=start[low], last=start[high],
                )
            at = np.flatnonzero(found["crossing"])
            if len(at):
                yield _batch(
                    schema, len(at), key=[s.tobytes() for s in found["strings"][at]], settled=np.full(len(at), False),
                    _id=found["ids"][row[at]], _hash=found["hashes"][row[at]], _more=found["more"][row[at]],
                    first=start[at], last=start[at],
                )

    return run


def spans(starts: np.ndarray, lasts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal stretches of bytes that strings starting in [start, last] cover."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(starts.tolist(), (lasts + length).tolist())):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _apply(length: int):
    """What is left of each text."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("_id", pa.int64()), ("_hash", pa.int64()), ("_more", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
         ("kept_sha256", pa.string()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = list(zip(*(batch.column(n).to_pylist() for n in ("doc_id", *ROW))))
            texts, found = batch.column("text"), batch.column("runs")
            out = []
            for i in range(batch.num_rows):
                data = texts[i].as_buffer().to_pybytes()
                runs = found[i].values
                if runs is None or not len(runs):
                    gone = []
                else:
                    gone = spans(runs.field(0).to_numpy(), runs.field(1).to_numpy(), length)
                digest, at = hashlib.sha256(), 0
                for a, b in gone:
                    digest.update(data[at:a])
                    at = b
                digest.update(data[at:])
                out.append((*names[i], len(data), sum(b - a for a, b in gone), len(gone), digest.hexdigest(),
                            [{"start": a, "stop": b} for a, b in gone]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


RESULT = (
    "doc_id long, _id long, _hash long, _more long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
    "removed array<struct<start:bigint,stop:bigint>>"
)


def repeated_bytes(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET, spread: int = SPREAD
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed) per row of ``docs`` (doc_id, text).

    Bytes covered by a string of ``length`` bytes that also starts earlier are removed; earlier is a smaller
    doc_id or an earlier place in the same document, and strings are judged on the input. A null id comes before
    all others; rows with equal ids and different texts are in the order of a hash of the text; of rows that are
    equal the first stays and the others are repeated as a whole (where they have ``length`` bytes). A null text
    counts as empty. ``removed`` lists the spans. An empty table gives an empty result; columns of other names are
    ignored. ``bucket`` bounds the suffixes of one gram that a task compares at once, ``spread``
    the contexts of one gram that a task sends to one place; neither changes results.
    """
    if not 0 < gram <= length or length - gram > 254:
        raise ValueError("the gram must fit into the string, at most 254 bytes shorter")
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long"), text.alias("text")).select(
        "doc_id", F.coalesce("doc_id", F.lit(LEAST_LONG)).alias("_id"),
        F.xxhash64("text").alias("_hash"), F.xxhash64(F.lit(1), "text").alias("_more"), "text",
    )
    buckets = shuffle_partitions(spark)
    runs = stored(
        keyed.select(*ROW, "text").mapInArrow(_gather(length, gram, buckets, spread), PACKED)
        .repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_settle(), RUNS)
    )
    wanted = runs.where("need").groupBy(*ROW).agg(F.collect_list("code").alias("codes"))
    suffixes = stored(
        keyed.join(wanted, ROW).select(*ROW, "text", "codes").mapInArrow(_cut(length), SUFFIXES)
    )
    sorted_once = suffixes.repartitionByRange("right", *ROW, "code").sortWithinPartitions("right", *ROW, "code")
    found = stored(sorted_once.mapInArrow(_by_suffix(length, gram, bucket), OPEN))
    again = found.where("NOT settled").select(*suffixes.columns, "key")
    sorted_left = again.repartitionByRange("key", *ROW, "code").sortWithinPartitions("key", *ROW, "code")
    # At most one of each kind of string comes from a bucket.
    order = F.struct(*ROW, "first")
    across = Window.partitionBy("key", "settled")
    late = (
        sorted_left.mapInArrow(_by_left(length, gram, bucket), FOUND)
        .withColumn("_best", F.min(order).over(across)).where(F.col("settled") | (F.col("_best") != order))
        .select(*ROW, "first", "last")
    ).unionByName(found.where("settled").select(*ROW, "first", "last"))
    code = F.col("code")
    first = F.shiftright(code, 16)
    sure = runs.where("NOT need").select(
        *ROW, first.alias("first"), (first + code.bitwiseAND(255)).alias("last")
    )
    repeated = sure.unionByName(late).groupBy(*ROW).agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    marked = keyed.join(repeated, ROW, "left").select("doc_id", *ROW, "text", "runs").mapInArrow(_apply(length), RESULT)
    kept = stored(marked.withColumn("_row", F.monotonically_increasing_id()))
    # Equal rows have equal results; which of them is the first is told without their texts.
    firsts = kept.groupBy(*ROW).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_copies")).where("_copies > 1")
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"]
    if not firsts.limit(1).count():
        return kept.select(columns)
    gone = (F.col("_row") > F.col("_first")) & (F.col("n_bytes") >= length)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
    return kept.join(firsts, ROW, "left").withColumns(
        {
            "n_removed": F.when(gone, F.col("n_bytes")).otherwise(F.col("n_removed")),
            "n_spans": F.when(gone, F.lit(1).cast("long")).otherwise(F.col("n_spans")),
            "kept_sha256": F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")),
            "removed": F.when(gone, whole).otherwise(F.col("removed")),
        }
    ).select(columns)
