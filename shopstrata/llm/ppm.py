"""Prediction by partial matching: log probabilities of whole texts under a byte-context trie of the corpus.

The trie holds, for every context of up to ORDER bytes, how often each byte followed it in the training texts; a text
begins after ORDER marks and ends with one, so its probability covers its length. A byte that followed the longest known
context is coded there with c / (n + q), n occurrences of q different bytes; otherwise the coder escapes with q / (n + q)
(method C) to the context that is one byte shorter, where all bytes of the longer one are excluded. What followed a
longer context also followed the shorter one, so exclusion takes one sum per context. Below order 0 all bytes that
are left are equally likely.

1. One pass cuts the texts into blocks of so many bytes, where they lie, and writes each block, compressed, beside its
   different grams (a context and its byte, as one number) and words, with their training counts.
2. The grams of all blocks are added up: the lowest level of the trie, which implies the others.
3. Partitions that hold all grams with one context of two bytes derive every level from two up by themselves; the
   two levels below are at most 65,536 counts and go to every task. Each gram gets its cost once.
4. Grams meet their costs and return to their blocks, as many as the block has, and texts are scored there. Of the
   words only those return whose count in the block is not their count in all.

So the trie is never in one place, and a task holds one block with what that block needs.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstrata.llm.common import id_remainder, shuffle_partitions, stored

ORDER = 4
MARK = b"\xff"  # occurs in no UTF-8 text
SYMBOLS = 256
BLOCK_BYTES = 16 << 20
PIECE = 1 << 20
CODEC = "zstd"
MODULUS, REMAINDER = 10, 0
DIGITS = 6
FLUSH = 1 << 20


def pieces(texts: list[bytes], order: int = ORDER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, gram) of every byte and end of ``texts``, in order, some millions at a time."""
    if not texts:
        return
    pad = MARK * order
    data = np.frombuffer(pad + pad.join(texts) + MARK, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    # Text i is at firsts[i]; its end follows at once, then the rest of the next one's marks.
    firsts = order + np.concatenate(([0], np.cumsum(sizes + order)[:-1]))
    ends = firsts + sizes
    for at in range(order, len(data), PIECE):
        stop = min(at + PIECE, len(data))
        part = data[at - order : stop].astype(np.int64)
        grams = np.zeros(stop - at, np.int64)
        for j in range(order + 1):
            grams = (grams << 8) | part[j : j + stop - at]
        places = np.arange(at, stop)
        number = np.searchsorted(ends, places)
        number[number == len(ends)] = len(ends) - 1
        real = places >= firsts[number]
        yield number[real], grams[real]


def distinct(grams: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The different grams in ascending order and their counts."""
    if not len(grams):
        return grams, np.zeros(0, np.int64)
    if counts is None:
        grams = np.sort(grams)
    else:
        order = np.argsort(grams, kind="stable")
        grams, counts = grams[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    if counts is None:
        return grams[first], np.diff(np.append(first, len(grams)))
    return grams[first], np.add.reduceat(counts, first)


def block_words(texts: list[bytes], outs: list[bool]) -> Counter:
    """The words of a block with their training counts, always in the same order."""
    words: Counter = Counter()
    for text, out in zip(texts, outs):
        if not out:
            words.update(text.lower().split())
    for text, out in zip(texts, outs):
        if out:
            for word in text.lower().split():
                words.setdefault(word, 0)
    return words


def block_grams(texts: list[bytes], outs: list[bool], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The different grams of a block with their training counts."""
    grams, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for held_out in (False, True):
        for _, some in pieces([t for t, out in zip(texts, outs) if out == held_out], order):
            g, n = distinct(some)
            grams.append(g)
            counts.append(n * 0 if held_out else n)
    return distinct(np.concatenate(grams), np.concatenate(counts))


class Level:
    """The contexts of one length: grams with counts, and per context n, q and the sum that it excludes below."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, below: Level | None, bits: int):
        self.bits, self.grams, self.counts = bits, grams, counts
        contexts = grams >> 8
        first = np.flatnonzero(np.concatenate(([True], contexts[1:] != contexts[:-1]))) if len(grams) else np.zeros(0, int)
        self.contexts = contexts[first]
        self.n = np.add.reduceat(counts, first) if len(grams) else counts
        self.q = np.diff(np.append(first, len(grams)))
        if below is None or not len(grams):
            self.excluded = np.zeros(len(first), np.int64)
        else:
            self.excluded = np.add.reduceat(below.count(grams & ((1 << below.bits) - 1)), first)

    def count(self, grams: np.ndarray) -> np.ndarray:
        return _looked_up(self.grams, self.counts, grams)

    def context(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        wanted = grams >> 8
        return tuple(_looked_up(self.contexts, x, wanted) for x in (self.n, self.q, self.excluded))


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of the sorted ``keys``, 0 where there is none."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[place] == wanted, values[place], 0)


def levels_above(low: tuple[np.ndarray, np.ndarray], grams: np.ndarray, counts: np.ndarray, order: int) -> list[Level]:
    """Levels 0 to ``order``: 0 and 1 from the pairs ``low`` of the whole corpus, the others from sorted ``grams``."""
    pairs, pair_counts = low
    levels = [Level(*distinct(pairs & 255, pair_counts), None, 8)]
    levels.append(Level(pairs, pair_counts, levels[0], 16))
    for length in range(2, order + 1):
        bits = 8 * (length + 1)
        levels.append(Level(*distinct(grams & ((1 << bits) - 1), counts), levels[-1], bits))
    return levels


def gram_costs(levels: list[Level], grams: np.ndarray) -> np.ndarray:
    """log10 of the probability of each gram's last byte after the others."""
    cost = np.zeros(len(grams))
    left = np.arange(len(grams))
    sum_out = left * 0
    kinds_out = left * 0
    for level in reversed(levels):
        some = grams[left] & ((1 << level.bits) - 1)
        count = level.count(some)
        n, q, excluded = level.context(some)
        whole, kinds = n - sum_out + q - kinds_out, q - kinds_out
        part = np.where(count > 0, count, kinds)
        coded = part > 0
        cost[left[coded]] += np.log10(part[coded] / whole[coded])
        on = count == 0
        # An unknown context excludes nothing; then no longer one was known either.
        left, sum_out, kinds_out = left[on], excluded[on], q[on]
    cost[left] -= np.log10(SYMBOLS - kinds_out)
    return cost


def _gather(batches: Iterator[pa.RecordBatch], block_bytes: int, order: int) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, held_out) as one row per block, followed by the block's grams and words with counts."""
    partition, number = TaskContext.get().partitionId(), 0
    ids, texts, outs, held = [], [], [], 0

    def closed() -> Iterator[pa.RecordBatch]:
        block, body = (partition << 32) | number, b"".join(texts)
        yield _gathered(
            block, size=pa.array([len(body)]), body=pa.array([pa.compress(body, CODEC, asbytes=True)]),
            ids=pa.array([ids], pa.list_(pa.int64())), sizes=pa.array([list(map(len, texts))]), outs=pa.array([outs]),
        )
        grams, counts = block_grams(texts, outs, order)
        yield _gathered(block, gram=pa.array(grams), n=pa.array(counts))
        words = block_words(texts, outs)
        if words:
            yield _gathered(
                block, word=pa.array(list(words), pa.binary()), place=pa.array(np.arange(len(words))),
                n=pa.array(list(words.values()), pa.int64()),
            )

    for batch in batches:
        for doc_id, text, out in zip(*(batch.column(c) for c in ("doc_id", "text", "held_out"))):
            ids.append(doc_id.as_py())
            texts.append(text.as_py() or b"")
            outs.append(out.as_py())
            held += len(texts[-1]) + 64
            if held >= block_bytes:
                yield from closed()
                ids, texts, outs, held, number = [], [], [], 0, number + 1
    if ids:
        yield from closed()


GATHERED = {
    "block": pa.int64(), "size": pa.int64(), "body": pa.binary(), "ids": pa.list_(pa.int64()),
    "sizes": pa.list_(pa.int64()), "outs": pa.list_(pa.bool_()), "gram": pa.int64(), "word": pa.binary(), "place": pa.int32(),
    "n": pa.int64(),
}
GATHERED_SCHEMA = (
    "block long, size long, body binary, ids array<long>, sizes array<long>, outs array<boolean>, "
    "gram long, word binary, place int, n long"
)


def _gathered(block: int, **columns: pa.Array) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    columns["block"] = pa.array(np.full(size, block, np.int64))
    return pa.RecordBatch.from_arrays(
        [columns[c].cast(k) if c in columns else pa.nulls(size, k) for c, k in GATHERED.items()], list(GATHERED)
    )


def _costs(low: tuple[np.ndarray, np.ndarray], order: int):
    """For partitions (gram, n) sorted by the context of two bytes and closed under it: (gram, cost)."""

    def settle(grams: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        seen = counts > 0
        levels = levels_above(low, *distinct(grams[seen], counts[seen]), order)
        return pa.RecordBatch.from_arrays([pa.array(grams), pa.array(gram_costs(levels, grams))], ["gram", "cost"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            waiting.append(batch)
            held += batch.num_rows
            if held >= FLUSH:
                grams, counts = _joined(grams, counts, waiting)
                context = (grams >> 8) & 0xFFFF
                cut = int(np.searchsorted(context, context[-1]))  # the last context may go on
                if cut:
                    yield settle(grams[:cut], counts[:cut])
                grams, counts, waiting, held = grams[cut:], counts[cut:], [], 0
        grams, counts = _joined(grams, counts, waiting)
        if len(grams):
            yield settle(grams, counts)

    return run


def _joined(grams: np.ndarray, counts: np.ndarray, batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    return (
        np.concatenate([grams, *(b.column("gram").to_numpy() for b in batches)]),
        np.concatenate([counts, *(b.column("n").to_numpy() for b in batches)]),
    )


def text_scores(texts: list[bytes], grams: np.ndarray, costs: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The summed costs of the grams of each text; ``grams`` are sorted and hold all of them."""
    bits = 8 * (order + 1)
    total = np.zeros(len(texts))
    for number, found in pieces(texts, order):
        # Sorted within each text, neighbours are looked up near each other.
        keys = np.sort(((number - number[0]) << bits) | found)
        cost = costs[np.searchsorted(grams, keys & ((1 << bits) - 1))]
        number = number[0] + (keys >> bits)
        first = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
        total[number[first]] += np.add.reduceat(cost, first)
    return total


def shrunk(values: np.ndarray) -> bytes:
    """Ascending numbers by their steps, others as they are, compressed."""
    if values.dtype == np.int64:
        values = np.diff(values, prepend=np.int64(0))
    return pa.compress(np.ascontiguousarray(values), CODEC, asbytes=True)


def grown(packed: bytes, count: int, kind) -> np.ndarray:
    values = np.frombuffer(pa.decompress(packed, 8 * count, CODEC, asbytes=True), kind)
    return np.cumsum(values) if kind == np.int64 else values


PACKED = "block long, count long, grams binary, costs binary, places binary, counts binary, firsts long"
PACKED_NAMES = [part.split()[0] for part in PACKED.split(", ")]
PACKED_KINDS = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, gram, cost) or (block, place, c, first) as one row per block and some millions of them."""

    def packed(waiting: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(waiting)
        found = []
        for key, value in (("gram", "cost"), ("place", "c")):
            some = rows.filter(pa.compute.is_valid(rows.column(key)))
            block, keys, values = (some.column(c).to_numpy() for c in ("block", key, value))
            firsts = some.column("first").to_numpy() if key == "place" else np.zeros(len(block), np.int64)
            order = np.lexsort((keys, block))
            block, keys, values, firsts = block[order], keys[order].astype(np.int64), values[order], firsts[order]
            cuts = np.flatnonzero(np.diff(block, prepend=-1))
            for a, b in zip(cuts, np.append(cuts[1:], len(block))):
                pair = (shrunk(keys[a:b]), shrunk(values[a:b].astype(np.float64)))
                pair = (*pair, None, None) if key == "gram" else (None, None, *pair)
                found.append((int(block[a]), int(b - a), *pair, int(firsts[a:b].sum())))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*found), PACKED_KINDS)], PACKED_NAMES
        )

    waiting, held = [], 0
    for batch in batches:
        waiting.append(batch)
        held += batch.num_rows
        if held >= FLUSH:
            yield packed(waiting)
            waiting, held = [], 0
    if held:
        yield packed(waiting)


SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, kinds long"
)


def _score(ends: int, order: int):
    """Scores of a block: its texts, and its grams with costs and the words whose counts it does not know.

    ``logs`` sums log10(c + 0.1) over the tokens, ``kinds`` counts the words that the block has to count for all.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, sizes, outs, size, body = (left.column(c)[0].as_py() for c in ("ids", "sizes", "outs", "size", "body"))
        body = pa.decompress(body, size, CODEC, asbytes=True)
        cuts = np.cumsum([0, *sizes]).tolist()
        texts = [body[a:b] for a, b in zip(cuts, cuts[1:])]
        counted = block_words(texts, outs)
        c = np.fromiter(counted.values(), np.int64, len(counted))
        grams, costs, kinds = [np.zeros(0, np.int64)], [np.zeros(0)], int((c > 0).sum())
        for row in right.to_pylist():
            if row["grams"] is not None:
                grams.append(grown(row["grams"], row["count"], np.int64))
                costs.append(grown(row["costs"], row["count"], np.float64))
            else:
                place = grown(row["places"], row["count"], np.int64)
                kinds += row["firsts"] - int((c[place] > 0).sum())
                c[place] = grown(row["counts"], row["count"], np.float64).astype(np.int64)
        logs = dict(zip(counted, np.log10(c + 0.1).tolist()))
        unknown = {w for w, n in zip(counted, c.tolist()) if not n}
        end = math.log10(ends + 0.1)
        keys = np.concatenate(grams)
        place = np.argsort(keys)
        scores = text_scores(texts, keys[place], np.concatenate(costs)[place], order)
        found = []
        for text, out in zip(texts, outs):
            tokens = text.lower().split()
            known = len(tokens) + (ends > 0) - (sum(w in unknown for w in tokens) if out else 0)
            found.append((len(tokens) + 1, known, math.fsum([end, *map(logs.__getitem__, tokens)])))
        n, known, sums = zip(*found)
        arrays = [
            pa.array(ids, pa.int64()), pa.array(outs), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
            pa.array(sums), pa.array(scores), pa.array([kinds] + [0] * (len(ids) - 1), pa.int64()),
        ]
        return pa.Table.from_arrays(arrays, [c.split()[0] for c in SCORED.split(", ")])

    return run


def language_scores(
    docs: DataFrame,
    modulus: int = MODULUS,
    remainder: int = REMAINDER,
    order: int = ORDER,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs`` (doc_id, text).

    Learns from the rows whose id has another crc32 modulo ``modulus`` than ``remainder``; a null id is learnt from, and a
    repeated row counts as often as it occurs. A null text is empty: one end. ``base_score`` is the log10
    probability of the tokens (lower-cased words and the end) one by one, ``score`` that of the text's bytes by partial
    matching; both have six decimals. Without training rows every byte has one chance in 256. An empty table has no rows.
    """
    if not 2 <= order <= 6:
        raise ValueError("order must be 2 to 6: a gram is one long")
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").cast("binary").alias("text"),
        F.coalesce(id_remainder(F.col("doc_id"), modulus) == remainder, F.lit(False)).alias("held_out"),
    )
    gathered = stored(rows.mapInArrow(lambda batches: _gather(batches, block_bytes, order), GATHERED_SCHEMA))
    blocks = gathered.where("body IS NOT NULL").select(F.col("block").alias("home"), "size", "body", "ids", "sizes", "outs")
    pairs = gathered.where("gram IS NOT NULL").select("block", "gram", "n")
    words = gathered.where("word IS NOT NULL").select("block", "word", "place", "n")
    ends = blocks.agg(F.sum(F.size(F.filter("outs", lambda out: ~out)))).first()[0] or 0
    total = words.agg(F.sum("n")).first()[0] or 0

    low = sorted(
        tuple(r) for r in pairs.where("n > 0").groupBy(F.col("gram").bitwiseAND(0xFFFF)).agg(F.sum("n")).collect()
    )
    low = tuple(np.array(x, np.int64) for x in (zip(*low) if low else ([], [])))
    context = F.shiftright("gram", 8).bitwiseAND(0xFFFF)
    trie = pairs.groupBy("gram").agg(F.sum("n").alias("n"))
    # By ranges, which are measured, since contexts differ much in size.
    dealt = trie.repartitionByRange(shuffle_partitions(spark), context).sortWithinPartitions(context)
    costs = dealt.mapInArrow(_costs(low, order), "gram long, cost double")

    # A word has at most one row per block. Where one block has all of its occurrences, that block counts it; else the
    # row with the most is the first, and all return.
    same = Window.partitionBy("word")
    counted = words.select(
        "block", "place", "n", F.sum("n").over(same).alias("c"),
        (F.row_number().over(same.orderBy(F.desc("n"), "block")) == 1).cast("long").alias("first"),
    ).where("c <> n").select("block", "place", "c", "first")
    needs = (pairs.select("block", "gram").join(costs, "gram").select("block", "gram", "cost")
             .unionByName(counted, allowMissingColumns=True).mapInArrow(_pack, PACKED))
    parts = max(shuffle_partitions(spark), blocks.count())
    scored = stored(
        blocks.repartition(parts, "home").groupBy("home")
        .cogroup(needs.repartition(parts, "block").groupBy("block")).applyInArrow(_score(ends, order), SCORED)
    )
    tokens, kinds = total + ends, (scored.agg(F.sum("kinds")).first()[0] or 0) + (ends > 0)
    scale = math.log10(tokens + 0.1 * (kinds + 1))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        F.round(F.col("logs") - F.col("n_tokens") * F.lit(scale), DIGITS).alias("base_score"),
        F.round("score", DIGITS).alias("score"),
    )
