"""SimHash near duplicates by anchor points.

Two fingerprints that differ in at most two bits are found through a covering code: every
fingerprint lies within the covering radius of one anchor (its home), so a fingerprint that is at
most two bits away lies within radius plus two of that anchor. The code is the product of two
perfect Golay codes (23 bits, 4096 anchors, radius 3) on the low 46 bits, which gives 2^24 anchors.
Radius and distance are kept per half: a probe goes to an anchor if the distances beyond the radius
in both halves add up to two or less, 61 anchors on average. Bits above the 46th do not matter for
the anchors; the full distance is compared at the anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstrata.llm.common import row_key, stored
from shopstrata.llm.components import components

SEED = 42
BITS = 23
RADIUS = 3
# Generator polynomial of the binary Golay code of length 23 (a fixed value).
GENERATOR = 0b110001110101
HALF = (1 << BITS) - 1
# Homes of one anchor that one task compares; a fuller anchor is split.
MAX_HOMES = 4096
PAIRS_AT_ONCE = 1 << 21


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the word shingles of a whole text, repeats included; 0 without any word."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    span = min(shingle, len(words))
    starts = np.concatenate(([0], ends[: len(words) - span] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, ends[span - 1 :].tolist())),
        np.uint64,
        len(starts),
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    packed = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, _id, _hash, fingerprint as a signed long) per row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(found, pa.int64())], ["doc_id", "_id", "_hash", "fingerprint"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), *row_key(), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, _id long, _hash long, fingerprint long")


@lru_cache(1)
def _golay():
    """Syndromes of low and high parts, and error patterns by syndrome for levels 0, 1, 2.

    Level 0 is the one pattern within the radius, levels 1 and 2 those one and two beyond it.
    """

    def remainder(word: int) -> int:
        for bit in range(BITS - 1, BITS - 13, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    low = np.array([remainder(i) for i in range(1 << 12)], np.int64)
    high = np.array([remainder(i << 12) for i in range(1 << 11)], np.int64)
    levels = []
    for weights in (range(RADIUS + 1), [RADIUS + 1], [RADIUS + 2]):
        found = np.array(
            [sum(1 << i for i in c) for w in weights for c in combinations(range(BITS), w)], np.int64
        )
        syndrome = low[found & 0xFFF] ^ high[found >> 12]
        order = np.argsort(syndrome, kind="stable")
        counts = np.bincount(syndrome, minlength=1 << 11)
        levels.append((found[order], counts, np.concatenate(([0], np.cumsum(counts)[:-1]))))
    return low, high, levels


def _syndrome(part: np.ndarray) -> np.ndarray:
    low, high, _ = _golay()
    return low[part & 0xFFF] ^ high[part >> 12]


def homes(prints: np.ndarray) -> np.ndarray:
    """The home anchor of each fingerprint."""
    leader, _, first = _golay()[2][0]
    a, b = prints & HALF, prints >> BITS & HALF
    return a ^ leader[first[_syndrome(a)]] | (b ^ leader[first[_syndrome(b)]]) << BITS


def anchors(prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of the fingerprint, anchor) for every anchor that it is sent to, its home first."""
    levels = _golay()[2]
    a, b = prints & HALF, prints >> BITS & HALF
    sa, sb = _syndrome(a), _syndrome(b)
    for la, lb in ((0, 0), (0, 1), (1, 0), (0, 2), (2, 0), (1, 1)):
        (pa_, ca, fa), (pb, cb, fb) = levels[la], levels[lb]
        count = ca[sa] * cb[sb]
        index = np.repeat(np.arange(len(prints)), count)
        within = np.arange(len(index)) - np.repeat(np.cumsum(count) - count, count)
        wide = cb[sb][index]
        first = pa_[fa[sa][index] + within // wide]
        second = pb[fb[sb][index] + within % wide]
        yield index, (a[index] ^ first) | (b[index] ^ second) << BITS


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links reduced to (node, root), fewer than nodes, with the same components."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[left], root[right])
        was = root.copy()
        np.minimum.at(root, was[left], least)
        np.minimum.at(root, was[right], least)
        root = root[root]
        if np.array_equal(root, was) and (root[left] == root[right]).all():
            break
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _compare(distance: int):
    """Links within groups of rows (anchor, chunk, home, fingerprint), sorted with homes first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if carried is not None:
                columns = [np.concatenate((c, x)) for c, x in zip(carried, columns)]
            anchor, chunk, home, prints = columns
            new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (chunk[1:] != chunk[:-1])))
            start = np.flatnonzero(new)
            size = np.diff(np.append(start, len(anchor)))
            group = np.cumsum(new) - 1
            at = np.flatnonzero(home.astype(bool))
            last = at[at >= start[-1]]
            carried = [c[last] for c in columns]
            work = size[group[at]]
            a_found, b_found = [], []
            cuts = np.searchsorted(np.cumsum(work), np.arange(PAIRS_AT_ONCE, work.sum(), PAIRS_AT_ONCE))
            for part in np.split(np.arange(len(at)), cuts):
                if not len(part):
                    continue
                one = np.repeat(at[part], work[part])
                base = np.cumsum(work[part]) - work[part]
                other = np.arange(len(one)) - np.repeat(base, work[part]) + np.repeat(
                    start[group[at[part]]], work[part]
                )
                x, y = prints[one], prints[other]
                near = (np.bitwise_count((x ^ y).view(np.uint64)) <= distance) & (x != y)
                if near.any():
                    a, b = forest(x[near], y[near])
                    a_found.append(a)
                    b_found.append(b)
            if a_found:
                a, b = forest(np.concatenate(a_found), np.concatenate(b_found))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def links(prints: DataFrame, distance: int = 2, max_homes: int = MAX_HOMES) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints at most ``distance`` <= 2 bits apart.

    Not every pair is returned, but a forest with the same components: within a task, n linked
    fingerprints give n - 1 rows. An anchor that is home to more than ``max_homes`` fingerprints is
    split: its homes are dealt to chunks by hash, and its probes go to every chunk.
    """
    if distance > 2:
        raise ValueError("the anchors cover distances up to two")

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = homes(batch.column(0).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array(found)], ["anchor"])

    def to_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(every), 2048):
                part = every[at : at + 2048]
                for k, (index, anchor) in enumerate(anchors(part)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor), pa.array(part[index]), pa.array(np.full(len(index), k == 0))],
                        ["anchor", "fingerprint", "home"],
                    )

    prints = prints.select("fingerprint")
    full = stored(
        prints.mapInArrow(at_home, "anchor long").groupBy("anchor").count()
        .where(F.col("count") > max_homes)
        .select("anchor", F.ceil(F.col("count") / max_homes).cast("int").alias("chunks"))
    )
    dealt = prints.mapInArrow(to_anchors, "anchor long, fingerprint long, home boolean")
    if full.isEmpty():
        dealt = dealt.withColumn("chunk", F.lit(0))
    else:
        own = F.pmod(F.xxhash64("fingerprint"), F.coalesce("chunks", F.lit(1))).cast("int")
        every = F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)
        dealt = (
            dealt.join(full, "anchor", "left")
            .withColumn("own", own)
            .withColumn("chunk", F.explode(every))
            .withColumn("home", F.expr("home AND chunk = own"))
        )
    return (
        dealt.select("anchor", "chunk", "home", "fingerprint")
        .repartition("anchor", "chunk")
        .sortWithinPartitions("anchor", "chunk", F.desc("home"))
        .mapInArrow(_compare(distance), "a long, b long")
    )


def _rooted(docs: DataFrame, shingle: int, distance: int, max_homes: int) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows, and (fingerprint, root, first id) of the distinct ones."""
    prints = stored(fingerprints(docs, shingle))
    # Exact copies collapse here, before anything is compared.
    distinct = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    roots = components(links(distinct, distance, max_homes))
    placed = stored(
        distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
        .select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    )
    return prints, placed


def simhash_components(
    docs: DataFrame, shingle: int = 3, distance: int = 2, max_homes: int = MAX_HOMES
) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs`` (doc_id, text).

    ``fingerprint`` is 16 hex digits. ``component_id`` is the smallest doc_id reachable over
    fingerprints that differ in at most ``distance`` bits; rows with equal fingerprints are always
    together. A null or empty text, or one of white space, has fingerprint zero and is linked like
    any other. A null doc_id never is the smallest; where a component has no other it is null.
    Repeated rows are returned as often as they occur; an empty table gives an empty result, and
    further columns are ignored.
    """
    prints, placed = _rooted(docs, shingle, distance, max_homes)
    least = stored(placed.groupBy("root").agg(F.min("first").alias("component_id")))
    component = stored(placed.join(least, "root").select("fingerprint", "component_id"))
    return prints.join(component, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 2, max_homes: int = MAX_HOMES) -> DataFrame:
    """One row of ``docs``, with all its columns, of each component: that with the smallest doc_id.

    A row without a doc_id stays only where the whole component has none. Of rows with the smallest id
    and different texts, the one with the smallest hash of its text stays; repeated rows stay once.
    """
    prints, placed = _rooted(docs, shingle, distance, max_homes)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "_id", "_hash")
    best = prints.groupBy("fingerprint").agg(F.min(order).alias("best"))
    keep = stored(
        best.join(placed, "fingerprint").groupBy("root").agg(F.min("best").alias("best"))
        .select("best._id", "best._hash")
    )
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), *row_key())
    once = Window.partitionBy("_id", "_hash").orderBy("_id")
    return (
        keyed.join(keep, ["_id", "_hash"], "left_semi")
        .withColumn("_copy", F.row_number().over(once)).where("_copy = 1").select("_row.*")
    )
