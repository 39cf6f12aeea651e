"""Conversations as a prefix trie: ternary search trees per range shard, boundary nodes merged.

A node of the trie is a distinct sequence of first turns; its members are the conversations that start with it.

1. A turn becomes a digest of role and text, a conversation the sequence of its digests. Texts go no further.
2. Conversations are range-partitioned by (sequence, id), so a shard is a run of the sorted order and a group of equal
   conversations of any size is cut like any other run.
3. Each shard encodes its digests as small integers and inserts its distinct sequences, medians first, into a ternary
   search tree, which keeps every sibling tree balanced. One iterative traversal adds up members, leaves and savings.
4. Only nodes on the first or last path of a shard can continue in its neighbours, as deep as the two meeting
   sequences agree. They are named by the first shard that holds them; each shard adds what it alone knows: a node
   counts as a child and for its own text in the first shard that holds it, as a leaf in the last one. The parts are
   then sums, and the ids of conversations that end in such a node are hashed as a stream in shard order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstrata.llm.common import shuffle_partitions, stored

# Turns that a shard is meant to hold.
SHARD_TURNS = 200_000
NODE = (
    "owner long, depth long, conv_id long, parent_owner long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, ends string, shard long, boundary boolean"
)
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def turn_sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (digest, size) with size in code points.

    Order: by turn, null first, then by digest where turns repeat. Null roles and texts are empty; rows without a
    conv_id belong to no conversation. A conversation is one row of 24 bytes a turn.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    known = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.unhex(F.substring(F.sha2(known, 256), 1, 32))
    one = F.struct(
        F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.char_length(text).cast("long").alias("size")
    )
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), one.alias("one")).where("conv_id IS NOT NULL")
    ordered = F.sort_array(F.collect_list("one"))
    return rows.groupBy("conv_id").agg(
        F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns")
    )


def rebuilt(sequences: DataFrame) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of c - c % 100; h is crc32(c) % 6.

    A remainder has the sign of c, as in SQL.
    """
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    own = sequences.withColumns({"h": head, "base": F.col("conv_id") - F.col("conv_id") % 100})
    bases = sequences.where("conv_id % 100 = 0").select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, 5).alias("first")
    )
    none = F.slice("turns", 1, 0)
    taken = F.when(F.col("h") > 0, F.slice(F.coalesce("first", none), F.lit(1), F.col("h"))).otherwise(none)
    # A slice that begins after the end is empty.
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.join(bases, "base", "left").select("conv_id", F.concat(taken, rest).alias("turns"))


class TernaryTree:
    """A trie whose children are binary search trees, grown by inserting medians first.

    Node 0 is the root. A node has a symbol, siblings below and above it, and the tree of its children.
    """

    def __init__(self, sequences: list[list[int]]):
        """``sequences``: sorted and distinct."""
        self.symbol, self.low, self.high, self.child, self.parent, self.depth = [-1], [-1], [-1], [-1], [-1], [0]
        self.end = [0] * len(sequences)  # the node in which each sequence ends
        spans = [(0, len(sequences))]
        while spans:
            a, b = spans.pop()
            if a < b:
                middle = (a + b) // 2
                self.end[middle] = self._insert(sequences[middle])
                spans += [(a, middle), (middle + 1, b)]

    def _new(self, symbol: int, parent: int) -> int:
        self.symbol.append(symbol)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        for links in (self.low, self.high, self.child):
            links.append(-1)
        return len(self.symbol) - 1

    def _insert(self, sequence: list[int]) -> int:
        at = 0
        for symbol in sequence:
            links, place, found = self.child, at, self.child[at]
            while found >= 0 and self.symbol[found] != symbol:
                links, place = (self.low if symbol < self.symbol[found] else self.high), found
                found = links[place]
            if found < 0:
                found = links[place] = self._new(symbol, at)
            at = found
        return at

    def path(self, node: int) -> list[int]:
        """The nodes from the root to ``node``."""
        nodes = []
        while node >= 0:
            nodes.append(node)
            node = self.parent[node]
        return nodes[::-1]

    def walk(self) -> Iterator[int]:
        """All nodes, parents before children, without recursion."""
        waiting = [0]
        while waiting:
            node = waiting.pop()
            yield node
            waiting += [x for x in (self.low[node], self.child[node], self.high[node]) if x >= 0]


def shard_nodes(shard: int, rows: list[tuple], before: int, after: int, owners: list[int]) -> list[tuple]:
    """The nodes of one shard as rows of NODE; ``rows``: (digests, sizes, conv_id), sorted by sequence and id.

    ``before`` and ``after``: how many turns the first and last sequence share with the neighbouring shard
    (-1: there is none); ``owners``: for each depth up to ``before``, the first shard that holds the node.
    """
    codes = {d: i for i, d in enumerate(sorted({d for digests, _, _ in rows for d in digests}))}
    sequences, sizes, groups = [], [], []
    for digests, lengths, conv_id in rows:
        sequence = [codes[d] for d in digests]
        if not sequences or sequence != sequences[-1]:
            sequences.append(sequence)
            sizes.append(lengths)
            groups.append([])
        groups[-1].append(conv_id)
    tree = TernaryTree(sequences)
    count = len(tree.symbol)
    members, least, children, size = [0] * count, [None] * count, [0] * count, [0] * count
    ends: list[list[int]] = [[] for _ in range(count)]
    for end, lengths, group in zip(tree.end, sizes, groups):
        members[end], least[end], ends[end] = len(group), min(group), sorted(group)
        node = end
        for length in reversed(lengths):
            if size[node]:  # the path to the root is known from here on
                break
            size[node], node = length, tree.parent[node]
    earlier = dict(enumerate(tree.path(tree.end[0])[: before + 1]))
    shared = set(earlier.values())
    reaching = set(tree.path(tree.end[-1])[: after + 1])
    owner = {node: owners[depth] for depth, node in earlier.items()} | {n: shard for n in reaching - shared}

    order = list(tree.walk())
    for node in reversed(order[1:]):
        parent = tree.parent[node]
        members[parent] += members[node]
        least[parent] = least[node] if least[parent] is None else min(least[parent], least[node])
        children[parent] += node not in shared
    has_child = [x >= 0 for x in tree.child]
    leaves = [int(not has_child[n] and n not in reaching) for n in range(count)]
    saved = [members[n] * size[n] - (0 if n in shared else size[n]) for n in range(count)]
    for node in reversed(order[1:]):
        leaves[tree.parent[node]] += leaves[node]
        saved[tree.parent[node]] += saved[node]

    found = []
    for node in order:
        parent, boundary = tree.parent[node], node in owner
        listed = ",".join(map(str, ends[node]))
        found.append((
            owner.get(node), tree.depth[node], least[node],
            owner.get(parent), None if parent < 0 or parent in owner else least[parent],
            members[node], children[node], leaves[node], saved[node],
            None if boundary else hashlib.sha256(listed.encode()).hexdigest(),
            listed if boundary and listed else None, shard, boundary,
        ))
    return found


def common_length(a: list, b: list) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def shard_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (shard, first, last) in order to (shard, before, after, owners); holds one path at a time."""
    names = ["shard", "before", "after", "owners"]
    last, owners, waiting = None, [], None
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            before = -1 if last is None else common_length(last, row["first"])
            if waiting:
                found.append((*waiting[:2], before, waiting[2]))
            waiting = (row["shard"], before, owners[: before + 1])
            inner = common_length(row["first"], row["last"])
            kept = owners[: min(before, inner) + 1]
            owners = kept + [row["shard"]] * (len(row["last"]) + 1 - len(kept))
            last = row["last"]
        yield _batch(found, names, "long long long long[]")
    yield _batch([(*waiting[:2], -1, waiting[2])] if waiting else [], names, "long long long long[]")


def _batch(rows: list[tuple], names: list[str], kinds: str) -> pa.RecordBatch:
    known = {
        "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "long[]": pa.list_(pa.int64()),
    }
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, known[k]) for c, k in zip(columns, kinds.split())], names
    )


NODE_NAMES = [part.split()[0] for part in NODE.split(", ")]
NODE_KINDS = " ".join(part.split()[1] for part in NODE.split(", "))


def _nodes_of(left: pa.Table, right: pa.Table) -> pa.Table:
    border = right.to_pylist()[0]
    rows = sorted(
        ([t["digest"] for t in r["turns"]], [t["size"] for t in r["turns"]], r["conv_id"]) for r in left.to_pylist()
    )
    rows.sort(key=lambda r: (r[0], r[2]))
    found = shard_nodes(border["shard"], rows, border["before"], border["after"], border["owners"])
    return pa.Table.from_batches([_batch(found, NODE_NAMES, NODE_KINDS)])


def merged_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of boundary nodes, sorted by (owner, depth, shard), added up one node at a time."""
    names = ["owner", "depth", "parent_owner", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    kinds = "long long long long long long long long string"
    key, sums, digest, some = None, None, None, False

    def closed() -> list[tuple]:
        return [] if key is None else [(*key, *sums, digest.hexdigest())]

    for batch in batches:
        found = []
        for r in batch.to_pylist():
            if key is None or key[:2] != (r["owner"], r["depth"]):
                found += closed()
                key, sums, digest, some = (r["owner"], r["depth"], r["parent_owner"]), None, hashlib.sha256(), False
            part = (r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"])
            sums = part if sums is None else (min(sums[0], part[0]), *(a + b for a, b in zip(sums[1:], part[1:])))
            if r["ends"] is not None:
                digest.update((("," if some else "") + r["ends"]).encode())
                some = True
        yield _batch(found, names, kinds)
    yield _batch(closed(), names, kinds)


def prefix_nodes(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of (conv_id, turns), as COLUMNS.

    ``turns``: an array of (digest, size). One row per distinct sequence of first turns, the empty one included;
    (conv_id, depth) names it. An empty table has no nodes.
    """
    spark = sequences.sparkSession
    sequences = stored(sequences.select("conv_id", "turns"))
    total = sequences.agg(F.coalesce(F.sum(F.size("turns")), F.lit(0)) + F.count(F.lit(1))).first()[0]
    shards = max(shuffle_partitions(spark), -(-total // shard_turns))
    key: Column = F.col("turns.digest")
    dealt = stored(
        sequences.repartitionByRange(shards, key, F.col("conv_id")).withColumn("shard", F.spark_partition_id().cast("long"))
    )
    ends = dealt.groupBy("shard").agg(F.min("turns.digest").alias("first"), F.max("turns.digest").alias("last"))
    borders = ends.repartition(1).sortWithinPartitions("shard").mapInArrow(
        shard_borders, "shard long, before long, after long, owners array<long>"
    )
    nodes = stored(dealt.groupBy("shard").cogroup(borders.groupBy("shard")).applyInArrow(_nodes_of, NODE))

    parts = nodes.where("boundary").select(
        "owner", "depth", "parent_owner", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "shard"
    )
    merged = stored(
        parts.repartition(shuffle_partitions(spark), "owner", "depth").sortWithinPartitions("owner", "depth", "shard")
        .mapInArrow(
            merged_parts,
            "owner long, depth long, parent_owner long, conv_id long, n_convs long, n_children long, n_leaves long, "
            "saved_tokens long, ends_sha256 string",
        )
    )
    above = merged.select(
        F.col("owner").alias("parent_owner"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id")
    )
    whole = merged.join(above, ["parent_owner", "depth"], "left")
    # Parents are looked up per shard, so that the many children of a common node meet in many tasks.
    inner = nodes.where("NOT boundary")
    near = parts.select("shard", "owner", "depth").join(merged.select("owner", "depth", "conv_id"), ["owner", "depth"]).select(
        "shard", F.col("owner").alias("parent_owner"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("found")
    )
    settled = inner.join(near, ["shard", "parent_owner", "depth"], "left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "found")
    )
    return settled.select(COLUMNS).unionByName(whole.select(COLUMNS))


def conversation_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of the rebuilt conversations of (conv_id, turn, role, text); further columns are not looked at."""
    return prefix_nodes(rebuilt(turn_sequences(conversations)), shard_turns)
