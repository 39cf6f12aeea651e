"""A Merkle manifest of a table: one tree per source, a tree of their roots, and proofs in bulk.

Leaves of a source ascend by doc_id; every three consecutive nodes become their parent until one is left. The
sources' roots are the leaves of the top tree. All digests are lower-case hex SHA-256.

1. Digests of rows are taken in the JVM; from then on no text moves. They are range-partitioned by (source, doc_id),
   so that a large source is many partitions, and numbered within their source by running counts of partitions.
2. Interior nodes are built by subtrees of 3^7 leaves, then by subtrees of their roots, and so on: a few rounds.
3. A leaf partition is a range of the order and seldom a whole subtree. For an octopus multiproof it lists
   the fewest nodes that its own leaves do not yield (at most two at each end of a level), in its sources' trees and
   in the top tree, and fetches them in one join. Then it derives the interior nodes that its leaves share, once each, and
   expands the proof of every leaf from them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstrata.llm.common import shuffle_partitions, stored

FAN = 3
SUBTREE_LEVELS = 7
PARTITION_ROWS = 50_000
TOP = "t"


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(count: int) -> int:
    """Levels above the leaves of a tree of ``count`` leaves."""
    levels = 0
    while count > 1:
        count, levels = -(-count // FAN), levels + 1
    return levels


def parents(nodes: list[str]) -> list[str]:
    return [digest(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]


def missing(start: int, stop: int, count: int) -> list[tuple[int, int]]:
    """The fewest nodes (level, place) from which, with leaves ``start`` to ``stop`` of ``count``, all above follow."""
    found, level = [], 0
    while count > 1:
        first, last = start // FAN, -(-stop // FAN)
        for place in (*range(first * FAN, start), *range(stop, min(last * FAN, count))):
            found.append((level, place))
        start, stop, count, level = first, last, -(-count // FAN), level + 1
    return found


def derived(leaves: list[str], start: int, count: int, fetched: dict[tuple[int, int], str]) -> list[tuple[int, list[str]]]:
    """For each level the place of its first known node, and the known nodes, up to the root."""
    levels, nodes, level = [], leaves, 0
    while count > 1:
        while start % FAN:
            start -= 1
            nodes = [fetched[level, start], *nodes]
        while (start + len(nodes)) % FAN and start + len(nodes) < count:
            nodes = [*nodes, fetched[level, start + len(nodes)]]
        levels.append((start, nodes))
        start, nodes, count, level = start // FAN, parents(nodes), -(-count // FAN), level + 1
    levels.append((start, nodes))
    return levels


def path(levels: list[tuple[int, list[str]]], place: int) -> list[tuple[list[str], list[str]]]:
    """The siblings left and right of a node and of those above it, below the root."""
    found = []
    for start, nodes in levels[:-1]:
        at = place - start
        run = at - place % FAN
        found.append((nodes[run:at], nodes[at + 1 : run + FAN]))
        place //= FAN
    return found


def leaf_digests(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")) -> DataFrame:
    """(doc_id, tree, leaf, shown): a row's digest, and that of its tampered form."""

    def told(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    def row(text: Column) -> Column:
        values = [text if c == "text" else F.col(c) for c in columns]
        return F.sha2(F.concat(*map(told, values)), 256)

    text = F.col("text").cast("string")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    cut = F.replace(text, F.lit("\n"), F.lit(""))
    changed = even & (F.length(cut) < F.length(text))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("-")).alias("tree"),
        row(text).alias("leaf"),
        F.when(changed, row(cut)).alias("tampered"),
    ).withColumn("shown", F.coalesce("tampered", "leaf")).drop("tampered")


def numbered(rows: DataFrame, order: list[str], partition_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows with (part, at), and (part, tree, start, count): the run of each tree in each partition.

    ``at`` is a row's place among those of its tree in its partition, ``start`` that of the run in its tree, ``count`` the
    leaves of the whole tree.
    """
    spark = rows.sparkSession
    # Rows that are equal in every column are told apart by a number, so that a range can end between them.
    rows = stored(rows.withColumn("_salt", F.monotonically_increasing_id()))
    parts = max(shuffle_partitions(spark), -(-rows.count() // partition_rows))
    keys = ["tree", *order, "_salt"]
    ranged = rows.repartitionByRange(parts, *[F.col(k).asc_nulls_first() for k in keys])
    ranged = ranged.withColumn("part", F.spark_partition_id().cast("long")).sortWithinPartitions(
        *[F.col(k).asc_nulls_first() for k in keys]
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, at = None, 0
        for batch in batches:
            places = []
            for name in batch.column("tree").to_pylist():
                tree, at = name, at + 1 if name == tree else 0
                places.append(at)
            yield batch.append_column("at", pa.array(places, pa.int64()))

    schema = ", ".join(f"`{n}` {k}" for n, k in ranged.dtypes) + ", `at` bigint"
    placed = stored(ranged.mapInArrow(number, schema).drop("_salt"))
    runs = placed.groupBy("part", "tree").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tree")
    runs = runs.select(
        "part", "tree", "rows",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"),
        F.sum("rows").over(whole).alias("count"),
    )
    return placed, stored(runs)


def interior_nodes(leaves: DataFrame, largest: int, levels: int = SUBTREE_LEVELS) -> list[DataFrame]:
    """All nodes (tree, level, place, count, hash) over ``leaves`` of the same columns; ``count``: nodes of the level.

    ``largest``: leaves of the largest tree, which decides the number of rounds.
    """
    span = FAN**levels

    def build(table: pa.Table) -> pa.Table:
        tree, level, count = (table.column(c)[0].as_py() for c in ("tree", "level", "count"))
        rows = sorted(zip(table.column("place").to_pylist(), table.column("hash").to_pylist()))
        place, nodes = rows[0][0], [h for _, h in rows]
        found = []
        for _ in range(levels):
            if count <= 1:
                break
            place, nodes, count, level = place // FAN, parents(nodes), -(-count // FAN), level + 1
            found += [(tree, level, place + i, count, h) for i, h in enumerate(nodes)]
        columns = list(zip(*found)) if found else [()] * 5
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["tree", "level", "place", "count", "hash"])

    rounds = [leaves]
    for level in range(0, levels_of(largest), levels):
        lower = rounds[-1].where((F.col("level") == level) & (F.col("count") > 1))
        grouped = lower.withColumn("subtree", F.floor(F.col("place") / span)).groupBy("tree", "subtree")
        rounds.append(stored(grouped.applyInArrow(build, "tree string, level long, place long, count long, hash string")))
    return rounds


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def tree_nodes(rows: DataFrame, order: list[str], hash_column: str, partition_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Numbered rows, their runs, and the nodes of all levels of their trees."""
    placed, runs = numbered(rows, order, partition_rows)
    largest = runs.agg(F.max("count")).first()[0] or 0
    leaves = placed.join(runs, ["part", "tree"]).select(
        "tree", F.lit(0).cast("long").alias("level"), (F.col("start") + F.col("at")).alias("place"), "count",
        F.col(hash_column).alias("hash"),
    )
    return placed, runs, _union(interior_nodes(stored(leaves), largest))


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The missing nodes of each run (part, tree, start, rows, count)."""
    for batch in batches:
        found = [
            (r["part"], r["tree"], *node)
            for r in batch.to_pylist()
            for node in missing(r["start"], r["start"] + r["rows"], r["count"])
        ]
        columns = list(zip(*found)) if found else [()] * 4
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "tree", "level", "place"])


def _expand(left: pa.Table, right: pa.Table) -> pa.Table:
    """The proofs of one leaf partition: its leaves, and its runs with the fetched nodes."""
    runs, fetched = {}, {}
    for r in right.to_pylist():
        if r["level"] is None:
            runs[r["tree"]] = r
        else:
            fetched.setdefault(r["tree"], {})[r["level"], r["place"]] = r["hash"]
    leaves: dict[str, list[tuple]] = {}
    for r in left.to_pylist():
        leaves.setdefault(r["tree"], []).append((r["at"], r["doc_id"], r["leaf"], r["shown"]))
    trees, roots = {}, {}
    for tree, rows in leaves.items():
        rows.sort(key=lambda r: r[0])
        run = runs[tree]
        trees[tree] = derived([r[2] for r in rows], run["start"], run["count"], fetched.get(tree, {}))
        roots[tree] = trees[tree][-1][1][0]
    # The sources of a partition are consecutive leaves of the top tree.
    above = sorted((runs[tree]["top_place"], tree) for tree in leaves)
    top = derived([roots[t] for _, t in above], above[0][0], runs[above[0][1]]["top_count"], fetched.get(TOP, {}))
    root = top[-1][1][0]
    found = []
    for top_place, tree in above:
        upper = path(top, top_place)
        start = runs[tree]["start"]
        tails: dict[int, list] = {}
        for at, doc_id, leaf, shown in leaves[tree]:
            steps = path(trees[tree][:1] + trees[tree][-1:], start + at) if len(trees[tree]) > 1 else []
            run = (start + at) // FAN
            if run not in tails:
                tails = {run: path(trees[tree], start + at)[1:] + upper}
            steps = steps + tails[run]
            folded, proof = shown, []
            for before, after in steps:
                proof += before
                proof += after
                folded = digest([*before, folded, *after])
            found.append((doc_id, leaf, roots[tree], root, digest(proof), folded, folded == root))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)


def merkle_manifest(docs: DataFrame, partition_rows: int = PARTITION_ROWS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row of ``docs``.

    Needs the columns doc_id, source, lang, n_chars and text; others are not looked at. A null value counts as ``-``, a null
    source is a source of its own, first in order; rows without a doc_id come first in theirs and are not tampered
    with. Rows with one doc_id are ordered by digest, so equal rows have places next to each other and one
    digest. A tampered text without a line end is the text itself and verifies. The proof of the only row of
    the only source is empty. An empty table has no rows.
    """
    placed, runs, nodes = tree_nodes(leaf_digests(docs), ["doc_id", "leaf"], "leaf", partition_rows)
    subroots = nodes.where("count = 1").select("tree", "hash")
    tops = subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), "hash")
    top_placed, top_runs, top_nodes = tree_nodes(tops, ["name"], "hash", partition_rows)
    place = top_placed.join(top_runs, ["part", "tree"]).select(
        F.col("name").alias("tree"), (F.col("start") + F.col("at")).alias("top_place"), F.col("count").alias("top_count")
    )
    runs = stored(runs.join(place, "tree"))

    above = runs.groupBy("part").agg(
        F.min("top_place").alias("start"), F.count(F.lit(1)).alias("rows"), F.first("top_count").alias("count")
    )
    spans = runs.select("part", "tree", "start", "rows", "count").unionByName(
        above.select("part", F.lit(TOP).alias("tree"), "start", "rows", "count")
    )
    asked = spans.mapInArrow(_ask, "part long, tree string, level long, place long")
    known = nodes.unionByName(top_nodes).select("tree", "level", "place", "hash")
    fetched = asked.join(known, ["tree", "level", "place"])
    facts = runs.select("part", "tree", "start", "count", "top_place", "top_count").unionByName(
        fetched, allowMissingColumns=True
    )
    return placed.groupBy("part").cogroup(facts.groupBy("part")).applyInArrow(
        _expand,
        "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )
