"""Resharding by minimum-cost flow.

Documents lie in blocks, and blocks in shards. From the block sizes of the old layout and the
capacities of the new one, a minimum-cost flow decides how many bytes go from each old shard to
each new one at the fewest moved bytes; whole blocks are then picked to carry that flow, and the files
that hold a moving block are rewritten. Only the table of blocks reaches the driver, and its length is a
parameter that does not grow with the data.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopstrata.llm.common import stored
from shopstrata.sources.layers import shared_folder

OLD_SHARDS = 32
BLOCKS_PER_SHARD = 256
# Directories of a shard, each with consecutive blocks: a file is affected only by moves of its own blocks.
SEGMENTS = 8
OVERHEAD = 16

Block = tuple[int, int]


def min_cost_flow(
    supplies: list[int], capacities: list[int], cost: Callable[[int, int], int]
) -> dict[tuple[int, int], int]:
    """Units sent from each supply to each capacity at the least total cost.

    Successive shortest paths with potentials. The capacities must hold all supplies.
    """
    if sum(supplies) > sum(capacities):
        raise ValueError("the new shards are too small")
    m, n = len(supplies), len(capacities)
    flow: dict[tuple[int, int], int] = defaultdict(int)
    price = [0] * (m + n)
    left = list(supplies)
    free = list(capacities)
    while any(left):
        # Shortest ways from all supplies with units left, over edges and sent units backwards.
        way = [float("inf")] * (m + n)
        before = [-1] * (m + n)
        queue = []
        for i in range(m):
            if left[i]:
                way[i] = 0
                heapq.heappush(queue, (0, i))
        while queue:
            d, u = heapq.heappop(queue)
            if d > way[u]:
                continue
            if u < m:
                steps = [(m + j, cost(u, j)) for j in range(n)]
            else:
                steps = [(i, -cost(i, u - m)) for i in range(m) if flow[i, u - m]]
            for v, c in steps:
                reduced = d + c + price[u] - price[v]
                if reduced < way[v]:
                    way[v], before[v] = reduced, u
                    heapq.heappush(queue, (reduced, v))
        for v in range(m + n):
            if way[v] < float("inf"):
                price[v] += way[v]
        end = min(
            (m + j for j in range(n) if free[j] and way[m + j] < float("inf")),
            key=lambda v: price[v],
        )
        path, v = [], end
        while before[v] >= 0:
            path.append((before[v], v))
            v = before[v]
        units = min(left[v], free[end - m], *(flow[b, a - m] for a, b in path if a >= m))
        left[v] -= units
        free[end - m] -= units
        for a, b in path:
            if a < m:
                flow[a, b - m] += units
            else:
                flow[b, a - m] -= units
    return {k: v for k, v in flow.items() if v}


def assign_blocks(
    blocks: dict[Block, int],
    capacities: list[int],
    cost: Callable[[int, int], int] = lambda old, new: int(old != new),
) -> dict[Block, int]:
    """The new shard of every block (old shard, block number), given the bytes of each.

    The flow is carried by consecutive blocks, those that stay first, so that few files of a shard lose
    any. Blocks cannot be cut: after that, blocks are handed from the shard that is most above its
    capacity to the one most below it, as long as that brings both closer.
    """
    old: dict[int, list[int]] = defaultdict(list)
    for shard, number in sorted(blocks):
        old[shard].append(number)
    ids = sorted(old)
    sizes = [sum(blocks[i, n] for n in old[i]) for i in ids]
    flow: dict[int, list[list[int]]] = defaultdict(list)
    for (i, j), units in min_cost_flow(sizes, capacities, lambda i, j: cost(ids[i], j)).items():
        flow[ids[i]].append([int(j != ids[i]), j, units])
    placed: dict[Block, int] = {}
    over = [-c for c in capacities]
    inside: list[dict[Block, int]] = [{} for _ in capacities]
    for shard in ids:
        todo = sorted(flow[shard]) or [[0, min(shard, len(capacities) - 1), 0]]
        for number in old[shard]:
            size = blocks[shard, number]
            while len(todo) > 1 and 2 * todo[0][2] < size:
                todo.pop(0)
            target = todo[0][1]
            todo[0][2] -= size
            placed[shard, number] = target
            over[target] += size
            inside[target][shard, number] = size
    for _ in range(4 * len(blocks)):
        full = max(range(len(over)), key=lambda j: (over[j], -j))
        low = min(range(len(over)), key=lambda j: (over[j], j))
        gap = over[full] - over[low]
        # Of equally good blocks, one that moves anyway, then one from the end of its old shard.
        fits = [(abs(gap - 2 * s), b[0] == full, -b[1], b) for b, s in inside[full].items() if 0 < s < gap]
        if not fits:
            break
        block = min(fits)[3]
        size = inside[full].pop(block)
        inside[low][block] = size
        over[full] -= size
        over[low] += size
        placed[block] = low
    return placed


def even_capacities(total: int, shards: int) -> list[int]:
    """Near-equal whole capacities that hold exactly ``total``."""
    return [total // shards + (j < total % shards) for j in range(shards)]


def _measured(docs: DataFrame) -> DataFrame:
    """``docs`` with _size and _crc of their texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        "*", (F.octet_length(text) + OVERHEAD).cast("long").alias("_size"), F.crc32(text.cast("binary")).alias("_crc")
    )


def heavy_rows(docs: DataFrame, blocks: int) -> DataFrame:
    """(_id, _crc, _size) of rows that are repeated and together larger than a mean block.

    There are fewer of them than blocks, so they may be broadcast.
    """
    keys = [F.col("doc_id").alias("_id"), "_crc", "_size"]
    groups = stored(_measured(docs).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    total = groups.agg(F.sum(F.col("_size") * F.col("n"))).first()[0] or 0
    return groups.where(f"n > 1 AND _size * n > {total} / {blocks}").select("_id", "_crc", "_size")


def with_blocks(
    docs: DataFrame, old_shards: int = OLD_SHARDS, blocks_per_shard: int = BLOCKS_PER_SHARD
) -> DataFrame:
    """``docs`` with _size, _crc, _old (the old shard) and _block.

    The old layout deals documents by a hash of id and text, so that many rows without an id, or
    with the same one, are still spread. Equal rows that would overfill a block are dealt one by one, by their place in
    the input; which of them goes where does not matter.
    """
    blocks = old_shards * blocks_per_shard
    heavy = heavy_rows(docs, blocks).withColumn("_heavy", F.lit(True))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_crc") == F.col("_key")) & (F.col("_size") == F.col("_bytes"))
    measured = _measured(docs).withColumn("_at", F.monotonically_increasing_id()).join(
        F.broadcast(heavy.withColumnsRenamed({"_crc": "_key", "_size": "_bytes"})), same, "left"
    )
    alone = F.xxhash64("doc_id", "_crc", "_at")
    dealt = F.pmod(F.when(F.col("_heavy"), alone).otherwise(F.xxhash64("doc_id", "_crc")), F.lit(blocks))
    return measured.select(
        *docs.columns, "_size", "_crc",
        (dealt / blocks_per_shard).cast("int").alias("_old"),
        F.pmod(dealt, F.lit(blocks_per_shard)).cast("int").alias("_block"),
    )


def _plan(counts: dict[Block, tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """(old shard, block, new shard, slot of its first row) from the bytes and rows of each block."""
    sizes = {b: size for b, (size, _) in counts.items()}
    placed = assign_blocks(sizes, even_capacities(sum(sizes.values()), shards))
    slots, out = [0] * shards, []
    for block in sorted(placed):
        out.append((*block, placed[block], slots[placed[block]]))
        slots[placed[block]] += counts[block][1]
    return out


PLAN = "_old int, _block int, _shard int, _first long"


def write_layout(docs: DataFrame, folder: str, old_shards: int = OLD_SHARDS, blocks: int = BLOCKS_PER_SHARD) -> None:
    """Write documents as the old layout below ``folder``: a directory per shard and segment.

    A file holds consecutive blocks of one segment, and a block lies in one file. The columns of ``docs``
    are kept in a struct, so that none of them clashes.
    """
    columns = docs.columns
    rows = with_blocks(docs.select(F.struct(*columns).alias("row"), "doc_id", "text"), old_shards, blocks)
    (
        rows.select("row", "_old", "_block", "_size", F.expr(f"_block * {SEGMENTS} div {blocks}").alias("_segment"))
        .repartitionByRange("_old", "_block").sortWithinPartitions("_old", "_block", "row.doc_id")
        .write.partitionBy("_old", "_segment").parquet(folder)
    )


def reshard(spark: SparkSession, folder: str, target: str, shards: int) -> DataFrame:
    """Turn the layout in ``folder`` into ``shards`` even shards; files that lose no block stay as they are.

    The affected files, those with a block that moves, are written anew below ``target``. Returns all rows as
    they can be read afterwards, from kept and new files: (row, _old, _block, _shard, _first).
    Only a line per block and file reaches the driver, which is at most 8192 by construction.
    """
    layout = spark.read.parquet(folder)
    lines = (
        layout.groupBy("_old", "_block", F.col("_metadata.file_path").alias("file"))
        .agg(F.sum("_size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()
    )
    counts = {(r["_old"], r["_block"]): (r["bytes"], r["rows"]) for r in lines}
    steps = _plan(counts, shards)
    moves = {(o, b) for o, b, s, _ in steps if o != s}
    plan = spark.createDataFrame(steps, PLAN)
    affected = sorted({r["file"] for r in lines if (r["_old"], r["_block"]) in moves})
    kept = sorted({r["file"] for r in lines} - set(affected))
    columns = ["row", "_old", "_block"]

    def files(paths: list[str]) -> DataFrame:
        return spark.read.schema(layout.schema).option("basePath", folder).parquet(*paths).select(*columns)

    out = []
    if affected:
        changed = files(affected).join(F.broadcast(plan), ["_old", "_block"])
        (
            changed.repartitionByRange("_shard", "_old", "_block").sortWithinPartitions("_shard", "_old", "_block")
            .select(*columns, "_first", F.col("_shard").alias("shard")).write.partitionBy("shard").parquet(target)
        )
        moved = spark.read.parquet(target)
        out.append(moved.select(*columns, F.col("shard").alias("_shard"), "_first"))
    if kept:
        stay = files(kept).join(F.broadcast(plan), ["_old", "_block"])
        out.append(stay.select(*columns, "_shard", "_first"))
    return reduce(DataFrame.unionByName, out)


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Lay documents out in old shards, reshard them, and read every row back from the files.

    (doc_id, size, text_crc32, law, shard, slot, grown_shard, old_shard). The law is ``bytes``: shard sizes are near
    equal, off by about half a block or one very long document. ``size`` is the UTF-8 length of the text (null: 0)
    plus 16; ``slot`` numbers the rows of a shard without gaps; ``grown_shard`` is null under this law. Repeated
    rows get slots of their own. An empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    folder = shared_folder(spark)
    write_layout(docs, f"{folder}/old")
    if docs.isEmpty():
        return spark.createDataFrame([], RESULT)
    rows = reshard(spark, f"{folder}/old", f"{folder}/new", shards)
    text = F.coalesce("row.text", F.lit(""))
    narrow = rows.select(
        F.col("row.doc_id").alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        "_old", "_block", "_shard", "_first",
    )
    within = Window.partitionBy("_old", "_block").orderBy("doc_id", "text_crc32", "size")
    return narrow.withColumn("_at", F.row_number().over(within)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("_shard").alias("shard"),
        (F.col("_first") + F.col("_at") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.col("_old").alias("old_shard"),
    )


RESULT = (
    "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int, old_shard int"
)


def sharded_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """``docs`` with their columns and the ``shard`` and ``slot`` of each row, which replace columns so named.

    Documents are laid out in old shards, resharded, and read back from kept and rewritten files, as in
    :func:`shard_documents`. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    folder = shared_folder(spark)
    write_layout(docs, f"{folder}/old")
    if docs.isEmpty():
        return docs.select(*kept, F.lit(None).cast("int").alias("shard"), F.lit(None).cast("long").alias("slot"))
    rows = reshard(spark, f"{folder}/old", f"{folder}/new", shards)
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    within = Window.partitionBy("_old", "_block").orderBy("row.doc_id", F.crc32(text.cast("binary")), F.octet_length(text))
    return rows.withColumn("_at", F.row_number().over(within)).select(
        *(F.col(f"row.`{c}`").alias(c) for c in kept), F.col("_shard").alias("shard"),
        (F.col("_first") + F.col("_at") - 1).cast("long").alias("slot"),
    )
