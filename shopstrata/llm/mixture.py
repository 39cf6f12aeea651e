"""Mixing sources to target weights by Sainte-Lague apportionment.

The words of a source are laid end to end in a seeded order of its documents and cut into blocks of
equal length. Blocks go to sources by highest quotients of target / (2 k + 1), shard by shard, which
gives whole quotas; a source then hands out as many blocks as its quota says, from a seeded block on
and around its end. Quotas beyond the number of blocks take every block again.
"""

from __future__ import annotations

import hashlib
import heapq
from fractions import Fraction
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstrata.llm.common import stored, word_count

WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
REPEATS = 2
BLOCKS = 1 << 20
# Blocks that the smallest target is worth; blocks are shorter where BLOCKS alone would give it fewer.
LEAST_BLOCKS = 32
SHARDS = 16
SEED = 17
# Rows of one source that are put in order together; sources are cut into that many buckets.
BUCKET_ROWS = 20_000
LEAST_BUCKETS = 256


def targets(sizes: list[int], weights: list[int], total: Fraction, repeats: int) -> list[Fraction]:
    """Shares of ``total`` by weight, none above ``repeats`` times its size; excess is shared again."""
    capped: set[int] = set()
    while True:
        rest = total - sum(repeats * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        shares = [
            Fraction(repeats * sizes[i]) if i in capped else max(rest, Fraction(0)) * w / weight
            for i, w in enumerate(weights)
        ]
        above = {i for i in range(len(sizes)) if i not in capped and shares[i] > repeats * sizes[i]}
        if not above:
            return shares
        capped |= above


def apportion(goals: list[Fraction], seats: int, most: list[int]) -> list[int]:
    """Sainte-Lague: seats go one by one to the highest goal / (2 k + 1), ties to the first.

    All but the last few seats of each are given at once: with a divisor slightly above the ideal one,
    rounding goal / divisor gives a part of the same sequence of seats.
    """
    total = sum(goals)
    if not total:
        return [0] * len(goals)
    divisor = total / max(1, seats - len(goals))
    found = [min(most[i], int(g / divisor + Fraction(1, 2))) for i, g in enumerate(goals)]
    while sum(found) > seats:
        divisor *= Fraction(len(goals) + seats + 1, seats + 1)
        found = [min(most[i], int(g / divisor + Fraction(1, 2))) for i, g in enumerate(goals)]
    queue = [(-g / (2 * found[i] + 1), i) for i, g in enumerate(goals) if g and found[i] < most[i]]
    heapq.heapify(queue)
    for _ in range(seats - sum(found)):
        if not queue:
            break
        _, i = heapq.heappop(queue)
        found[i] += 1
        if found[i] < most[i]:
            heapq.heappush(queue, (-goals[i] / (2 * found[i] + 1), i))
    return found


def shard_quotas(goals: list[Fraction], seats: int, most: list[int], shards: int) -> list[list[int]]:
    """Blocks of each source in each shard; a divisor method never takes a seat back."""
    ends = [apportion(goals, seats * (k + 1) // shards, most) for k in range(shards)]
    return [[b - a for a, b in zip(x, y)] for x, y in zip([[0] * len(goals), *ends], ends)]


def source_key(source=None):
    """A text that is never null and tells null from every name; null sorts last."""
    source = F.col("source") if source is None else source
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("~"))


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """One narrow row per document: id, source, words and its place in the seeded order.

    Rows without an id are placed by their text, so that many of them are spread.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("x"), F.md5(text.cast("binary"))))
    place = F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary"))
    return docs.select(
        doc_id.alias("doc_id"),
        F.col("source").cast("string"),
        word_count(F.col("text").cast("string")).alias("size"),
        F.xxhash64("text").alias("_text"),
        source_key().alias("_key"),
        F.conv(F.substring(place, 1, 15), 16, 10).cast("long").alias("_order"),
    )


def mix_plan(
    narrow: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: Fraction = SHARE,
    repeats: int = REPEATS,
    blocks: int = BLOCKS,
    shards: int = SHARDS,
    seed: int = SEED,
) -> list[dict]:
    """One entry per source, in order of code points with null last.

    Only (source, words) pairs reach the driver: the list of sources that carry the weights, not rows.
    Blocks are about ``blocks`` or, where a small source needs it, more; their number costs nothing.
    """
    found = {r["_key"]: r["size"] for r in narrow.groupBy("_key").agg(F.sum("size").alias("size")).collect()}
    keys = sorted(found, key=lambda k: (k == "~", k))
    sizes = [found[k] for k in keys]
    total = share * sum(sizes)
    goals = targets(sizes, [weights[i % len(weights)] for i in range(len(keys))], total, repeats) if keys else []
    length = -(-int(total) // blocks)
    length = max(1, min([length, *(int(g / LEAST_BLOCKS) for g in goals if g)]))
    own = [-(-s // length) for s in sizes]
    most = [repeats * n for n in own]
    quotas = shard_quotas(goals, round(total / length), most, shards) if keys else []
    return [
        {
            "_key": key,
            "source_size": sizes[i],
            "target": float(goals[i]),
            "length": length,
            "blocks": own[i],
            "quotas": [q[i] for q in quotas],
            "quota": sum(q[i] for q in quotas),
            "start": int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:15], 16) % max(1, own[i]),
        }
        for i, key in enumerate(keys)
    ]


def quota_table(docs: DataFrame, **options) -> DataFrame:
    """(source, shard, blocks, first_block): how many blocks of each source a shard takes, and from which on.

    Blocks of a source are numbered in its seeded order and start again after the last one.
    """
    rows = []
    for p in mix_plan(stored(sized(docs, options.get("seed", SEED))), **options):
        at = p["start"]
        for shard, quota in enumerate(p["quotas"]):
            if quota:
                rows.append((None if p["_key"] == "~" else p["_key"][1:], shard, quota, at % p["blocks"]))
            at += quota
    return docs.sparkSession.createDataFrame(rows, "source string, shard int, blocks long, first_block long")


def _within(first: str, last: str) -> str:
    """Words of the document, which starts at ``_from``, in [first, last) of its source."""
    return f"greatest(0L, least(_from + size, {last}) - greatest(_from, {first}))"


def _per_shard():
    """(shard, words) of each shard that takes words of the document, from the last block ``ends`` of each."""
    last = _within("start * length", "least(start + e % blocks, blocks) * length")
    first = _within("0L", "greatest(0L, start + e % blocks - blocks) * length")
    upto = f"transform(ends, e -> if(blocks = 0, 0L, e div blocks * size + {last} + {first}))"
    words = f"zip_with({upto}, concat(array(0L), slice({upto}, 1, size(ends) - 1)), (x, y) -> x - y)"
    return F.expr(f"filter(transform({words}, (w, i) -> named_struct('shard', i, 'words', w)), r -> r.words > 0)")


def mix(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken, ...) per row of ``docs`` (doc_id, source, text).

    ``taken`` counts the words that the mix takes of the document, repeats included. Null and empty
    texts have size 0 and are never taken. A null source is a source of its own, in last place.
    Repeated rows stand for themselves. Runs with equal data and seed agree. An empty table gives an
    empty result; further columns of ``docs`` are ignored. The last columns say which words are taken:
    all of them ``_whole`` times, and once more ``_head`` words from the start of the text, or
    from word ``_skip`` on to the end or over ``_tail`` words. ``shards`` lists the shards that take words of the
    document, with their number: each shard takes the blocks of its quota, from where the one before ended.
    """
    seed = options.get("seed", SEED)
    narrow = stored(sized(docs, seed))
    spark = docs.sparkSession
    plan = spark.createDataFrame(
        [
            (p["_key"], p["source_size"], p["target"], p["length"], p["blocks"], p["start"], list(accumulate(p["quotas"])))
            for p in mix_plan(narrow, **options)
        ],
        "_key string, source_size long, target double, length long, blocks long, start long, ends array<long>",
    ).withColumn("quota", F.element_at("ends", -1))
    buckets = max(LEAST_BUCKETS, narrow.count() // BUCKET_ROWS)
    bucketed = narrow.withColumn("_bucket", F.pmod("_order", F.lit(buckets)).cast("int"))
    # A running sum in two levels: whole buckets of a source, then rows within a bucket.
    before = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_key", "_bucket").agg(F.sum("size").alias("_words"))
        .select("_key", "_bucket", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_offset"))
    )
    inside = (
        Window.partitionBy("_key", "_bucket").orderBy("_order", "doc_id", "size", "_text")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = (
        bucketed.withColumn("_upto", F.sum("size").over(inside))
        .join(offsets, ["_key", "_bucket"])
        .join(plan, "_key")
        .withColumn("_from", F.expr("_offset + _upto - size"))
        .withColumn("_whole", F.expr("if(blocks = 0, 0L, quota div blocks)"))
        .withColumn("_rest", F.expr("if(blocks = 0, 0L, quota % blocks)"))
        # The run of blocks from the seeded one on, and its part beyond the source's end.
        .withColumn("_a", F.expr("start * length"))
        .withColumn("_b", F.expr("least(start + _rest, blocks) * length"))
        .withColumn("_c", F.expr("greatest(0L, start + _rest - blocks) * length"))
    )
    return placed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.expr(f"_whole * size + {_within('_a', '_b')} + {_within('0L', '_c')}").cast("long").alias("taken"),
        "source",
        "_text",
        _per_shard().alias("shards"),
        "_whole",
        F.expr(_within("0L", "_c")).alias("_head"),
        F.expr("greatest(0L, _a - _from)").alias("_skip"),
        F.expr(_within("_a", "_b")).alias("_tail"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: ``docs`` with the columns it has, each row as often as it is taken.

    Where a block ends within a document, the words of the taken part are a row of their own, joined
    by single spaces, with n_chars (where there is one) set to its length.
    """
    kind = docs.schema
    keys = ["doc_id", "_src", "_text", "_copy"]
    copy = Window.partitionBy("doc_id", "_src", "_text").orderBy("size")
    taken = (
        mix(docs, **options).where("taken > 0")
        .withColumn("_src", source_key())
        .select("doc_id", "_src", "_text", "size", "_whole", "_head", "_skip", "_tail")
    )
    taken = taken.withColumn("_copy", F.row_number().over(copy.orderBy("_whole", "_head", "_tail", "_skip")))
    named = docs.select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        source_key().alias("_src"), F.xxhash64("text").alias("_text"),
    ).where(word_count(F.col("row.text").cast("string")) > 0)
    named = named.withColumn(
        "_copy", F.row_number().over(Window.partitionBy("doc_id", "_src", "_text").orderBy(F.xxhash64("row")))
    )
    same = F.expr(" AND ".join(f"l.{k} <=> r.{k}" for k in keys))
    joined = named.alias("l").join(taken.alias("r"), same).select("row", "size", "_whole", "_head", "_skip", "_tail")
    words = F.split(F.trim(F.regexp_replace("row.text", r"[\x20\x09-\x0D]+", " ")), " ")
    part = lambda start, count: F.concat_ws(" ", F.slice(words, start + 1, count))
    whole = F.col("row.text")
    texts = F.concat(
        F.array_repeat(whole, F.col("_whole").cast("int")),
        F.when(F.col("_head") >= F.col("size"), F.array(whole))
        .when(F.col("_head") > 0, F.array(part(F.lit(0), F.col("_head").cast("int"))))
        .otherwise(F.array().cast("array<string>")),
        F.when(F.col("_tail") >= F.col("size"), F.array(whole))
        .when(F.col("_tail") > 0, F.array(part(F.col("_skip").cast("int"), F.col("_tail").cast("int"))))
        .otherwise(F.array().cast("array<string>")),
    )
    exploded = joined.select("row", F.explode(texts).alias("_cut"))
    columns = [
        F.col("_cut").alias(f.name) if f.name == "text"
        else F.when(F.col("_cut") == F.col("row.text"), F.col(f"row.{f.name}"))
        .otherwise(F.char_length("_cut")).cast(f.dataType).alias(f.name) if f.name == "n_chars"
        else F.col(f"row.`{f.name}`").alias(f.name)
        for f in kind
    ]
    return exploded.select(*columns)
