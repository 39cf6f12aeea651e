"""SpotSigs: document fingerprints from chains of content words behind common-word anchors.

A signature is an anchor and the next two content words. The signatures of a text form a set in which
repeats are told apart by their number, so that Jaccard over sets is Jaccard over counts. Sets can only
be alike if their lengths are, which is used twice: sets are partitioned by length, so that a pair meets in
one partition or in neighbours, and the likeness of a pair is given up as soon as lengths rule it out.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstrata.llm.common import stored
from shopstrata.llm.components import components
from shopstrata.llm.ordering import block_bounds, with_block

CHAIN = 2
# Sets of one class of lengths that are compared under one signature in one task.
MAX_HOMES = 4096
# Rounds in which one set per signature is compared with the others, before all that is left.
ROUNDS = 5
WORDS = re.compile(r"\w+")
# Anchors: common words of English, German, French and Spanish.
ANCHORS = frozenset(
    """
    a an and are as at be been but by can did do for from had has have he her his i if in is it its not of on or
    she that the their there they this to was we were which will with would you
    als am auch auf aus bei das dass dem den der des die du ein eine einer er es für hat ich im ist mit nach
    nicht sich sie sind und vom von war wie wird wir zu zum zur über
    au aux avec ce cette dans de du elle en est et il ils je la le les leur ne nous on ou où par pas pour qu que
    qui sa se ses son sont sur un une vous
    al como con cuando del el ella ellos era esta este fue hay las lo los más muy no nos para pero por porque
    si sin su sus también tiene todo y ya
    """.split()
)


def signatures(text: str | None, chain: int = CHAIN) -> set[str]:
    """The set of a text: an anchor, its chain, and from the second one on the number of the repeat.

    A text without any full chain has one signature, its whole text; an empty text has none.
    """
    if not text:
        return set()
    words = WORDS.findall(text.lower())
    anchors = ANCHORS
    content = [w for w in words if w not in anchors]
    found: list[str] = []
    behind = 0
    last = len(content) - chain
    for word in words:
        if word in anchors:
            if behind > last:
                break
            found.append(word + " " + " ".join(content[behind : behind + chain]))
        else:
            behind += 1
    if not found:
        return {"\n" + text}
    unique = set(found)
    if len(unique) < len(found):
        counts = Counter(found)
        unique.update(f"{s} {k}" for s, n in counts.items() if n > 1 for k in range(1, n))
    return unique


def fingerprint(found: set[str]) -> str:
    """Length of the set and a digest of it: equal sets, and so equal texts, have equal fingerprints."""
    return f"{len(found):08x}{hashlib.md5('\n'.join(sorted(found)).encode()).hexdigest()}"


def likeness(a: set[str], b: set[str], least: float = 0.0) -> float:
    """Jaccard of two sets, or 0.0 where it is sure to be below ``least``; two empty sets are alike."""
    low, high = sorted((len(a), len(b)))
    if not high:
        return 1.0
    if low < least * high or not low:
        return 0.0
    common = len(a & b)
    found = common / (low + high - common)
    return found if found >= least else 0.0


def _hashed(found: set[str]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((digest(s) for s in found), np.uint64, len(found))).view(np.int64)


def with_signatures(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """(doc_id, fingerprint, hashed signatures) per row of ``docs``; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            for at in range(0, batch.num_rows, 512):
                sets = [signatures(t.as_py(), chain) for t in texts[at : at + 512]]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids[at : at + 512],
                        pa.array([fingerprint(s) for s in sets]),
                        pa.array([_hashed(s) for s in sets], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "fingerprint", "signatures"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string, signatures array<long>")


def _indexed(docs: DataFrame, threshold: float, chain: int, max_homes: int):
    """Rows with fingerprints, distinct fingerprints with their first id, their sets, and homes and probes of the sets.

    Equal fingerprints collapse first. Each set is indexed under its rarest signatures, as many as a pair above the
    threshold cannot all miss, within its class of lengths; probes go to that class and the next lower one. A signature
    that indexes more than ``max_homes`` sets of a class is split: these are dealt to chunks by hash, and its probes
    go to every chunk. ``left`` is how many signatures of the set are as frequent or more so: no pair has more in
    common than that, from its first common signature on.
    """
    rows = stored(with_signatures(docs, chain))
    prints = stored(rows.select("doc_id", "fingerprint").groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    one = stored(
        rows.select("fingerprint", "signatures").dropDuplicates(["fingerprint"])
        .withColumn("id", F.xxhash64("fingerprint")).withColumn("n", F.size("signatures"))
    )
    each = one.select("id", "n", F.explode("signatures").alias("s"))
    count = stored(each.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    # Signatures of one text only cannot make a pair, but they are the rarest, so that they shorten the prefix.
    ranked = (
        each.join(count, "s").groupBy("id", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("all"))
        .withColumn("most", F.expr(f"size(all) - cast(ceil({threshold} * n - 1e-9) as int) + 1"))
    )
    prefix = stored(ranked.where("most > 0").select(
        "id", "n", F.posexplode(F.slice("all", F.lit(1), F.col("most"))).alias("at", "p"),
        F.floor(F.log("n") / -log(threshold) + 1e-9).cast("int").alias("part"), F.size("all").alias("shared"),
    ).select("id", "n", "p.s", "part", (F.col("shared") - F.col("at")).alias("left")))
    probes = prefix.withColumn("part", F.explode(F.array("part", F.col("part") - 1)))
    full = stored(
        prefix.groupBy("s", "part").count().where(F.col("count") > max_homes)
        .select("s", "part", F.ceil(F.col("count") / max_homes).cast("int").alias("chunks"))
    )
    if full.isEmpty():
        homes, probes = (side.withColumn("chunk", F.lit(0)) for side in (prefix, probes))
    else:
        chunks = F.coalesce("chunks", F.lit(1))
        homes = prefix.join(full, ["s", "part"], "left").withColumn(
            "chunk", F.pmod(F.xxhash64("id"), chunks).cast("int")
        )
        probes = probes.join(full, ["s", "part"], "left").withColumn(
            "chunk", F.explode(F.sequence(F.lit(0), chunks - 1))
        )
    return rows, prints, one.select("id", "signatures"), homes, probes


# The smaller set is at home where the larger one probes; lengths, and what is left of the sets, allow the likeness.
_MEET = """a.s = b.s AND a.part = b.part AND a.chunk = b.chunk
           AND (a.n < b.n OR (a.n = b.n AND a.id < b.id)) AND a.n >= {threshold} * b.n - 1e-9
           AND least(a.left, b.left) * (1 + {threshold}) >= {threshold} * (a.n + b.n) - 1e-9"""


def _alike(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets have a Jaccard of at least ``threshold``."""
    return stored(
        pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
        .withColumn("common", F.size(F.array_intersect("x", "y")))
        .where(F.expr(f"common >= {threshold} * (size(x) + size(y) - common) - 1e-9")).select("a", "b")
    )


def near_duplicates(
    docs: DataFrame, threshold: float = 0.8, chain: int = CHAIN, max_homes: int = MAX_HOMES
) -> DataFrame:
    """(doc_id, fingerprint, class_id, links) per row: classes of texts linked by Jaccard >= threshold.

    ``class_id`` is the smallest doc_id of the class (null where it has none), ``links`` the number of
    other distinct fingerprints that the row's own is linked to, for which every pair is compared;
    :func:`duplicate_classes` gives the classes without. Empty texts are one class.
    An empty table gives an empty result; extra columns are ignored and repeated rows are kept.
    """
    rows, prints, sets, homes, probes = _indexed(docs, threshold, chain, max_homes)
    pairs = stored(
        homes.alias("a").join(probes.alias("b"), F.expr(_MEET.format(threshold=threshold)))
        .select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
    )
    links = _alike(pairs, sets, threshold)
    roots = components(links)
    degree = links.select("a").unionAll(links.select(F.col("b").alias("a"))).groupBy(F.col("a").alias("id")).count()
    placed = stored(
        prints.withColumn("id", F.xxhash64("fingerprint"))
        .join(roots.withColumnRenamed("node", "id"), "id", "left").join(degree, "id", "left")
        .select("fingerprint", "first", F.coalesce("root", "id").alias("root"), F.coalesce("count", F.lit(0)).alias("links"))
    )
    least = stored(placed.groupBy("root").agg(F.min("first").alias("class_id")))
    classes = stored(placed.join(least, "root").select("fingerprint", "class_id", "links"))
    return rows.select("doc_id", "fingerprint").join(classes, "fingerprint").select(
        "doc_id", "fingerprint", "class_id", "links"
    )


def duplicate_classes(
    docs: DataFrame, threshold: float = 0.8, chain: int = CHAIN, max_homes: int = MAX_HOMES
) -> DataFrame:
    """(doc_id, fingerprint, class_id) per row: the classes of :func:`near_duplicates`, without all pairs of a class.

    In each of ROUNDS rounds, one set under each signature and class of lengths, by hash another one each time, is
    compared with those that meet it there and are not in its class yet, which joins a group of near copies by a
    few pairs per member. Then whatever meets and is still not in one class is compared, pair by pair,
    so that no link between classes is lost and the rounds change no result. What is still quadratic
    is a comparison that must be made: many texts that share rare signatures and are not alike.
    Nulls, empty texts, repeats and empty tables are as there.
    """
    rows, prints, sets, homes, probes = _indexed(docs, threshold, chain, max_homes)
    place = ["s", "part", "chunk"]
    links = known = roots = None

    def open_places() -> tuple[DataFrame, DataFrame]:
        """Homes and probes with their classes, where sets of several classes meet."""
        if roots is None:
            return homes.withColumn("root", F.col("id")), probes.withColumn("root", F.col("id"))
        own, other = (
            stored(side.join(roots, "id", "left").select(*place, "n", "left", "id", F.coalesce("root", "id").alias("root")))
            for side in (homes, probes)
        )
        mixed = stored(
            other.groupBy(*place).agg(F.min("root").alias("low"), F.max("root").alias("high"))
            .where("low < high").select(*place)
        )
        return own.join(mixed, place, "left_semi"), other.join(mixed, place, "left_semi")

    def compare(found: DataFrame) -> DataFrame:
        """Adds the links among the pairs of ``found`` that were not compared before; returns these links."""
        nonlocal links, known, roots
        pairs = stored(found.distinct() if known is None else found.distinct().join(known, ["a", "b"], "left_anti"))
        near = _alike(pairs, sets, threshold)
        known = pairs if known is None else known.unionAll(pairs)
        links = near if links is None else links.unionAll(near)
        return near

    for number in range(ROUNDS):
        own, other = open_places()
        # One row per place, stored, so that Spark may split the other side of the join.
        stars = stored(
            own.groupBy(*place).agg(F.min(F.struct(F.xxhash64("id", F.lit(number)), "n", "left", "id", "root")).alias("star"))
            .select(*place, "star.n", "star.left", "star.id", "star.root")
        )
        met = stars.alias("a").join(other.alias("b"), F.expr(f"""
            a.s = b.s AND a.part = b.part AND a.chunk = b.chunk AND a.root <> b.root
            AND least(a.n, b.n) >= {threshold} * greatest(a.n, b.n) - 1e-9
            AND least(a.left, b.left) * (1 + {threshold}) >= {threshold} * (a.n + b.n) - 1e-9"""))
        swap = "a.n > b.n OR (a.n = b.n AND a.id > b.id)"
        near = compare(met.selectExpr(f"if({swap}, b.id, a.id) AS a", f"if({swap}, a.id, b.id) AS b"))
        if near.isEmpty():
            break
        roots = components(links).toDF("id", "root")
    own, other = open_places()
    met = own.alias("a").join(other.alias("b"), F.expr(_MEET.format(threshold=threshold) + " AND a.root <> b.root"))
    compare(met.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")))
    roots = components(links).toDF("id", "root")
    placed = stored(
        prints.withColumn("id", F.xxhash64("fingerprint")).join(roots, "id", "left")
        .select("fingerprint", "first", F.coalesce("root", "id").alias("root"))
    )
    least = stored(placed.groupBy("root").agg(F.min("first").alias("class_id")))
    classes = stored(placed.join(least, "root").select("fingerprint", "class_id"))
    return rows.select("doc_id", "fingerprint").join(classes, "fingerprint").select("doc_id", "fingerprint", "class_id")


def edited_and_next(docs: DataFrame, chain: int = CHAIN) -> DataFrame:
    """Each text against an edited form of itself and against the next document's text.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). The edited
    text has the last half of its code points replaced by the first as many of the next document, in
    ascending doc_id and around the end. Null ids come first; equal ids are in order of their texts. A null
    text counts as empty; a single document is its own next one; an empty table gives an empty result.

    The texts are dealt once, by blocks of ids. The first document of each block also goes to the block
    before; these are as many rows as there are blocks.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    bounds = block_bounds(rows, "doc_id")
    placed = with_block(rows, "doc_id", bounds)
    # At most one pair of numbers per block: MOST_BLOCKS in ordering.
    heads = [
        (r["head"], r["_block"])
        for r in with_block(rows.select("doc_id"), "doc_id", bounds)
        .groupBy("_block")
        .agg(F.when(F.count("doc_id") == F.count(F.lit(1)), F.min("doc_id")).alias("head"))
        .orderBy("_block").collect()
    ]
    blocks = [b for _, b in heads]
    before = docs.sparkSession.createDataFrame(
        [(head, blocks[i - 1]) for i, (head, _) in enumerate(heads)], "head long, before int"
    )
    dealt = (
        placed.join(F.broadcast(before), F.expr("doc_id <=> head"), "left")
        .withColumn("_to", F.explode(F.expr("""
            if(before IS NULL, array(named_struct('block', _block, 'extra', false)),
               array(named_struct('block', _block, 'extra', false), named_struct('block', before, 'extra', true)))
        """)))
        .select("doc_id", "text", F.col("_to.block").alias("block"), F.col("_to.extra").alias("extra"))
    )
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
         ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before, while it waits for its next one
        for batch in batches:
            out = []
            ids, texts, where, extra = batch.columns
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                own = signatures(text, chain)
                if held is not None and held[2] == where[i].as_py():
                    doc_id, before_text, block, found = held
                    keep = len(before_text) - len(before_text) // 2
                    edited = before_text[:keep] + text[: len(before_text) // 2]
                    changed = signatures(edited, chain)
                    out.append(
                        (doc_id, len(before_text), hashlib.sha256(edited.encode()).hexdigest(), fingerprint(found),
                         fingerprint(changed), likeness(found, changed), likeness(found, own))
                    )
                held = None if extra[i].as_py() else (ids[i].as_py(), text, where[i].as_py(), own)
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    ordered = dealt.repartition("block").sortWithinPartitions("block", "extra", "doc_id", "text")
    return ordered.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
