"""The mixture: targets, quotas and taken words against plain versions."""

import random
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from shopstrata.llm import mixture

SCHEMA = "doc_id long, text string, source string, n_chars long, size string, target string"


def plain_apportion(goals, seats, most):
    found = [0] * len(goals)
    for _ in range(seats):
        open_ = [i for i in range(len(goals)) if goals[i] and found[i] < most[i]]
        if not open_:
            break
        best = max(open_, key=lambda i: (Fraction(goals[i]) / (2 * found[i] + 1), -i))
        found[best] += 1
    return found


def test_apportion():
    rng = random.Random(1)
    for _ in range(300):
        goals = [Fraction(rng.choice([0, 1, 3, 7, rng.randrange(1000)])) for _ in range(rng.randrange(1, 7))]
        most = [rng.randrange(1, 60) for _ in goals]
        seats = rng.randrange(0, 120)
        assert mixture.apportion(goals, seats, most) == plain_apportion(goals, seats, most)


def test_quotas_are_whole_and_add_up():
    goals = [Fraction(500), Fraction(300), Fraction(7)]
    found = mixture.shard_quotas(goals, 200, [200] * 3, 7)
    assert all(q >= 0 for shard in found for q in shard)
    assert [sum(s) for s in zip(*found)] == mixture.apportion(goals, 200, [200] * 3)
    assert max(map(sum, found)) - min(map(sum, found)) <= 1


def test_targets():
    goals = mixture.targets([10, 100, 100], [5, 2, 1], Fraction(315), 2)
    assert goals == [20, Fraction(590, 3), Fraction(295, 3)]
    assert mixture.targets([1, 1], [5, 2], Fraction(3), 2) == [2, 1]


def rows():
    rng = random.Random(6)
    found = []
    for i in range(300):
        source = rng.choice(["b", "B", "é", "a", None, "a", "a"])
        words = " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(0, 40)))
        found.append((i, words, source, len(words), "x", "y"))
    found += [(None, None, "a", None, "x", "y"), (5, "twice same", "a", 10, "x", "y")] * 2
    return [*found, (900, "  long\t text " * 800, "b", 9600, "x", "y"), (901, "one", "tiny", 3, "x", "y")]


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("blocks", [mixture.BLOCKS, 50])
def test_mix(spark, blocks):
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(4)
    found = mixture.mix(docs, blocks=blocks).collect()
    assert sorted(((r["doc_id"], r["size"]) for r in found), key=str) == sorted(
        ((r[0], size(r[1])) for r in rows()), key=str
    )
    sizes = Counter()
    for r in rows():
        sizes[r[2]] += size(r[1])
    names = sorted((s for s in sizes if s is not None)) + [None]
    total = Fraction(3, 2) * sum(sizes.values())
    goals = dict(zip(names, mixture.targets([sizes[s] for s in names], [5, 2, 1, 5, 2, 1], total, 2)))
    length = -(-int(total) // blocks)
    taken = Counter()
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == float(goals[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in names:
        assert abs(taken[s] - goals[s]) <= 2 * length + 1
    assert sorted(map(str, found)) == sorted(map(str, mixture.mix(docs.repartition(2), blocks=blocks).collect()))
    mixed = mixture.mixed_documents(docs, blocks=blocks)
    assert mixed.columns == docs.columns
    words = Counter()
    known = {(r[0], r[2], r[1]) for r in rows()}
    cut = 0
    for r in mixed.collect():
        words[r["source"]] += size(r["text"])
        cut += (r["doc_id"], r["source"], r["text"]) not in known
    assert words == taken
    assert cut <= 2 * len(names)


def test_small_sources_beside_a_huge_one(spark):
    """60,000 words beside 3, 40 and 90: blocks of 901 words would take none of the small sources, or too much."""
    rows_ = [(i, " ".join(f"w{j}" for j in range(200)), "huge", 0, "", "") for i in range(300)]
    rows_ += [(1000, "one two three", "a", 0, "", ""), (1001, "w " * 40, "b", 0, "", ""), (1002, "w " * 90, "c", 0, "", "")]
    docs = spark.createDataFrame(rows_, SCHEMA)
    taken, target = Counter(), {}
    for r in mixture.mix(docs, blocks=100).collect():
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert [target[s] for s in "abc"] == [6, 80, 180]
    assert all(abs(taken[s] - goal) <= 1 + goal / 16 for s, goal in target.items())


def test_the_smallest_target_is_worth_some_blocks(spark):
    narrow = spark.createDataFrame([("=a", 5_000_000_000), ("=b", 1500), ("=c", 0)], "_key string, size long")
    plan = mixture.mix_plan(narrow)
    for p in plan[:2]:
        assert abs(p["quota"] * p["length"] - p["target"]) <= 2 * p["length"] <= max(2, p["target"] / 16)
    assert plan[2]["quota"] == 0


def test_every_source_may_be_empty(spark):
    docs = spark.createDataFrame([(1, None, "a", None, "", ""), (2, " ", None, 1, "", "")], SCHEMA)
    assert {(r["size"], r["taken"], r["target"]) for r in mixture.mix(docs).collect()} == {(0, 0, 0.0)}
    none = docs.where(F.lit(False))
    assert mixture.mix(none).collect() == [] and mixture.mixed_documents(none).collect() == []


def test_quota_table(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    found = mixture.quota_table(docs, blocks=200, shards=4).collect()
    plan = mixture.mix_plan(mixture.sized(docs), blocks=200, shards=4)
    per_shard = Counter()
    for p in plan:
        own = [r for r in found if r["source"] == (None if p["_key"] == "~" else p["_key"][1:])]
        assert sum(r["blocks"] for r in own) == p["quota"] <= 2 * p["blocks"]
        assert not own or min(own, key=lambda r: r["shard"])["first_block"] == p["start"]
        for r in own:
            per_shard[r["shard"]] += r["blocks"]
    assert max(per_shard.values()) - min(per_shard.values()) <= 1


def test_shards_take_their_quotas(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    found = mixture.mix(docs, shards=4).collect()
    assert all(sum(x["words"] for x in r["shards"]) == r["taken"] for r in found)
    words = Counter()
    for r in found:
        for x in r["shards"]:
            words[r["source"], x["shard"]] += x["words"]
    table = mixture.quota_table(docs, shards=4).collect()
    # Blocks of one word: every shard gets just the words of its blocks.
    assert words == {(r["source"], r["shard"]): r["blocks"] for r in table}
    assert {shard for _, shard in words} == {0, 1, 2, 3}
