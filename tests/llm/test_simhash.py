"""SimHash components against a comparison of all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from shopstrata.llm import simhash

SCHEMA = "doc_id long, text string, anchor string, fingerprint string"


def plain_print(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    n = min(shingle, len(words))
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, distance=2):
    prints = [plain_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(i)] = min(ids.get(find(i), doc), doc)
    return sorted(
        ((d, f"{p:016x}", ids.get(find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=str
    )


def corpus():
    rng = random.Random(5)
    rows = [(None, "lonely text"), (1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "oNE"), (5, "oNE")]
    base = [f"w{rng.randrange(400)}" for _ in range(4000)]
    rows.append((90, " ".join(base)))
    for i in range(40):
        words = list(base)
        for _ in range(i // 4):
            words[rng.randrange(len(words))] = f"x{rng.randrange(100)}"
        rows.append((100 + i, " ".join(words)))
    rows += [(200 + i, " ".join(f"v{rng.randrange(50)}" for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    rows += [(300 + i, "Ünï code É words") for i in range(3)]
    return rows


@pytest.mark.parametrize("max_homes", [simhash.MAX_HOMES, 2])
def test_components(spark, max_homes):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA).repartition(3)
    found = simhash.simhash_components(docs, max_homes=max_homes).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain_components(rows)


def test_every_close_pair_meets_at_a_home():
    rng = np.random.default_rng(1)
    x = rng.integers(-(2**63), 2**63, 300)
    for flips in ([0], [1, 2], [22, 23], [45, 46], [60, 63], [5, 30]):
        y = x.copy()
        for bit in flips:
            y ^= np.array([1 << bit], np.uint64).view(np.int64)
        sent = set()
        for index, anchor in simhash.anchors(y):
            sent |= set(zip(index.tolist(), anchor.tolist()))
        assert all((i, h) in sent for i, h in enumerate(simhash.homes(x).tolist()))
        assert len(sent) < 100 * len(x)


def test_homes_lie_within_the_radius():
    x = np.random.default_rng(2).integers(-(2**63), 2**63, 1000)
    away = simhash.homes(x) ^ (x & (1 << 46) - 1)
    assert (np.bitwise_count(away & simhash.HALF) <= 3).all()
    assert (np.bitwise_count(away >> 23) <= 3).all()


def test_chain_is_one_component(spark):
    prints = [sum(1 << b for b in range(2 * i)) for i in range(20)]
    table = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    found = simhash.components(simhash.links(table)).collect()
    assert len(found) == 20 and {r["root"] for r in found} == {0}


def test_one_of_each(spark):
    rows = [
        (1, "a b c d", "q"), (2, "a b c d", "r"), (2, "a b c d", "r"), (3, "z y x w v", "q"), (None, "nobody", "q"),
        (None, "somebody else", "s"), (None, "a b c d", "t"), (4, None, "q"), (5, "", "q"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(
        [rows[0], rows[3], rows[4], rows[5], rows[7]], key=str
    )


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.simhash_components(docs).collect() == []
