"""Resharding: optimal flow, even shards, slots, and files."""

import itertools
import random
import zlib

from shopstrata.llm import reshard


def brute_cost(supplies, capacities):
    """Least cost of unit transfers by trying all ways to fill the capacities."""
    units = [i for i, s in enumerate(supplies) for _ in range(s)]
    spots = [j for j, c in enumerate(capacities) for _ in range(c)]
    return min(
        sum(i != j for i, j in zip(units, way))
        for way in set(itertools.permutations(spots, len(units)))
    )


def test_flow_is_optimal():
    rng = random.Random(3)
    for _ in range(30):
        supplies = [rng.randrange(4) for _ in range(3)]
        capacities = [rng.randrange(4) for _ in range(3)]
        if not sum(supplies) <= sum(capacities) <= 7:
            continue
        flow = reshard.min_cost_flow(supplies, capacities, lambda i, j: int(i != j))
        assert [sum(f for (i, _), f in flow.items() if i == k) for k in range(3)] == supplies
        assert all(sum(f for (_, j), f in flow.items() if j == k) <= capacities[k] for k in range(3))
        assert sum(f for (i, j), f in flow.items() if i != j) == brute_cost(supplies, capacities)


def test_general_costs_use_cheap_detours():
    cost = [[5, 1], [1, 3]]
    flow = reshard.min_cost_flow([4, 4], [4, 4], lambda i, j: cost[i][j])
    assert flow == {(0, 1): 4, (1, 0): 4}


def test_growth_moves_only_what_the_new_shards_need():
    blocks = {(s, b): 10 for s in range(4) for b in range(10)}
    placed = reshard.assign_blocks(blocks, reshard.even_capacities(400, 5))
    assert sum(10 for b, s in placed.items() if b[0] != s) == 80


def rows():
    rng = random.Random(4)
    found = [(i, "ä" * rng.randrange(300), "a", 1) for i in range(400)]
    found += [(None, None, None, None), (None, "x", "a", 1), (7, "same", "a", 1), (7, "same", "a", 1)]
    return [*found, (1000, "long " * 4000, "a", 1)]


def test_shards(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, shard string, first int").repartition(5)
    found = reshard.shard_documents(docs, 8).collect()
    expected = [(d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, _, _ in rows()]
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in found), key=str) == sorted(expected, key=str)
    per_shard = {s: [r for r in found if r["shard"] == s] for s in range(8)}
    longest = max(e[1] for e in expected)
    sizes = [sum(r["size"] for r in per_shard[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= longest
    for members in per_shard.values():
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
    assert {(r["law"], r["grown_shard"]) for r in found} == {("bytes", None)}
    assert sorted(map(str, found)) == sorted(map(str, reshard.shard_documents(docs, 8).collect()))


def test_a_third_are_equal_rows(spark):
    """Equal rows, without an id or with the same one, are spread like all others."""
    rng = random.Random(11)
    for doc_id in (None, 7):
        rows = [(i + 100, "x" * rng.randrange(100, 300)) for i in range(2000)] + [(doc_id, "y" * 200)] * 1000
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        found = reshard.shard_documents(docs, 40).collect()
        assert sorted(((r["doc_id"], r["size"]) for r in found), key=str) == sorted(
            ((d, len(t) + 16) for d, t in rows), key=str
        )
        sizes, slots = [0] * 40, [[] for _ in range(40)]
        for r in found:
            sizes[r["shard"]] += r["size"]
            slots[r["shard"]].append(r["slot"])
        assert max(sizes) - min(sizes) <= 316
        assert all(sorted(s) == list(range(len(s))) for s in slots)


def test_heavy_rows_are_fewer_than_blocks(spark):
    rows = [(i % 30, "z" * (i % 5)) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert 0 < reshard.heavy_rows(docs, 40).count() < 40


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert reshard.shard_documents(docs).collect() == []


def test_only_affected_files_are_rewritten(spark, tmp_path):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, _old string, row long")
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    reshard.write_layout(docs, old, old_shards=4, blocks=64)
    before = {p: p.read_bytes() for p in (tmp_path / "old").rglob("*.parquet")}
    found = reshard.reshard(spark, old, new, 5)
    assert sorted(map(str, (tuple(r["row"]) for r in found.collect()))) == sorted(map(str, rows()))
    assert {p: p.read_bytes() for p in (tmp_path / "old").rglob("*.parquet")} == before
    sizes = {r["_old"]: r["n"] for r in spark.read.parquet(old).groupBy("_old").agg({"_size": "sum"}).toDF("_old", "n").collect()}
    moved = found.where("_old <> _shard").selectExpr("sum(octet_length(coalesce(row.text, '')) + 16)").first()[0]
    target = sum(sizes.values()) / 5
    least = sum(max(0, n - target) for n in sizes.values())
    longest = max(len((r[1] or "").encode()) for r in rows())
    assert moved <= least + 2 * longest
    read_again = spark.read.parquet(new).count()
    assert read_again < len(rows())


def test_sharded_documents_keep_columns(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, shard string, n long")
    found = reshard.sharded_documents(docs, 6)
    assert found.columns == ["doc_id", "text", "n", "shard", "slot"]
    assert sorted(map(str, (tuple(r)[:3] for r in found.collect()))) == sorted(str((d, t, n)) for d, t, _, n in rows())
    assert reshard.sharded_documents(docs.limit(0)).collect() == []


def test_the_stage_rewrites_files(spark, monkeypatch):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, shard string, first int")
    folders = []
    whole = reshard.reshard

    def spied(spark, folder, target, shards):
        folders.extend((folder, target))
        return whole(spark, folder, target, shards)

    monkeypatch.setattr(reshard, "reshard", spied)
    found = reshard.sharded_documents(docs)
    assert found.columns == ["doc_id", "text", "first", "shard", "slot"]
    read = found.collect()
    old, new = folders
    assert 0 < spark.read.parquet(new).count() < spark.read.parquet(old).count() == len(read) == len(rows())
    by_query = reshard.shard_documents(docs).select("doc_id", "text_crc32", "shard", "slot").collect()
    ours = [(r["doc_id"], zlib.crc32((r["text"] or "").encode()), r["shard"], r["slot"]) for r in read]
    assert sorted(ours, key=str) == sorted(map(tuple, by_query), key=str)
    assert reshard.sharded_documents(docs.limit(0)).collect() == []
