"""The prefix trie against dictionaries of prefixes."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from shopstrata.llm import prefix_trie
from shopstrata.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string, depth string, shard string"


def plain(rows):
    """Nodes of rows (conv_id, turn, role, text) as a sorted list; equal turn numbers are in the order given."""
    talks = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            talks[c].append(((turn is not None, turn or 0), (role or "", text or "")))
    talks = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in talks.items()}
    members = defaultdict(list)
    whole = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(talks.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:])
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if whole[c] == p)))
        out.append((
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(spark, rows, shard_turns=prefix_trie.SHARD_TURNS):
    turns = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    nodes = prefix_trie.conversation_trie(turns, shard_turns)
    assert nodes.columns == prefix_trie.COLUMNS
    return sorted((tuple(r) for r in nodes.collect()), key=str)


@pytest.mark.parametrize("seed,shard_turns", [(1, 10_000), (2, 40), (3, 5)])
def test_against_dictionaries(spark, seed, shard_turns):
    rng = random.Random(seed)
    rows = []
    for c in range(0, 400, rng.choice([1, 3])):
        for t in range(rng.randrange(0, 9)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["", "a", "é", "long text"])))
    rng.shuffle(rows)
    assert found(spark, rows, shard_turns) == plain(rows)


def test_a_third_are_copies(spark):
    """One conversation of a third of all rows is cut between shards and counted once."""
    rows = [(100 * c, t, "user", f"same {t}") for c in range(60) for t in range(4)]
    rows += [(100 * c + 6000, t, "user", f"own {c} {t}") for c in range(40) for t in range(c % 7)]
    rows += [(100 * c + 20000, t, "user", f"same {t}") for c in range(40) for t in range(1 + c % 6)]
    expected = plain(rows)
    assert found(spark, rows, 7) == expected
    assert max(r[3] for r in expected if r[1] == 4) >= 60


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "nobody"), (-3, 0, "user", "below"), (0, None, None, None), (0, 1, "user", "x"),
        (100, None, "", ""), (100, 1, "user", "x"), (5, 3, "user", "x" * 100_000), (7, 0, "u", "ser"), (107, 0, "us", "er"),
    ]
    assert found(spark, rows) == plain(rows)


def test_repeated_rows_and_long_conversations(spark):
    rows = [(200, 0, "user", "x")] * 3 + [(300, 0, "user", "x")] * 3
    rows += [(c, t, "user", f"{t}") for c in (400, 500) for t in range(900)]
    assert found(spark, rows, 100) == plain(rows)


def test_empty(spark):
    assert found(spark, []) == []


def test_tree_is_balanced():
    tree = prefix_trie.TernaryTree([[i, 0] for i in range(1023)])

    def height(node):
        return 0 if node < 0 else 1 + max(height(tree.low[node]), height(tree.high[node]))

    assert height(tree.child[0]) == 10
    assert sorted(tree.walk()) == list(range(len(tree.symbol)))


def test_whole_table(spark):
    turns = table(spark, "/root/testdata/sf0.01", "conversations")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    nodes = sorted((tuple(r) for r in prefix_trie.conversation_trie(turns).collect()), key=str)
    assert nodes == plain(rows)
