"""The Merkle manifest against trees built level by level."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from shopstrata.llm import merkle
from shopstrata.llm.common import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, leaf string, part long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def climb(levels, place, folded):
    seen = ""
    for nodes in levels[:-1]:
        run = place - place % 3
        before, after = "".join(nodes[run:place]), "".join(nodes[place + 1 : run + 3])
        folded, seen, place = sha(before + folded + after), seen + before + after, place // 3
    return folded, seen


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def plain(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    groups = defaultdict(list)
    for row in rows:
        even = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
        text = row[1].replace("\n", "") if even and row[1] is not None else row[1]
        groups[row[3]].append((row[0] is not None, row[0] or 0, leaf(row, row[1]), leaf(row, text)))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([g[2] for g in sorted(groups[s])]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for i, s in enumerate(sources):
        for place, (some, doc_id, known, shown) in enumerate(sorted(groups[s])):
            folded, seen = climb(trees[s], place, shown)
            folded, more = climb(top, i, folded)
            root = top[-1][0]
            out.append((doc_id if some else None, known, trees[s][-1][0], root, sha(seen + more), folded, folded == root))
    return sorted(out, key=str)


def found(spark, rows, partition_rows=merkle.PARTITION_ROWS):
    docs = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in merkle.merkle_manifest(docs, partition_rows).collect()), key=str)


def some_rows(seed, n, sources):
    rng = random.Random(seed)
    return [
        (i * 3, rng.choice(["", "a\nb", "é\n", "plain", None]), rng.choice(["en", None]), rng.choice(sources), i)
        for i in range(n)
    ]


@pytest.mark.parametrize("n,partition_rows", [(1, 50), (2, 50), (300, 9), (1000, 100)])
def test_against_whole_trees(spark, n, partition_rows):
    rows = some_rows(n, n, [None, "", "a", "b", "é", "B", "hot", "hot", "hot"])
    random.Random(n).shuffle(rows)
    answer = found(spark, rows, partition_rows)
    assert answer == plain(rows)
    if n > 100:
        assert {r[-1] for r in answer} == {True, False}


def test_many_sources_and_rounds(spark, monkeypatch):
    rows = some_rows(7, 400, [f"s{i:03}" for i in range(150)] + ["hot"] * 150)
    assert found(spark, rows, 20) == plain(rows)


def test_small_subtrees(spark):
    """Many rounds over one source give the nodes of one round."""
    leaves = [(("sx"), 0, i, 500, sha(str(i))) for i in range(500)]
    frame = spark.createDataFrame(leaves, "tree string, level long, place long, count long, hash string")
    nodes = [r for f in merkle.interior_nodes(frame, 500, 2) for r in f.collect()]
    whole = tree([r[-1] for r in leaves])
    assert sorted((r["level"], r["place"], r["hash"]) for r in nodes) == sorted(
        (level, place, h) for level, hashes in enumerate(whole) for place, h in enumerate(hashes)
    )


def test_missing_nodes_are_the_fewest():
    for count in range(1, 40):
        whole = tree([sha(str(i)) for i in range(count)])
        for start in range(count):
            for stop in range(start + 1, count + 1):
                asked = merkle.missing(start, stop, count)
                assert len(set(asked)) == len(asked)
                levels = merkle.derived(whole[0][start:stop], start, count, {p: whole[p[0]][p[1]] for p in asked})
                assert levels[-1] == (0, whole[-1])
                # Each of them covers leaves of its own only, so none follows from the others.
                covered = [set(range(p * 3**k, min((p + 1) * 3**k, count))) for k, p in asked]
                assert sum(map(len, covered)) + stop - start == count == len(set().union(range(start, stop), *covered))


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "x\ny", None, None, 1), (None, "x\ny", "", "", 1)]
    rows += [(4, "same\n", "en", "a", 5)] * 40 + [(5, "z\n" * 300_000, "en", "a", 1), (6, "", "en", "-", 0)]
    assert found(spark, rows, 5) == plain(rows)


def test_empty(spark):
    assert found(spark, []) == []


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert sorted((tuple(r) for r in merkle.merkle_manifest(docs, 60).collect()), key=str) == plain(rows)
