"""SpotSigs against plain versions."""

import hashlib
import random
from collections import Counter

import pytest

import __spark_entry__ as contract
from shopstrata.llm import spotsigs

SCHEMA = "doc_id long, text string, block int, extra boolean"


def plain_set(text):
    words = spotsigs.WORDS.findall((text or "").lower())
    found = []
    for i, word in enumerate(words):
        if word in spotsigs.ANCHORS:
            chain = [w for w in words[i:] if w not in spotsigs.ANCHORS][:2]
            if len(chain) == 2:
                found.append((word, *chain))
    if not found and text:
        found = [("", text)]
    return Counter(found)


def plain_likeness(a, b):
    x, y = plain_set(a), plain_set(b)
    return 1.0 if not x and not y else sum((x & y).values()) / sum((x | y).values())


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "und", "la", *(f"w{i}" for i in range(30))]) for _ in range(n))


def corpus():
    rng = random.Random(2)
    rows = [(i * 3, words(rng, rng.randrange(0, 60))) for i in range(80)]
    base = words(rng, 300).split()
    for i in range(12):
        changed = list(base)
        for _ in range(i):
            changed[rng.randrange(len(changed))] = f"z{i}"
        rows.append((500 + i, " ".join(changed)))
    rows += [(900, base and " ".join(base)), (901, None), (902, ""), (903, "!!!"), (904, "Ä" * 7), (905, "the of the")]
    rows += [(906, "ja " * 3), (907, "x" * 20001)]
    return rows


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc, text) in enumerate(rows):
        text, nxt = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + nxt[:half]
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                    round(plain_likeness(text, edited), 9), round(plain_likeness(text, nxt), 9)))
    return sorted(out, key=str)


@pytest.mark.parametrize("extra", [[], [(None, "a null id"), (None, "another"), (4000, "z"), (4000, "y")]])
def test_edited_and_next(spark, extra):
    rows = corpus() + extra
    docs = spark.createDataFrame([(*r, 3, True) for r in rows], SCHEMA).repartition(3)
    found = spotsigs.edited_and_next(docs).collect()
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in found]
    assert sorted(got, key=str) == expected(rows)
    by_text = {}
    texts = {r[0]: r[1] or "" for r in rows}
    for r in found:
        if r["doc_id"] in texts and r["doc_id"] not in (None, 4000):
            by_text.setdefault(texts[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())


def test_one_and_none(spark):
    docs = spark.createDataFrame([(1, "the one text here", 0, False)], SCHEMA)
    [row] = spotsigs.edited_and_next(docs).collect()
    assert row["near_next"] == 1.0
    assert spotsigs.edited_and_next(docs.limit(0)).collect() == []


def test_likeness_gives_up_early():
    a = spotsigs.signatures(words(random.Random(1), 200))
    b = set(sorted(a)[: len(a) // 2])
    assert spotsigs.likeness(a, b) == len(b) / len(a)
    assert spotsigs.likeness(a, b, 0.8) == 0.0 and spotsigs.likeness(a, a, 1.0) == 1.0


def test_near_duplicates(spark):
    rows = [*corpus(), (900, corpus()[80][1]), (None, "no id the aa bb")]
    docs = spark.createDataFrame([(*r, 1, False) for r in rows], SCHEMA).repartition(3)
    found = spotsigs.near_duplicates(docs, 0.8).collect()
    texts = list({r[1] or "" for r in rows})
    sets = {t: plain_set(t) for t in texts}
    key = {t: frozenset(sets[t].items()) for t in texts}
    kinds = list(set(key.values()))
    near = {k: set() for k in kinds}
    for a in kinds:
        for b in kinds:
            x, y = Counter(dict(a)), Counter(dict(b))
            union = sum((x | y).values())
            if a != b and union and sum((x & y).values()) / union >= 0.8:
                near[a].add(b)
    root = {}
    for k in kinds:
        if k not in root:
            todo = [k]
            while todo:
                at = todo.pop()
                if at not in root:
                    root[at] = k
                    todo += near[at]
    ids = {}
    for doc, text in rows:
        if doc is not None:
            r = root[key[text or ""]]
            ids[r] = min(ids.get(r, doc), doc)
    wanted = [(d, ids.get(root[key[t or ""]]), len(near[key[t or ""]])) for d, t in rows]
    assert sorted(((r["doc_id"], r["class_id"], r["links"]) for r in found), key=str) == sorted(wanted, key=str)
    assert spotsigs.near_duplicates(docs.limit(0)).collect() == []


def test_registered_query_finds_copies_that_are_not_neighbours(spark, tmp_path):
    rng = random.Random(5)
    base = words(rng, 400)
    rows = [(i, words(rng, 60), 1, False) for i in range(1, 30)]
    rows += [(0, base, 1, False), (40, base + " the last w1 w2", 1, False)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: (r["class_id"], r["links"]) for r in contract.queries()["spotsigs_classes"](spark, str(tmp_path)).collect()}
    assert found == {i: (i, 0) for i in range(1, 30)} | {0: (0, 1), 40: (0, 1)}


def test_hot_signatures_in_chunks(spark):
    docs = spark.createDataFrame([(*r, 1, False) for r in corpus()], SCHEMA)
    whole = sorted(map(str, spotsigs.near_duplicates(docs).collect()))
    assert sorted(map(str, spotsigs.near_duplicates(docs, max_homes=2).collect())) == whole


def chained():
    """Near copies in rows where only neighbours are alike, and two groups that meet but are not."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(500)}" if i % 3 else "the" for i in range(400)]
    rows = []
    for i in range(25):
        text = list(base)
        for j in range(0, 10 * i, 2):
            text[j] = f"y{j}"
        rows.append((2000 + i, " ".join(text)))
    for i in range(40):
        text = [*base[:200], *(f"v{j}" if j % 3 else "of" for j in range(200))]
        text[rng.randrange(400)] = f"u{i}"
        rows.append((3000 + i, " ".join(text)))
    return rows


@pytest.mark.parametrize("max_homes", [spotsigs.MAX_HOMES, 3])
def test_classes_without_all_pairs(spark, max_homes):
    rows = [*corpus(), *chained(), (900, corpus()[80][1]), (None, "no id the aa bb"), (None, None)]
    docs = spark.createDataFrame([(*r, 1, False) for r in rows], SCHEMA).repartition(3)
    found = spotsigs.duplicate_classes(docs, max_homes=max_homes)
    assert found.columns == ["doc_id", "fingerprint", "class_id"]
    whole = spotsigs.near_duplicates(docs).drop("links")
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))
    assert spotsigs.duplicate_classes(docs.limit(0)).collect() == []


def test_copies_are_not_compared_in_pairs(spark, monkeypatch):
    rng = random.Random(4)
    base = words(rng, 600).split()
    rows = []
    for i in range(300):
        text = list(base)
        text[rng.randrange(600)] = f"z{i}"
        rows.append((i, " ".join(text), 1, False))
    docs = spark.createDataFrame(rows, SCHEMA)
    compared = []
    alike = spotsigs._alike
    monkeypatch.setattr(spotsigs, "_alike", lambda pairs, *a: compared.append(pairs.count()) or alike(pairs, *a))
    assert {r["class_id"] for r in spotsigs.duplicate_classes(docs).collect()} == {0}
    assert sum(compared) < 20 * 300 < 300 * 299 / 2
