"""Decontamination: alignment against a plain table, planted exact and edited copies, odd rows."""

import random
from collections import Counter

import numpy as np
import pytest

from shopstrata.llm import decontaminate as dec

DOCS = "doc_id long, text string, score double, item_id string"
ITEMS = "item_id long, text string, doc_id string"


def plain_score(item, weights, window):
    """Smith-Waterman cell by cell."""
    mean = sum(weights) / len(weights)
    rows = [[0.0] * (len(window) + 1) for _ in range(len(item) + 1)]
    best = 0.0
    for i in range(len(item)):
        for j in range(len(window)):
            hit = weights[i] if item[i] == window[j] else -dec.MISMATCH * mean
            rows[i + 1][j + 1] = max(0.0, rows[i][j] + hit, rows[i][j + 1] - dec.GAP * mean, rows[i + 1][j] - dec.GAP * mean)
            best = max(best, rows[i + 1][j + 1])
    return best / sum(weights)


def test_alignment():
    rng = random.Random(1)
    for _ in range(200):
        item = np.array([rng.randrange(6) for _ in range(rng.randrange(1, 12))])
        window = np.array([rng.randrange(-1, 6) for _ in range(rng.randrange(1, 20))])
        weights = np.array([rng.choice([0.5, 1.0, 3.0]) for _ in item])
        score, i0, i1, j0, j1 = dec.align(item, weights, window)
        assert abs(score - plain_score(item.tolist(), weights.tolist(), window.tolist())) < 1e-9
        again = dec.align(item, weights, window[j0:j1])[0] if score else 0.0
        assert abs(score - again) < 1e-9 and 0 <= i0 <= i1 <= len(item)


def corpus():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of"] * 100
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(prose(rng.randrange(15, 40)))) for i in range(12)]
    docs, planted = [], {}
    for d in range(150):
        words = prose(rng.randrange(0, 200))
        if d % 3 == 0:
            item = rng.randrange(12)
            copy = items[item][1].split()
            edits = 0 if d % 2 else len(copy) // 6
            for _ in range(edits):
                spot = rng.randrange(len(copy))
                change = rng.choice(["swap", "drop", "add"])
                copy[spot : spot + (change != "add")] = [] if change == "drop" else ["edited"]
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w.upper() + "," if d % 5 == 0 else w for w in copy]
            planted[d] = item
        docs.append((d, " ".join(words)))
    return docs, items, planted


@pytest.mark.parametrize("block_chars", [dec.BLOCK_CHARS, 600])
def test_planted(spark, block_chars):
    docs, items, planted = corpus()
    odd = [(None, None), (None, items[0][1]), (500, ""), (501, " ".join(["filler"] * 30000) + " " + items[1][1]), (0, docs[0][1])]
    rows = spark.createDataFrame([(*r, 1.0, "x") for r in docs + odd], DOCS).repartition(4)
    bench = spark.createDataFrame([(*r, "y") for r in [*items, (None, None), (77, ""), items[3], (78, "!?")]], ITEMS)
    found = dec.contaminated(rows, bench, block_chars=block_chars).collect()
    pairs = Counter((r["doc_id"], r["item_id"]) for r in found)
    wanted = Counter({p: 1 for p in planted.items()})
    wanted += Counter({(None, 0): 1, (501, 1): 1})
    wanted[0, planted[0]] += 1
    assert pairs == wanted
    # The same scores as cell-by-cell alignment with the whole document.
    lower = [dec.WORDS.findall((t or "").lower()) for _, t in docs + odd]
    df = Counter(w for words in lower for w in set(words))
    texts, known = dict(docs), dict(items)
    for r in found[:40]:
        if r["doc_id"] in texts:
            item = known[r["item_id"]].split()
            weights = [float(np.log(1 + len(lower) / df[w])) if df[w] else float(np.log(1 + len(lower))) for w in item]
            words = dec.WORDS.findall(texts[r["doc_id"]].lower())
            assert abs(r["score"] - plain_score(item, weights, words)) < 1e-6
    clean = dec.clean_documents(rows, bench, block_chars=block_chars)
    assert clean.columns == rows.columns
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(
        [str(d) for d, _ in docs if d not in planted] + ["None", "500"]
    )


def test_a_leak_into_most_documents_is_still_found(spark):
    docs, items, _ = corpus()
    rows = spark.createDataFrame([(d, t + " " + items[5][1], 0.0, "") for d, t in docs], DOCS)
    bench = spark.createDataFrame([(*r, "") for r in items], ITEMS)
    assert {r["doc_id"] for r in dec.contaminated(rows, bench).where("item_id = 5").collect()} == {d for d, _ in docs}


def test_short_items_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "only one Word here", 0.0, ""), (2, "nothing", 0.0, "")], DOCS)
    bench = spark.createDataFrame([(1, "word", ""), (2, "", "")], ITEMS)
    assert [(r["doc_id"], r["item_id"]) for r in dec.contaminated(docs, bench).collect()] == [(1, 1)]
    assert dec.contaminated(docs, bench.limit(0)).collect() == []
    assert dec.contaminated(docs.limit(0), bench).collect() == []
    assert dec.clean_documents(docs, bench.limit(0)).count() == 2
