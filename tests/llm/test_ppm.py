"""Partial matching against a trie of dictionaries, walked byte by byte."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from shopstrata.llm import ppm
from shopstrata.llm.common import table

SCHEMA = "doc_id long, text string, block string, word string, n string"


def held(doc_id, modulus=10):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == 0


def trie(texts, order):
    followed = defaultdict(Counter)
    for text in texts:
        data = b"\xff" * order + text + b"\xff"
        for i in range(order, len(data)):
            for k in range(order + 1):
                followed[data[i - k : i]][data[i]] += 1
    return followed


def probability(followed, context, symbol):
    """By the definition: escape with method C, exclude what the longer contexts have seen."""
    p, out = 1.0, set()
    while True:
        seen = {s: c for s, c in followed.get(context, {}).items() if s not in out}
        if seen:
            n, q = sum(seen.values()), len(seen)
            if symbol in seen:
                return p * seen[symbol] / (n + q)
            p *= q / (n + q)
            out |= set(seen)
        if not context:
            return p / (256 - len(out))
        context = context[1:]


def plain(rows, order):
    rows = [(d, (t or "").encode()) for d, t in rows]
    learnt = [t for d, t in rows if not held(d)]
    followed = trie(learnt, order)
    words = Counter(w for t in learnt for w in t.lower().split())
    tokens, kinds = sum(words.values()) + len(learnt), len(words) + bool(learnt)
    out = []
    for d, t in rows:
        data = b"\xff" * order + t + b"\xff"
        score = sum(math.log10(probability(followed, data[i - order : i], data[i])) for i in range(order, len(data)))
        counts = [words[w] for w in t.lower().split()] + [len(learnt)]
        base = sum(math.log10((c + 0.1) / (tokens + 0.1 * (kinds + 1))) for c in counts)
        out.append((d, held(d), len(counts), sum(c > 0 for c in counts), tokens, base, score))
    return out


def check(spark, rows, order=4, parts=3, block_bytes=2000):
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(parts)
    found = ppm.language_scores(docs, order=order, block_bytes=block_bytes).collect()
    key = lambda r: (str(r[0]), *r[2:4], round(r[5], 4), round(r[6], 4))
    found, expected = sorted(map(tuple, found), key=key), sorted(plain(rows, order), key=key)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    for a, b in zip(found, expected):
        assert a[5:] == pytest.approx(b[5:], abs=2e-6)


def some_rows(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "a", "é", "wörd", "ab", "ba", "x" * 30, "日本", "\x85", " "]
    return [(i, rng.choice([" ", "\n"]).join(rng.choice(words) for _ in range(rng.randrange(40)))) for i in range(n)]


@pytest.mark.parametrize("order", [2, 4, 6])
def test_against_dictionaries(spark, order):
    rows = some_rows(order, 150) + [(10**6 + i, f"unseen {chr(200 + i)} {i}") for i in range(80)]
    assert sum(held(d) for d, _ in rows) > 10
    check(spark, rows, order)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(ppm, "PIECE", 1000)
    held_ids = [i for i in range(100) if held(i)]
    rows = [(None, "no id"), (None, None), (1, ""), (2, " \n"), (held_ids[0], None), (held_ids[1], "never seen \x00\x7f")]
    rows += [(7, "copy of a row " * 9)] * 60 + [(8, "long " * 20_000), (9, "ÿþ" * 500)]
    check(spark, rows, parts=4)


def test_words_in_some_blocks(spark):
    """Words that one block learns, several learn, or none, looked up in blocks before and after."""
    out = [i for i in range(400) if held(i)]
    rows = [(1000 + i, f"one{i} two{i // 2} filler") for i in range(60) if not held(1000 + i)]
    rows += [(d, f"one{d % 60} two{d % 30} none{d}") for d in out]
    for block_bytes in (1, 300):
        check(spark, rows, parts=5, block_bytes=block_bytes)


def test_nothing_to_learn(spark):
    check(spark, [(i, "a b") for i in range(200) if held(i)])
    assert ppm.language_scores(spark.createDataFrame([], SCHEMA)).collect() == []


def test_costs_are_probabilities():
    """After any context, known or not, the chances of all bytes add up to one."""
    texts = [t.encode() for _, t in some_rows(5, 60)]
    grams, counts = ppm.block_grams(texts, [False] * len(texts))
    pairs = ppm.distinct(grams & 0xFFFF, counts)
    levels = ppm.levels_above(pairs, grams, counts, ppm.ORDER)
    for context in (b"the ", b"\xff" * 4, b"zzzz", b"zzab", b" the", b"\xff\xffab"):
        some = (int.from_bytes(context, "big") << 8) | np.arange(256)
        assert (10 ** ppm.gram_costs(levels, some)).sum() == pytest.approx(1)


def test_flushes_keep_contexts_whole(spark, monkeypatch):
    texts = [t.encode() for _, t in some_rows(6, 80)]
    grams, counts = ppm.block_grams(texts, [i >= 60 for i in range(len(texts))])
    order = np.lexsort((grams, (grams >> 8) & 0xFFFF))
    grams, counts = grams[order], counts[order]
    low = ppm.distinct(grams[counts > 0] & 0xFFFF, counts[counts > 0])
    batches = [
        ppm.pa.RecordBatch.from_arrays([ppm.pa.array(grams[i : i + 10]), ppm.pa.array(counts[i : i + 10])], ["gram", "n"])
        for i in range(0, len(grams), 10)
    ]
    whole = [ppm.pa.Table.from_batches(list(ppm._costs(low, 4)(iter(batches))))]
    monkeypatch.setattr(ppm, "FLUSH", 35)
    flushed = list(ppm._costs(low, 4)(iter(batches)))
    assert len(flushed) > 5
    assert ppm.pa.Table.from_batches(flushed).to_pylist() == whole[0].to_pylist()


def test_held_out_texts_of_the_corpus_are_likelier_than_shuffled_ones(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    rng = random.Random(8)
    mixed = [(1_000_000 + d * 10_000, "".join(rng.sample(t, len(t)))) for d, t in rows]
    mixed = [(d + next(k for k in range(10_000) if held(d + k)), t) for d, t in mixed]
    both = spark.createDataFrame([(*r, "", "", "") for r in rows + mixed], SCHEMA)
    found = {r["doc_id"]: r["score"] for r in ppm.language_scores(both).collect()}
    pairs = [(found[d], found[m]) for (d, t), (m, _) in zip(rows, mixed) if held(d) and len(t) > 20]
    assert pairs and all(a > b for a, b in pairs)
