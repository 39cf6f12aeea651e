"""Repeated byte strings against a dictionary of all strings."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopstrata.llm import suffix_dedup
from shopstrata.llm.common import table

SCHEMA = "doc_id long, text string, code string, removed string"


def plain(rows, length):
    """Rows in order; every string is looked up among those that start earlier."""
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            string = data[i : i + length]
            if string in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(string)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        edges = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(data), sum(gone), edges, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, rows, length, gram, parts=4, bucket=suffix_dedup.BUCKET, spread=suffix_dedup.SPREAD):
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(parts)
    found = suffix_dedup.repeated_bytes(docs, length, gram, bucket, spread).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    expected = plain(order, length)
    assert sorted(tuple(r)[:5] for r in found) == sorted(expected) if None not in dict(rows) else True
    assert sorted(map(str, (tuple(r)[:5] for r in found))) == sorted(map(str, expected))
    for r in found:
        assert sum(s["stop"] - s["start"] for s in r["removed"]) == r["n_removed"]


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}é" for _ in range(n))


@pytest.mark.parametrize("seed", [1, 2])
def test_small_strings(spark, seed):
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randrange(0, 80)))) for i in range(60)]
    rows += [(100, "a" * 300), (101, "ab" * 200), (102, "abc" * 100), (103, None), (104, "a" * 11), (105, "a" * 12)]
    check(spark, rows, 12, 4)
    check(spark, rows, 12, 4, bucket=3, spread=2)


def test_passages(spark):
    rng = random.Random(3)
    passage, other = prose(rng, 40), prose(rng, 25)
    rows = []
    for i in range(90):
        words = prose(rng, rng.randrange(1, 120)).split()
        if i % 3 == 0:
            words[len(words) // 2 : len(words) // 2] = passage.split()
        if i % 7 == 0:
            words += other.split()[: rng.randrange(5, 25)]
        rows.append((i * 2, " ".join(words)))
    rows += [(300 + i, rows[i][1]) for i in range(5)]
    rows += [(400, rows[8][1] + " tail " + rows[8][1]), (401, ""), (-5, rows[9][1][30:]), (402, (prose(rng, 20) + "\n") * 20)]
    rng.shuffle(rows)
    check(spark, rows, 100, 24)
    # Small batches and buckets make many boundaries.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        for bucket in (1, 5):
            check(spark, rows, 100, 24, parts=2, bucket=bucket, spread=2)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_repeated_rows_and_null_ids(spark):
    text = prose(random.Random(4), 60)
    rows = [(None, text), (3, text), (3, text), (3, text[:99]), (3, text[:99])]
    docs = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)
    found = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"]) for r in suffix_dedup.repeated_bytes(docs).collect())
    n, m = len(text.encode()), len(text[:99].encode())
    short = (m if m >= 100 else 0)
    assert found == sorted([("None", n, 0), ("3", n, n), ("3", n, n), ("3", m, short), ("3", m, short)])
    docs = spark.createDataFrame([(3, text, "", ""), (3, text, "", "")], SCHEMA)
    assert sorted(r["n_removed"] for r in suffix_dedup.repeated_bytes(docs).collect()) == [0, n]


def test_texts_of_one_id_stay_apart(spark):
    """Two texts whose hashes agree in 31 bits, found by looking for them, keep all their bytes, with one id or none."""
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdefghij klmnop") for _ in range(150)) for _ in range(150_000)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("text", "xxhash64(text) & 2147483647 AS h")
    pairs = [r["both"] for r in frame.groupBy("h").agg(F.collect_set("text").alias("both")).where("size(both) > 1").collect()]
    assert pairs
    for doc_id in (None, 7):
        rows = [(doc_id, t) for both in pairs for t in both]
        docs = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)
        assert {(r["n_bytes"], r["n_removed"]) for r in suffix_dedup.repeated_bytes(docs).collect()} == {(150, 0)}


def test_a_third_of_equal_rows(spark):
    text = prose(random.Random(10), 60)
    rows = [(3, text)] * 200 + [(100 + i, prose(random.Random(100 + i), 60, 10**6)) for i in range(400)]
    docs = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)
    found = suffix_dedup.repeated_bytes(docs).collect()
    assert len(found) == 600
    n = len(text.encode())
    copies = sorted((r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found if r["doc_id"] == 3)
    assert copies == [(0, 0, hashlib.sha256(text.encode()).hexdigest())] + [(n, 1, hashlib.sha256(b"").hexdigest())] * 199


def test_long_text_in_pieces():
    rng = np.random.default_rng(5)
    text = rng.integers(97, 123, 3 * suffix_dedup.PIECE // 2, dtype=np.uint8).tobytes()
    seen = set()
    for data, ends, numbers, offsets in suffix_dedup._texts([b"short", text, text[:200]], 100):
        assert len(data) <= suffix_dedup.PIECE
        number, first, left, further, _, _ = suffix_dedup.anchors(data, ends, 100, 24)
        for n, f, k in zip(numbers[number].tolist(), (first + offsets[number]).tolist(), further.tolist()):
            strings = {(n, i) for i in range(f, f + k + 1)}
            assert not strings & seen
            seen |= strings
        assert (left <= 76).all() and (further <= 76).all()
    assert seen == {(1, i) for i in range(len(text) - 99)} | {(2, i) for i in range(101)}


def test_real_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    found = suffix_dedup.repeated_bytes(docs).collect()
    expected = plain(sorted((r["doc_id"], r["text"]) for r in docs.collect()), 100)
    assert sorted(tuple(r)[:5] for r in found) == expected


def test_empty(spark):
    assert suffix_dedup.repeated_bytes(spark.createDataFrame([], SCHEMA)).collect() == []
