"""The registered queries that SQL cannot express, over a whole small test set, against plain versions."""

import os
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
from shopstrata.llm.common import table

from .test_simhash import plain_components

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return sorted((r["doc_id"], r["text"]) for r in table(spark, SF_DIR, "documents").collect())


def answer(spark, name):
    return contract.queries()[name](spark, SF_DIR)


def test_every_operator_is_registered():
    names = contract.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names


def test_token_records(spark, documents):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected, start = [], 0
    for doc_id, text in documents:
        ids = plain.encode(text, add_special_tokens=False).ids + [0]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, answer(spark, "op5_token_records").collect())) == expected


def test_shards(spark, documents):
    found = answer(spark, "op7_sharding").collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == [
        (d, len(t.encode()) + 16, zlib.crc32(t.encode())) for d, t in documents
    ]
    sizes = [sum(r["size"] for r in found if r["shard"] == s) for s in range(40)]
    longest = max(r["size"] for r in found)
    assert max(sizes) - min(sizes) <= longest
    for s in range(40):
        slots = sorted(r["slot"] for r in found if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_simhash(spark, documents):
    found = sorted((tuple(r) for r in answer(spark, "op9_simhash_near_dedup").collect()), key=str)
    assert found == plain_components(documents)


def test_leaks(spark, documents):
    items = {r["item_id"]: r["text"] for r in table(spark, SF_DIR, "benchmark").collect()}
    expected = {(d, i) for d, t in documents for i, passage in items.items() if passage in t}
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in answer(spark, "op10_decontaminate").collect()}
    assert expected and expected <= set(found)
    assert all(found[pair] > 0.999 for pair in expected)
    assert {d for d, _ in found} == {d for d, _ in expected}


@pytest.mark.parametrize("name,modulus,remainder", [("op2_toxicity", 4, 2), ("op6_quality", 5, 0)])
def test_scores(spark, documents, name, modulus, remainder):
    found = answer(spark, name).collect()
    assert sorted((r["doc_id"], r["held_out"]) for r in found) == [
        (d, zlib.crc32(str(d).encode()) % modulus == remainder) for d, _ in documents
    ]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)


def test_executors_need_not_have_the_search_path(tmp_path):
    """Run from another folder, where only the driver knows where the package is."""
    root = os.path.dirname(os.path.abspath(contract.__file__))
    code = f"""
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as contract
from shopstrata.session import build_session
spark = build_session("elsewhere", "local[2]", spark__sql__shuffle__partitions="2")
print("ROWS", contract.queries()["op1_spotsigs"](spark, {SF_DIR!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 200" in done.stdout, done.stderr[-2000:]
