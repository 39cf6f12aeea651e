"""Token records: ids as the tokenizers library gives them, exact round trip, damage is noticed."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shopstrata.llm import token_records as records

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, start string, path string"


def texts():
    rng = random.Random(9)
    parts = ["a", "the", "Ünï", " ", "  ", "\n", "\t", "don't", "I'll", "'s", "12", "3.5%", "word", "ñ", "_x_", "!!", "\r\n",
             "²", "½", "中文", "<|endoftext|>", "\x1d", "\xa0", "é́", "é", "🙂", "ß"]
    found = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 30))) for _ in range(300)]
    found += [" ".join(rng.choice(parts) for _ in range(rng.randrange(0, 30))) for _ in range(300)]
    return [*found, "", " ", "  ", " a", "a ", "a  ", "a \n", "a\n b", "a \n b", "a\n \nb", "x" * 9999, "\n" * 50]


def test_ids_equal_those_of_the_library(monkeypatch):
    plain = Tokenizer.from_file(PATH)
    expected = [plain.encode(t, add_special_tokens=False).ids for t in texts()]
    for cache in (records.CACHE, 5):
        monkeypatch.setattr(records, "CACHE", cache)
        codec = records.Encoder(PATH)
        for _ in range(2):
            assert [np.frombuffer(b, "<u2").tolist() for b in codec.encode(texts())] == expected


def rows():
    ids = list(range(-5, 400)) + [7, 7]
    random.Random(3).shuffle(ids)
    words = texts()
    return [(i, words[i % len(words)], "s", "p") for i in ids] + [(None, None, "s", "p")]


def test_round_trip(spark):
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    plain = Tokenizer.from_file(PATH)
    expected, start = [], 0
    for i, text, *_ in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = records.recorded_documents(docs, PATH).collect()
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_index_and_damage(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i}", "", "") for i in range(20)], SCHEMA)
    for line in records.write_records(docs, PATH, folder=str(tmp_path)).collect():
        whole = list(records.open_records(line["path"]))
        assert len(whole) == line["records"] and whole[0][0] == line["first_id"]
        for number in reversed(range(len(whole))):
            doc_id, ids = records.read_record(line["path"], number)
            assert doc_id == whole[number][0] and ids.tolist() == whole[number][1].tolist()
        data = bytearray(open(line["path"], "rb").read())
        data[-6] ^= 1
        open(line["path"], "wb").write(data)
        with pytest.raises(ValueError, match="damaged"):
            list(records.open_records(line["path"]))


def test_empty(spark):
    assert records.recorded_documents(spark.createDataFrame([], SCHEMA), PATH).collect() == []
