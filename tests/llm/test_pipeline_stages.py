"""The corpus pipeline, stage by stage, against plain versions of each stage's decision."""

from collections import Counter

import pytest

import corpus_pipeline
from shopstrata.llm import mixture, toxicity
from shopstrata.llm.common import table

from .test_mixture import size
from .test_simhash import plain_components

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """(input, output) of each stage, written as Parquet in between."""
    folder = tmp_path_factory.mktemp("stages")
    docs = table(spark, SF_DIR, "documents")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        found[name] = (docs, after)
        docs = after
    return found


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_order_and_columns(spark, steps):
    assert list(steps) == ["toxicity", "near_dedup", "decontaminate", "mixing", "sharding"]
    columns = table(spark, SF_DIR, "documents").columns
    for name, (_, after) in steps.items():
        assert after.columns == columns + (["shard", "slot"] if name == "sharding" else [])
        assert after.count()


def test_toxic_documents_go(spark, steps):
    before, after = steps["toxicity"]
    scored = toxicity.toxicity_scores(before, table(spark, SF_DIR, "labels")).collect()
    assert set(texts(after)) == {r["doc_id"] for r in scored if not r["predicted"]}
    assert len(texts(after)) > 0.8 * before.count()


def test_one_of_each_group_stays(steps):
    before, after = steps["near_dedup"]
    groups = plain_components([(r["doc_id"], r["text"]) for r in before.collect()])
    assert sorted(texts(after)) == sorted({group for _, _, group in groups})


def test_leaks_go(spark, steps):
    before, after = steps["decontaminate"]
    items = [r["text"] for r in table(spark, SF_DIR, "benchmark").collect()]
    leaks = {d for d, t in texts(before).items() if any(i in t for i in items)}
    assert leaks and set(texts(after)) == set(texts(before)) - leaks


def test_mixture_takes_effect(steps):
    before, after = steps["mixing"]
    plan = {r["doc_id"]: r["taken"] for r in mixture.mix(before).collect()}
    words = Counter()
    for r in after.collect():
        words[r["doc_id"]] += size(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert words == Counter({d: t for d, t in plan.items() if t})


def test_shards_hold_every_row(steps):
    before, after = steps["sharding"]
    rows = after.collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in before.collect())
    for shard in range(40):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_run(spark, steps):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(str, found.collect())) == sorted(map(str, steps["sharding"][1].collect()))


def test_stages_take_odd_rows_and_empty_tables(spark):
    rows = [(None, None, None, None, None), (None, "x y z", "en", "a", 5), (None, "x y z", "en", "a", 5), (1, "", "en", None, 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, SF_DIR)
            assert after.count() <= 4
            if name != "sharding":
                docs = after
