"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame, each a thin use of an operator."""

from __future__ import annotations

from shopstrata.llm.common import stored, table, with_code
from shopstrata.llm.decontaminate import clean_documents
from shopstrata.llm.mixture import mixed_documents
from shopstrata.llm.reshard import sharded_documents
from shopstrata.llm.simhash import one_of_each
from shopstrata.llm.toxicity import without_toxic


def toxicity(spark, docs, sf_dir):
    """Documents that are predicted to be toxic go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near duplicates stays."""
    return one_of_each(docs, shingle=3, distance=2)


def decontaminate(spark, docs, sf_dir):
    """Documents that hold a test item, exact or edited, go."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark, docs, sf_dir):
    """Documents are repeated, left out, or cut at the border of a block, as the mixture takes them."""
    return mixed_documents(docs)


def sharding(spark, docs, sf_dir):
    """Every document gets its shard and its slot there."""
    return sharded_documents(docs, shards=40)


STAGES = [
    ("toxicity", with_code(toxicity)),
    ("near_dedup", with_code(near_dedup)),
    ("decontaminate", with_code(decontaminate)),
    ("mixing", with_code(mixing)),
    ("sharding", with_code(sharding)),
]


def run_stages(spark, sf_dir, stages):
    """``documents`` through all stages; each result is written and read as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in stages:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
