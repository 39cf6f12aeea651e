"""The registered queries of this subpackage: thin forms of its operators over the test tables."""

from __future__ import annotations

import public_tokenizers

from shopstrata.llm.common import table, with_code
from shopstrata.llm.decontaminate import contaminated
from shopstrata.llm.merkle import merkle_manifest
from shopstrata.llm.mixture import mix
from shopstrata.llm.ppm import language_scores
from shopstrata.llm.prefix_trie import conversation_trie
from shopstrata.llm.quality_qda import quality_scores
from shopstrata.llm.reshard import shard_documents
from shopstrata.llm.simhash import simhash_components
from shopstrata.llm.spotsigs import duplicate_classes, edited_and_next, near_duplicates
from shopstrata.llm.sql import SQL
from shopstrata.llm.suffix_dedup import repeated_bytes
from shopstrata.llm.token_records import recorded_documents
from shopstrata.llm.toxicity import toxicity_scores
from shopstrata.llm.warc import archived_pages


def op1_spotsigs(spark, sf_dir):
    return edited_and_next(table(spark, sf_dir, "documents"))


def op2_toxicity(spark, sf_dir):
    scores = toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.drop("_id", "_hash")


def op3_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source"
    )


def op4_warc(spark, sf_dir):
    return archived_pages(table(spark, sf_dir, "pages"), min_bytes=0).drop("chunks")


def op5_token_records(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return recorded_documents(table(spark, sf_dir, "documents"), path, end_id=0)


def op6_quality(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_sharding(spark, sf_dir):
    return shard_documents(table(spark, sf_dir, "documents"), shards=40)


def op8_suffix_dedup(spark, sf_dir):
    return repeated_bytes(table(spark, sf_dir, "documents"), length=100).drop("removed")


def op9_simhash_near_dedup(spark, sf_dir):
    return simhash_components(table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op10_decontaminate(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_ppm(spark, sf_dir):
    return language_scores(table(spark, sf_dir, "documents"))


def op12_merkle(spark, sf_dir):
    return merkle_manifest(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark, sf_dir):
    return conversation_trie(table(spark, sf_dir, "conversations"))


def spotsigs_classes(spark, sf_dir):
    """The other half of op1: its columns are those of its SQL, so classes are a query of their own."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def spotsigs_members(spark, sf_dir):
    """The classes alone, for which not every pair of a class is compared."""
    return duplicate_classes(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_spotsigs": op1_spotsigs,
    "op2_toxicity": op2_toxicity,
    "op3_mixing": op3_mixing,
    "op4_warc": op4_warc,
    "op5_token_records": op5_token_records,
    "op6_quality": op6_quality,
    "op7_sharding": op7_sharding,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_ppm": op11_ppm,
    "op12_merkle": op12_merkle,
    "op13_prefix_trie": op13_prefix_trie,
    "spotsigs_classes": spotsigs_classes,
    "spotsigs_members": spotsigs_members,
}

QUERIES = {name: with_code(query) for name, query in QUERIES.items()}

__all__ = ["QUERIES", "SQL"]
