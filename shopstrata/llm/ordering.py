"""Documents in ascending order of their ids, cut into blocks that tasks can hold."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstrata.llm.common import shuffle_partitions

BLOCKS_PER_PARTITION = 4
MOST_BLOCKS = 50_000
LEAST_LONG = -(2**63)


def block_bounds(df: DataFrame, key: str) -> list[float]:
    """Bounds of blocks: approximate quantiles of the long column ``key``, a few per shuffle partition."""
    blocks = min(MOST_BLOCKS, BLOCKS_PER_PARTITION * shuffle_partitions(df.sparkSession))
    place = F.coalesce(F.col(key), F.lit(LEAST_LONG)).cast("double").alias("place")
    found = df.select(place).approxQuantile("place", [i / blocks for i in range(1, blocks)], 1 / (4 * blocks))
    return [float("-inf"), *sorted(set(found) or {0.0}), float("inf")]


def with_block(df: DataFrame, key: str, bounds: list[float]) -> DataFrame:
    """``df`` with ``_block``: consecutive ranges of ``key``, nulls in the first.

    Rows with equal keys share a block, and a key is never in a lower block than a smaller one.
    """
    place = F.coalesce(F.col(key), F.lit(LEAST_LONG)).cast("double")
    cut = Bucketizer(splits=bounds, inputCol="_place", outputCol="_block")
    placed = cut.transform(df.withColumn("_place", place)).drop("_place")
    return placed.withColumn("_block", F.col("_block").cast("int"))
