"""Labelled rows, the training part of them, and bounded samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstrata.llm.common import id_remainder


def held_out(modulus: int, remainder: int):
    """Whether a doc_id is kept out of training; a null id is not."""
    return F.coalesce(id_remainder(F.col("doc_id"), modulus) == remainder, F.lit(False))


def training_labels(labels: DataFrame, column: str, modulus: int, remainder: int, most: int) -> DataFrame:
    """(doc_id, label) of at most ``most`` rows that are not held out, by a hash of the id.

    Rows without an id or without a label of 0 or 1 are no examples; of labels that disagree about one id
    the larger one counts.
    """
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(modulus, remainder))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
