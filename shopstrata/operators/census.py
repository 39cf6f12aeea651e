"""Count how often each key occurs in several tables, in one grouped pass."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_census(tables: Mapping[str, DataFrame], key: str) -> DataFrame:
    """One row per key value (NULL included) with one count column per table.

    The tables are stacked and counted with partial aggregation, so only distinct keys are
    shuffled and no key is ever gathered. It answers questions about missing partners
    (``orders = 0``) and repeats (``orders > 1``) for all tables together, in place of one
    join per question.
    """
    stacked = [
        df.select(key, *[F.lit(int(name == other)).cast("long").alias(other) for other in tables])
        for name, df in tables.items()
    ]
    return (
        reduce(DataFrame.unionAll, stacked)
        .groupBy(key)
        .agg(*[F.sum(name).alias(name) for name in tables])
    )
