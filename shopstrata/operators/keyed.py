"""Joins to a keyed side, and duplicate flags, that survive hot keys.

The right sides here are aggregates (one row per key). Such a side is partitioned by its key already,
so Spark would join it as it is, and its skew-join rule, which splits an oversized partition of the left
side, only fires where both sides come straight out of a shuffle for the join. ``match`` therefore joins on
the key and on a hash of it: the hash changes no match, but the aggregate (a row per key, small next to the
left side) is shuffled once more, and any partition above
``spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes`` is split by its map outputs, whichever keys or
missing keys it holds. There is one plan for every size, nothing is measured while it is built, and a join
whose columns nobody reads still vanishes.

Sides that grow with the data are never broadcast (:func:`unbroadcast`). A broadcast is gathered in the driver, and Spark
decides on it by the size of files, of which packed ones hold a hundred times as much in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unbroadcast(df: DataFrame) -> DataFrame:
    """``df``, whose next join is a sort-merge join whatever size is estimated for it or the other side."""
    return df.hint("merge")


def match(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Join ``left`` to ``right`` on the column ``key``; ``how`` is left, inner, left_semi or left_anti.

    ``right`` holds at most one row per key (for semi and anti joins its copies do not matter, but
    callers pass distinct keys so that a hot key on that side has collapsed already).
    """
    # The hash is a join key of its own without being a column, so it is not shuffled with the rows.
    other = right.withColumnRenamed(key, "_match_key")
    same = (F.col(key) == F.col("_match_key")) & (F.hash(key) == F.hash("_match_key"))
    joined = left.join(unbroadcast(other), same, how).drop("_match_key")
    return joined.select(key, *[c for c in joined.columns if c != key])


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """The non-null values of ``key``, once each; copies collapse before the shuffle."""
    return df.where(F.col(key).isNotNull()).select(key).distinct()


def without_match(left: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``other``; a NULL key never occurs."""
    return match(left, distinct_keys(other, key), key, "left_anti")


def with_match(left: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``other``."""
    return match(left, distinct_keys(other, key), key, "left_semi")


def flag_repeated(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Add ``flag``: whether the row's key occurs more than once. NULL keys equal each other.

    A window over the key would pull each group into one task. Here the keys are counted with
    partial aggregation and only the repeated ones are joined back. NULL joins nothing, so keys
    are marked as present or missing first, which makes NULL a key like any other.
    """
    marked = df.selectExpr("*", f"coalesce(concat('=', {key}), '-') AS _group")
    repeated = (
        marked.groupBy("_group")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .selectExpr("_group", "true AS _repeated")
    )
    return match(marked, repeated, "_group", "left").selectExpr(
        *df.columns, f"_repeated IS NOT NULL AS {flag}"
    )
