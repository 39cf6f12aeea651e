"""Ordered concatenation of groups of any size, as parts of bounded length.

One cell per group cannot hold a group of a third of all rows, nor can one task sort it. Here rows are
range-partitioned by (key, value), so that a large group is a run of several partitions, which are written to the shared
folder once. Each run knows its rows and its characters; sums of these over the runs before, of which a group has no
more than there are partitions, turn places within a run into places within the group. Parts are cut by those
places, so neither the number of partitions nor the bounds that Spark samples show in the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstrata.sources.layers import shared_folder


def _runs(df: DataFrame, key: str, value: str) -> DataFrame:
    """(_group, key, value, _run) as written: ``_run`` is the range partition of a row."""
    spark = df.sparkSession
    rows = df.where(F.col(value).isNotNull()).select(
        # Never null, so that a missing key is one like any other and joins itself.
        F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("-")).alias("_group"),
        F.col(key).alias("_key"), F.col(value).cast("string").alias("_value"),
        # Cuts runs of equal values, whose order does not matter.
        F.monotonically_increasing_id().alias("_row"),
    )
    path = shared_folder(spark)
    placed = rows.repartitionByRange("_group", "_value", "_row").withColumn("_run", F.spark_partition_id())
    placed.drop("_row").write.parquet(path)
    return spark.read.schema(placed.drop("_row").schema).parquet(path)


def concatenated_parts(df: DataFrame, key: str, value: str, separator: str, rows: int) -> DataFrame:
    """(key, occurrences, part, first, offset, text): the values of each key in order, ``rows`` of them per part.

    ``part`` counts from 0, ``first`` is the place of its first value and ``offset`` the characters before it, so that the
    parts of a key, put behind each other with ``separator`` between them, are its whole text, and each can be written
    to its place without the others. ``occurrences`` is the number of values. Missing keys are one group; missing values
    are left out, and a key without any other value has no part. Repeated rows are repeated in the text; an
    empty table gives an empty result. The rows are written once to the shared folder when the plan is built.
    """
    if rows < 1:
        raise ValueError("a part holds one value or more")
    runs = _runs(df, key, value)
    length = F.length("_value") + len(separator)
    sizes = runs.groupBy("_group", "_run").agg(F.count(F.lit(1)).alias("n"), F.sum(length).alias("chars"))
    # A row per run and key: at most one row per partition for a key, however large it is.
    ahead = Window.partitionBy("_group").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        "_group", "_run",
        F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("chars").over(ahead), F.lit(0)).alias("_chars_before"),
        F.sum("n").over(Window.partitionBy("_group")).alias("occurrences"),
    )
    own = Window.partitionBy("_group", "_run").orderBy("_value")
    placed = (
        runs.withColumn("_at", F.row_number().over(own))
        .withColumn("_end", F.sum(length).over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .join(before, ["_group", "_run"])
        .withColumn("_place", F.col("_rows_before") + F.col("_at") - 1)
        .withColumn("_start", F.col("_chars_before") + F.col("_end") - length)
    )
    # ``rows`` values at most meet in one cell.
    return (
        placed.groupBy("_group", F.floor(F.col("_place") / rows).alias("part"))
        .agg(
            F.first("_key").alias(key), F.first("occurrences").alias("occurrences"),
            F.min("_place").alias("first"), F.min("_start").alias("offset"),
            F.sort_array(F.collect_list(F.struct("_place", "_value"))).alias("_values"),
        )
        .select(key, "occurrences", "part", "first", "offset", F.array_join("_values._value", separator).alias("text"))
    )
