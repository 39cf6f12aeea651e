"""Row counts of layers and of the cleaners."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shopstrata.plans.silver import LINKED_ITEM


def row_counts(
    spark: SparkSession, layer: str, tables: Mapping[str, Callable[[], DataFrame]]
) -> DataFrame:
    """One row per table: layer, table, status and rows. An unreadable table is an ERROR row."""
    parts = []
    for name, open_table in tables.items():
        named = [F.lit(layer).alias("layer"), F.lit(name).alias("table")]
        try:
            counted = open_table().agg(F.count(F.lit(1)).alias("rows"))
            parts.append(counted.select(*named, F.lit("OK").alias("status"), "rows"))
        except (AnalysisException, KeyError):
            missing = F.lit(None).cast("long").alias("rows")
            parts.append(spark.range(1).select(*named, F.lit("ERROR").alias("status"), missing))
    return reduce(DataFrame.unionByName, parts)


def load_totals(counts: DataFrame) -> DataFrame:
    """Rows over all tables of a layer, and how many tables could be read."""
    return counts.groupBy("layer").agg(
        F.count_if(F.col("status") == "OK").alias("tables"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
    )


def _long_form(table: str, counts: DataFrame) -> DataFrame:
    return counts.unpivot([], counts.columns, "metric", "value").select(
        F.lit(table).alias("table"), "metric", "value"
    )


def _rows_in_repeated_groups(df: DataFrame, key: str, metric: str, *extra: Column) -> DataFrame:
    """Count rows and those whose key repeats without marking any row."""
    groups = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *extra)
    sums = [F.sum(c).alias(c) for c in groups.columns if c not in (key, "n")]
    return groups.agg(
        F.sum("n").alias("rows_in"),
        F.sum("n").alias("rows_out"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias(metric),
        *sums,
    )


def silver_metrics(
    raw: Mapping[str, DataFrame], silver: Mapping[str, DataFrame]
) -> DataFrame:
    """Rows in, rows out and flagged or dropped rows per cleaner, as (table, metric, value)."""
    rows = F.count(F.lit(1))
    both = [rows.alias("rows_in"), rows.alias("rows_out")]
    items = (
        raw["order_items"]
        .agg(rows.alias("rows_in"), F.expr(f"count_if(NOT ({LINKED_ITEM}))").alias("dropped_unlinked"))
        .withColumn("rows_out", F.col("rows_in") - F.col("dropped_unlinked"))
    )
    parts = [
        _long_form(
            "customers",
            _rows_in_repeated_groups(silver["customers"], "email", "duplicate_emails"),
        ),
        _long_form("products", silver["products"].agg(*both)),
        _long_form(
            "orders",
            _rows_in_repeated_groups(
                silver["orders"],
                "order_id",
                "duplicate_order_ids",
                F.count_if("_missing_customer_id").alias("missing_customer_id"),
            ),
        ),
        _long_form("order_items", items),
        _long_form("returns", silver["returns"].agg(*both)),
        _long_form(
            "shipping_events",
            silver["shipping_events"].agg(
                *both, F.count_if("_invalid_ship_date").alias("invalid_ship_dates")
            ),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


# What the write of a Silver table counts of its rows besides their number.
FLAGS = {
    "customers": {"duplicate_emails": "_is_duplicate_email"},
    "orders": {"duplicate_order_ids": "_is_duplicate_order", "missing_customer_id": "_missing_customer_id"},
    "shipping_events": {"invalid_ship_dates": "_invalid_ship_date"},
}


def write_metrics(table: str) -> dict[str, Column]:
    """Aggregates for the write of a cleaned table. All cleaners but that of the items keep every row."""
    found = {name: F.count_if(flag) for name, flag in FLAGS.get(table, {}).items()}
    return found if table == "order_items" else {"rows_in": F.count(F.lit(1)), **found}


def observed_input(table: str, raw: DataFrame) -> tuple[DataFrame, Observation | None]:
    """``raw`` on its way to the cleaner, with what only it can tell.

    Items are cleaned in the stage that writes them, so that no row is counted twice when a task is repeated.
    """
    if table != "order_items":
        return raw, None
    seen = Observation()
    unlinked = F.count_if(~F.expr(LINKED_ITEM)).alias("dropped_unlinked")
    return raw.observe(seen, F.count(F.lit(1)).alias("rows_in"), unlinked), seen
