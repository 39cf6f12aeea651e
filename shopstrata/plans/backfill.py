"""Order totals from line items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstrata.functions.parse import MONEY, money
from shopstrata.operators.keyed import match


def backfill_order_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Add ``order_total``, the sum of the order's line totals, or NULL where it has no items.

    ``items`` is aggregated before the join, so a popular order id is one row by then.
    """
    totals = (
        items.where("order_id IS NOT NULL")
        .groupBy("order_id")
        .agg(F.expr(f"CAST(sum({money('line_total')}) AS {MONEY}) AS order_total"))
    )
    return match(orders, totals, "order_id", "left")
