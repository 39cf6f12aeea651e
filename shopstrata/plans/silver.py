"""Silver: one cleaner per table, DataFrame in and DataFrame out.

Every cleaner is a projection of built-in expressions. Columns whose names start with an
underscore (the ingest metadata) pass through. Row counts do not change, except that order
items without an order or a product are dropped; duplicate orders are flagged, never removed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame

from shopstrata.functions.parse import amount, day, flag, money, number, whole
from shopstrata.functions.text import cell, label, present, strip
from shopstrata.operators.keyed import flag_repeated
from shopstrata.operators.repeats import flag_stored
from shopstrata.sources.schemas import RAW_COLUMNS


def _project(df: DataFrame, table: str, rules: dict[str, str]) -> DataFrame:
    """Apply ``rules`` to the raw columns; the others only lose their missing-value tokens."""
    kept = [f"{rules.get(c, cell(c))} AS {c}" for c in RAW_COLUMNS[table]]
    return df.selectExpr(*kept, *[c for c in df.columns if c.startswith("_")])


def silver_customers(df: DataFrame, flagged: Callable[..., DataFrame] = flag_repeated) -> DataFrame:
    """Strip text, normalise the email, default the segment, and flag shared emails by ``flagged``."""
    text = ["first_name", "last_name", "city", "state", "zip_code"]
    rules = {c: strip(cell(c)) for c in text}
    rules["email"] = label("email")
    rules["segment"] = f"coalesce({strip(cell('segment'))}, 'Unknown')"
    rules["created_at"] = day("created_at")
    return flagged(_project(df, "customers", rules), "email", "_is_duplicate_email")


def silver_products(df: DataFrame) -> DataFrame:
    """Strip names, parse prices, and default stock to 0 and a missing active flag to true."""
    return _project(
        df,
        "products",
        {
            "product_name": strip(cell("product_name")),
            "category": strip(cell("category")),
            "unit_price": money("unit_price"),
            "cost_price": money("cost_price"),
            "stock_qty": f"coalesce({whole('stock_qty')}, 0)",
            "is_active": f"if({present('is_active')}, {flag('is_active')}, true)",
        },
    )


def silver_orders(df: DataFrame, flagged: Callable[..., DataFrame] = flag_repeated) -> DataFrame:
    """Parse date and amounts, normalise labels, and flag missing customers and, by ``flagged``, repeated ids."""
    cleaned = _project(
        df,
        "orders",
        {
            "order_date": day("order_date"),
            "discount_pct": f"coalesce({number('discount_pct')}, 0.0D)",
            "order_total": money("order_total"),
            "channel": label("channel"),
            "status": label("status"),
            "payment_method": label("payment_method"),
        },
    ).selectExpr("*", "customer_id IS NULL AS _missing_customer_id")
    return flagged(cleaned, "order_id", "_is_duplicate_order")


# Tested on the raw cells, so that the filter runs below the projection without repeating it.
LINKED_ITEM = f"{present('order_id')} AND {present('product_id')}"


def _parsed_items(df: DataFrame, links: dict[str, str]) -> DataFrame:
    rules = {
        "quantity": amount("quantity"),
        "unit_price": money("unit_price"),
        "line_total": money("line_total"),
    }
    return _project(df, "order_items", rules | links)


def silver_order_items(df: DataFrame) -> DataFrame:
    """Parse the numbers and drop items that name no order or no product."""
    return _parsed_items(
        df.where(LINKED_ITEM), {"order_id": "order_id", "product_id": "product_id"}
    )


def silver_order_items_rejects(df: DataFrame) -> DataFrame:
    """The items that :func:`silver_order_items` drops."""
    return _parsed_items(df.where(f"NOT ({LINKED_ITEM})"), {})


def silver_returns(df: DataFrame) -> DataFrame:
    """Parse the date, default the refund to 0, and normalise status and reason."""
    return _project(
        df,
        "returns",
        {
            "return_date": day("return_date"),
            "refund_amount": f"coalesce({money('refund_amount')}, {money('0')})",
            "status": label("status"),
            "reason": strip(cell("reason")),
        },
    )


def silver_shipping_events(df: DataFrame) -> DataFrame:
    """Parse the dates, normalise carrier and status, and flag delivery before shipping.

    The flag is never NULL: a shipment with a missing date counts as valid.
    """
    return _project(
        df,
        "shipping_events",
        {
            "ship_date": day("ship_date"),
            "estimated_delivery": day("estimated_delivery"),
            "actual_delivery": day("actual_delivery"),
            "carrier": strip(cell("carrier")),
            "status": label("status"),
        },
    ).selectExpr("*", "coalesce(ship_date > actual_delivery, false) AS _invalid_ship_date")


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": silver_customers,
    "products": silver_products,
    "orders": silver_orders,
    "order_items": silver_order_items,
    "returns": silver_returns,
    "shipping_events": silver_shipping_events,
}

# The same tables from stored Bronze for a write, which needs the flags of every row.
STORED_CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = CLEANERS | {
    "customers": partial(silver_customers, flagged=flag_stored),
    "orders": partial(silver_orders, flagged=flag_stored),
}
