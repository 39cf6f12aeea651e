"""Raw columns per table. Every raw field is text, so Bronze keeps cells exactly as received
(an inferred schema would turn the zip code 01352 into 1352)."""

from __future__ import annotations

from pyspark.sql import types as T

# Table and column names of the raw files, in file order.
RAW_COLUMNS = {
    "customers": [
        "customer_id", "first_name", "last_name", "email", "phone",
        "city", "state", "zip_code", "segment", "created_at",
    ],
    "products": [
        "product_id", "product_name", "category", "unit_price",
        "cost_price", "stock_qty", "is_active",
    ],
    "orders": [
        "order_id", "customer_id", "order_date", "status",
        "channel", "payment_method", "discount_pct", "order_total",
    ],
    "order_items": [
        "item_id", "order_id", "product_id", "quantity", "unit_price", "line_total",
    ],
    "returns": [
        "return_id", "order_id", "return_date", "reason", "status", "refund_amount",
    ],
    "shipping_events": [
        "shipment_id", "order_id", "carrier", "warehouse", "ship_date",
        "estimated_delivery", "actual_delivery", "status", "tracking_number",
    ],
}

TABLES = list(RAW_COLUMNS)


def raw_schema(table: str) -> T.StructType:
    """The all-text schema of a raw table."""
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[table]])
