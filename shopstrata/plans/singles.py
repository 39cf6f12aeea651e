"""Single operators over Silver, for use outside the marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstrata.functions.parse import day, flag, money, number, whole
from shopstrata.functions.rounding import percent
from shopstrata.functions.text import cell, label, strip
from shopstrata.operators.keyed import match, with_match
from shopstrata.plans.marts import earning_orders, returns_per_order, value_tier

Tables = Mapping[str, DataFrame]


def earning_order_ids(t: Tables) -> DataFrame:
    """Orders with a status from a list."""
    return earning_orders(t["orders"]).select("order_id", "status")


def items_with_products(t: Tables) -> DataFrame:
    """Items with the name, category and cost of their product.

    Both sides come straight out of a scan, so Spark picks the join by size (a broadcast only
    below its own threshold) and splits a hot product by itself.
    """
    items = t["order_items"].select("item_id", "product_id", "quantity", "line_total")
    products = t["products"].select("product_id", "product_name", "category", "cost_price")
    return items.join(products, "product_id")


def approved_orders(t: Tables) -> DataFrame:
    """Distinct ids of orders with an approved return."""
    return t["returns"].where(F.col("status") == "approved").select("order_id").distinct()


def items_of_approved_orders(t: Tables) -> DataFrame:
    """Items whose order has an approved return, each item once."""
    items = t["order_items"].select("item_id", "order_id", "product_id", "line_total")
    approved = t["returns"].where(F.col("status") == "approved")
    return with_match(items, approved, "order_id").select(*items.columns)


def returns_with_orders(t: Tables) -> DataFrame:
    """Orders joined to their returns.

    Both sides are reduced to one row per order (and customer) first, with ``order_copies``
    telling how often the order occurs: repeats on both sides would otherwise multiply.
    """
    returned = returns_per_order(t["returns"]).select("order_id", "return_rows", "refunded")
    orders = (
        t["orders"]
        .where(F.col("order_id").isNotNull())
        .groupBy("order_id", "customer_id")
        .agg(F.count(F.lit(1)).alias("order_copies"))
    )
    return match(orders, returned, "order_id", "inner")


def return_rows_with_orders(t: Tables) -> DataFrame:
    """Every return with the customer and date of its order; a repeated order repeats its returns.

    Both sides come straight out of a scan, so Spark splits a hot order by itself.
    """
    returns = t["returns"].select("return_id", "order_id", "status", "refund_amount")
    orders = t["orders"].select("order_id", "customer_id", "order_date")
    return returns.join(orders, "order_id")


def customers_per_channel(t: Tables) -> DataFrame:
    """Exact distinct customers per channel, next to the orders."""
    return (
        t["orders"]
        .groupBy("channel")
        .agg(
            F.count_distinct("customer_id").alias("unique_customers"),
            F.count("order_id").alias("orders"),
        )
    )


def status_counts_per_channel(t: Tables) -> DataFrame:
    """Conditional counts; a NULL status counts nowhere."""
    statuses = ["completed", "shipped", "processing", "cancelled"]
    return (
        t["orders"]
        .groupBy("channel")
        .agg(*[F.count_if(F.col("status") == s).alias(f"{s}_orders") for s in statuses])
    )


def rates_per_warehouse(t: Tables) -> DataFrame:
    """Null-safe ratios of aggregates; a warehouse without deliveries has no loss rate."""
    counts = (
        t["shipping_events"]
        .groupBy("warehouse")
        .agg(
            F.count("shipment_id").alias("shipments"),
            F.count_if(F.col("status") == "delivered").alias("delivered"),
            F.count_if(F.col("status") == "lost").alias("lost"),
        )
    )
    return counts.selectExpr(
        "warehouse",
        f"{percent('delivered', 'shipments')} AS delivered_pct",
        f"{percent('lost', 'delivered')} AS lost_per_delivered_pct",
    )


def customer_tiers(t: Tables, high: float, mid: float) -> DataFrame:
    """Customers with at least one paid order, and their tier."""
    spent = (
        t["orders"]
        .where(F.col("customer_id").isNotNull() & F.col("order_total").isNotNull())
        .groupBy("customer_id")
        .agg(F.sum("order_total").alias("spent"))
    )
    return spent.selectExpr("customer_id", f"{value_tier('spent', high, mid)} AS value_tier")


def cleaned_labels(raw_orders: DataFrame) -> DataFrame:
    """Raw order labels, stripped and in lower case."""
    return raw_orders.selectExpr(
        "order_id", f"{label('status')} AS status", f"{label('channel')} AS channel"
    )


def cleaned_names(raw_customers: DataFrame) -> DataFrame:
    """Raw customer names without outer whitespace, and the normalised email."""
    return raw_customers.selectExpr(
        "customer_id", f"{strip(cell('first_name'))} AS first_name", f"{label('email')} AS email"
    )


def parsed_numbers(raw_products: DataFrame) -> DataFrame:
    """Raw product numbers and flags as typed values; bad text is NULL."""
    return raw_products.selectExpr(
        "product_id",
        f"{money('unit_price')} AS unit_price",
        f"{money('cost_price')} AS cost_price",
        f"{whole('stock_qty')} AS stock_qty",
        f"{flag('is_active')} AS is_active",
    )


def parsed_dates(raw_orders: DataFrame) -> DataFrame:
    """Raw order dates and discounts as typed values; bad text is NULL."""
    return raw_orders.selectExpr(
        "order_id",
        f"{day('order_date')} AS order_date",
        f"{number('discount_pct')} AS discount_pct",
    )


def date_parts(t: Tables) -> DataFrame:
    """Month start, month label and whole days between two dates."""
    return t["shipping_events"].selectExpr(
        "shipment_id",
        "trunc(ship_date, 'MM') AS ship_month",
        "date_format(ship_date, 'yyyy-MM') AS month_label",
        "datediff(actual_delivery, ship_date) AS days_to_deliver",
    )
