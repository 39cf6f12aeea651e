"""Gold: the five reporting marts.

Each builder takes the Silver tables (``{name: DataFrame}``) and returns an unsorted DataFrame;
``in_report_order`` sorts on read, because a stored table has no order. Money is decimal, so
sums do not depend on the order of addition, and averages and rates are rounded once, exactly.

Shape shared by the joins: whatever is one-to-many in the source data is aggregated to one row
per key first, and multiplicities are carried as numbers. Repeated orders therefore weigh their
items as often as they occur, and an order's returns are charged to each of its items, without
any many-to-many join being run.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from shopstrata.functions.rounding import average_money, cents, halves, percent, ratio_half_up, whole_sum
from shopstrata.operators.keyed import match, unbroadcast

Tables = Mapping[str, DataFrame]

REVENUE_STATUSES = ["completed", "shipped"]
HIGH_VALUE = 1000
MID_VALUE = 400


def _agg(groups: GroupedData, *aggregates: str) -> DataFrame:
    return groups.agg(*[F.expr(a) for a in aggregates])


def earning_orders(orders: DataFrame) -> DataFrame:
    """Orders whose items count as revenue."""
    return orders.where(F.col("status").isin(REVENUE_STATUSES))


def _once_per_key(orders: DataFrame, dedupe: bool) -> DataFrame:
    """Optionally keep one of the copies of each order id (rows without an id all stay)."""
    if not dedupe:
        return orders
    columns = [c for c in orders.columns if c != "order_id"]
    one = (
        orders.where("order_id IS NOT NULL")
        .groupBy("order_id")
        .agg(F.min(F.struct(*columns)).alias("row"))
        .select("order_id", "row.*")
    )
    return one.unionByName(orders.where("order_id IS NULL"))


def returns_per_order(returns: DataFrame) -> DataFrame:
    """One row per order id: number of returns, refunds, and whether one was approved."""
    return _agg(
        returns.where("order_id IS NOT NULL").groupBy("order_id"),
        "count(1) AS return_rows",
        "count(return_id) AS returns",
        "sum(refund_amount) AS refunded",
        "bool_or(status <=> 'approved') AS approved",
    )


_COSTED = "quantity IS NOT NULL AND line_total IS NOT NULL"
# What the marts of revenue and of returns sum over the items of a product: decimals with their digits, and others.
_ITEM_SUMS = {
    "units": ("quantity", 4),
    "revenue": ("line_total", 2),
    "prices": ("unit_price", 2),
    "costed_units": (f"CASE WHEN {_COSTED} THEN quantity END", 4),
    "costed_revenue": (f"CASE WHEN {_COSTED} THEN line_total END", 2),
}
_PRICED_ROWS = "count(unit_price) AS priced_rows"
_RETURN_SUMS = [
    "count_if(has_id) AS sold",
    "sum(CASE WHEN has_id THEN return_rows END) AS returned",
    "sum(refunded) AS refunded",
]

# The sums of both, for marts that are built together: a table that they read where there is one.
ITEM_SALES = "item_sales"
# The columns of orders that marts read.
ORDER_COLUMNS = ["order_id", "customer_id", "order_date", "order_total", "status", "channel"]


def item_sales(tables: Tables) -> DataFrame:
    """One row per product and multiplicity of its items' earning order (0: none), with sums for two marts.

    The items meet their orders and returns once; what these say of an order is one row before that.
    """
    earning = earning_orders(tables["orders"]).where("order_id IS NOT NULL")
    returns = tables["returns"].where("order_id IS NOT NULL")
    refund = dict(returns.dtypes).get("refund_amount", "decimal(18,2)")
    facts = _agg(
        earning.selectExpr(
            "order_id", "true AS earning", f"CAST(NULL AS {refund}) AS refund_amount", "CAST(NULL AS BOOLEAN) AS approved"
        )
        .unionAll(returns.selectExpr("order_id", "false AS earning", "refund_amount", "status <=> 'approved' AS approved"))
        .groupBy("order_id"),
        "count_if(earning) AS weight",
        "count_if(NOT earning) AS return_rows",
        "sum(refund_amount) AS refunded",
        "coalesce(bool_or(approved), false) AS approved",
    ).selectExpr(
        "order_id", "weight", "if(approved, return_rows, NULL) AS return_rows", "if(approved, refunded, NULL) AS refunded"
    )
    # Only whether an item has an id matters, so the id itself stays out of the shuffle.
    items = tables["order_items"].selectExpr(
        "order_id", "product_id", "quantity", "unit_price", "line_total", "item_id IS NOT NULL AS has_id"
    )
    met = match(items, facts, "order_id", "left").withColumn("weight", F.expr("coalesce(weight, 0L)"))
    # Nearly all items are costed, so what is summed and shuffled of them is the rest.
    sums = {name: value for name, value in _ITEM_SUMS.items() if not name.startswith("costed_")}
    sums["uncosted_units"] = ("CASE WHEN line_total IS NULL THEN quantity END", 4)
    sums["uncosted_revenue"] = ("CASE WHEN quantity IS NULL THEN line_total END", 2)
    summed = [half for name, (value, digits) in sums.items() for half in halves(value, name, digits)]
    costed_rows = f"count_if({_COSTED}) AS costed_rows"
    sales = _agg(met.groupBy("product_id", "weight"), *summed, _PRICED_ROWS, costed_rows, *_RETURN_SUMS)
    joined = sales.selectExpr("*", *[whole_sum(name, digits) for name, (_, digits) in sums.items()])
    costed = "CAST(CASE WHEN costed_rows > 0 THEN {0} - coalesce(uncosted_{0}, 0) END AS DECIMAL(28,{1})) AS costed_{0}"
    return joined.selectExpr(
        "product_id", "weight", "units", "revenue", "prices", "priced_rows",
        costed.format("units", 4), costed.format("revenue", 2), "sold", "returned", "refunded",
    )


def revenue_by_category(tables: Tables, dedupe_orders: bool = False) -> DataFrame:
    """Units, revenue and margin per product category over earning orders.

    A repeated order counts as often as it occurs, unless ``dedupe_orders`` is set. Items are
    reduced to one row per product and order multiplicity before products are joined.
    """
    sales = None if dedupe_orders else tables.get(ITEM_SALES)
    if sales is not None:
        per_product = sales.where("weight > 0")
    else:
        weights = _agg(
            earning_orders(_once_per_key(tables["orders"], dedupe_orders))
            .where("order_id IS NOT NULL")
            .groupBy("order_id"),
            "count(1) AS weight",
        )
        items = tables["order_items"].select(
            "order_id", "product_id", "quantity", "unit_price", "line_total"
        )
        per_product = _agg(
            match(items, weights, "order_id", "inner").groupBy("product_id", "weight"),
            *[f"sum({value}) AS {name}" for name, (value, _) in _ITEM_SUMS.items()],
            _PRICED_ROWS,
        )
    catalogue = _agg(
        tables["products"]
        .where("product_id IS NOT NULL")
        .groupBy("product_id", "category", "cost_price"),
        "count(1) AS copies",
    )
    times = "CAST(weight * copies AS DECIMAL(18,0))"
    profit = "(costed_revenue - cost_price * costed_units)"
    totals = _agg(
        per_product.join(unbroadcast(catalogue), "product_id").groupBy("category"),
        "count(DISTINCT product_id) AS unique_products",
        f"sum(CAST(units * {times} AS DECIMAL(28,4))) AS units",
        f"sum(CAST(revenue * {times} AS DECIMAL(28,2))) AS revenue",
        f"sum(CAST(prices * {times} AS DECIMAL(28,2))) AS prices",
        f"sum(CAST(priced_rows * {times} AS BIGINT)) AS priced_rows",
        # Quantities have four digits and costs two, so six digits are exact; rounded once, below.
        f"sum(CAST(CAST({profit} AS DECIMAL(28,6)) * {times} AS DECIMAL(28,6))) AS profit",
    )
    micros = "CAST(profit * 1000000 AS DECIMAL(34,0))"
    margin = ratio_half_up(f"{micros} * 100", f"{cents('revenue')} * 10000", 1)
    return totals.selectExpr(
        "category",
        "unique_products",
        "CAST(units AS DECIMAL(30,4)) AS total_units_sold",
        "CAST(revenue AS DECIMAL(30,2)) AS total_revenue",
        f"{average_money('prices', 'priced_rows')} AS avg_unit_price",
        "CAST(profit AS DECIMAL(30,2)) AS total_gross_profit",
        f"{margin} AS gross_margin_pct",
    )


def monthly_order_summary(tables: Tables, dedupe_orders: bool = False) -> DataFrame:
    """Orders, revenue and channel mix per month, over orders with a date and a total.

    Orders are grouped by the first day of the month, a plain integer underneath; the label is
    formatted once per month. Distinct customers are counted in a branch of their own: next to
    the other aggregates, Spark would shuffle all their buffers per month and customer, while
    here the wide part is reduced to one row per month and task, and the other moves two columns.
    """
    paid = (
        _once_per_key(tables["orders"], dedupe_orders)
        .where("order_date IS NOT NULL AND order_total IS NOT NULL")
        .withColumn("month", F.expr("trunc(order_date, 'MM')"))
    )
    buyers = _agg(
        paid.where("customer_id IS NOT NULL")
        .select("month", "customer_id")
        .distinct()
        .groupBy("month"),
        "count(1) AS buyers",
    )
    totals = _agg(
        paid.groupBy("month"),
        "count(order_id) AS total_orders",
        "sum(order_total) AS total_revenue",
        "count(1) AS paid_rows",
        "count_if(status = 'completed') AS completed_orders",
        "count_if(status = 'cancelled') AS cancelled_orders",
        "count_if(channel = 'web') AS web_orders",
        "count_if(channel = 'mobile') AS mobile_orders",
        "count_if(channel = 'in-store') AS instore_orders",
    ).join(buyers, "month", "left")
    return totals.selectExpr(
        "date_format(month, 'yyyy-MM') AS month_label",
        "total_orders",
        "coalesce(buyers, 0) AS unique_customers",
        "total_revenue",
        f"{average_money('total_revenue', 'paid_rows')} AS avg_order_value",
        "completed_orders",
        "cancelled_orders",
        f"{percent('cancelled_orders', 'total_orders')} AS cancellation_rate_pct",
        "web_orders",
        "mobile_orders",
        "instore_orders",
    )


def return_rate_by_product(tables: Tables) -> DataFrame:
    """Sales, returns and refunds per product that was ever sold.

    An order counts as returned once one of its returns is approved; then all its returns, of
    any status, are counted, and their refunds are charged in full to each item of the order.
    One pass over the items serves both the sales and the returns.
    """
    sales = tables.get(ITEM_SALES)
    if sales is not None:
        per_product = _agg(
            sales.groupBy("product_id"),
            "sum(sold) AS sold",
            "CAST(sum(units) AS DECIMAL(28,4)) AS units",
            "CAST(sum(revenue) AS DECIMAL(28,2)) AS revenue",
            "sum(returned) AS returned",
            "CAST(sum(refunded) AS DECIMAL(38,2)) AS refunded",
        )
    else:
        returned = returns_per_order(tables["returns"]).where("approved").drop("approved")
        # Only whether an item has an id matters, so the id itself stays out of the shuffle.
        items = tables["order_items"].selectExpr(
            "order_id", "product_id", "quantity", "line_total", "item_id IS NOT NULL AS has_id"
        )
        per_product = _agg(
            match(items, returned, "order_id", "left").groupBy("product_id"),
            "sum(quantity) AS units",
            "sum(line_total) AS revenue",
            *_RETURN_SUMS,
        )
    listed = tables["products"].where("product_id IS NOT NULL")
    variants = _agg(
        listed.groupBy("product_id", "product_name", "category", "unit_price"),
        "count(1) AS copies",
    )
    listings = _agg(listed.groupBy("product_id"), "count(1) AS listings")
    returned_times = "coalesce(returned * listings, 0)"
    return (
        per_product.join(unbroadcast(variants), "product_id")
        .join(unbroadcast(listings), "product_id")
        .selectExpr(
            "product_id",
            "product_name",
            "category",
            "unit_price",
            "sold * copies AS times_sold",
            "CAST(units * CAST(copies AS DECIMAL(18,0)) AS DECIMAL(30,4)) AS total_units_sold",
            "CAST(revenue * CAST(copies AS DECIMAL(18,0)) AS DECIMAL(30,2)) AS total_revenue",
            f"{returned_times} AS times_returned",
            "CAST(coalesce(refunded * CAST(listings AS DECIMAL(18,0)), 0) AS DECIMAL(30,2)) "
            "AS total_refunded",
            f"{percent(returned_times, 'sold * copies')} AS return_rate_pct",
        )
    )


def value_tier(spent: str, high: float = HIGH_VALUE, mid: float = MID_VALUE) -> str:
    """High, Mid or Low Value by total spend; no spend counts as zero."""
    return f"""CASE WHEN coalesce({spent}, 0) >= {high} THEN 'High Value'
                    WHEN coalesce({spent}, 0) >= {mid} THEN 'Mid Value' ELSE 'Low Value' END"""


def customer_lifetime_value(
    tables: Tables,
    high_value: float = HIGH_VALUE,
    mid_value: float = MID_VALUE,
    dedupe_orders: bool = False,
) -> DataFrame:
    """Spend, order dates, returns and value tier of every customer.

    Returns of any status count, also on orders without a total. Orders are read once: returns
    are attached per order, then one aggregation by customer covers both.
    """
    orders = (
        _once_per_key(tables["orders"], dedupe_orders)
        .where("customer_id IS NOT NULL")
        .select("order_id", "customer_id", "order_date", "order_total")
    )
    returned = returns_per_order(tables["returns"]).select("order_id", "returns", "refunded")
    per_customer = _agg(
        match(orders, returned, "order_id", "left").groupBy("customer_id"),
        "count_if(order_total IS NOT NULL AND order_id IS NOT NULL) AS orders",
        "count(order_total) AS paid_rows",
        "sum(order_total) AS spent",
        "min(CASE WHEN order_total IS NOT NULL THEN order_date END) AS first_order_date",
        "max(CASE WHEN order_total IS NOT NULL THEN order_date END) AS last_order_date",
        "sum(returns) AS returns",
        "sum(refunded) AS refunded",
    )
    customers = tables["customers"].select(
        "customer_id", "first_name", "last_name", "segment", "state"
    )
    zero = "CAST(0 AS DECIMAL(28,2))"
    return match(customers, per_customer, "customer_id", "left").selectExpr(
        "customer_id",
        "first_name",
        "last_name",
        "segment",
        "state",
        "coalesce(orders, 0) AS total_orders",
        f"coalesce(spent, {zero}) AS total_spent",
        f"coalesce({average_money('spent', 'paid_rows')}, {zero}) AS avg_order_value",
        "first_order_date",
        "last_order_date",
        "coalesce(returns, 0) AS total_returns",
        f"coalesce(refunded, {zero}) AS total_refunded",
        f"{value_tier('spent', high_value, mid_value)} AS value_tier",
    )


def fulfillment_summary(tables: Tables) -> DataFrame:
    """Delivery speed, punctuality and delays per carrier, over shipments with sane dates.

    The on-time rate covers shipments with both delivery dates, the delay rate all of them.
    """
    totals = _agg(
        tables["shipping_events"].where("NOT _invalid_ship_date").groupBy("carrier"),
        "count(shipment_id) AS total_shipments",
        "count_if(status = 'delivered') AS delivered",
        "count_if(status = 'delayed') AS delayed",
        "count_if(status = 'lost') AS lost",
        "sum(datediff(actual_delivery, ship_date)) AS days",
        "count(datediff(actual_delivery, ship_date)) AS timed",
        "count_if(actual_delivery <= estimated_delivery) AS punctual",
        "count(actual_delivery <= estimated_delivery) AS comparable",
    )
    return totals.selectExpr(
        "carrier",
        "total_shipments",
        "delivered",
        "delayed",
        "lost",
        f"{ratio_half_up('days', 'timed', 1)} AS avg_days_to_deliver",
        f"{percent('punctual', 'comparable')} AS on_time_rate_pct",
        f"{percent('delayed', 'total_shipments')} AS delay_rate_pct",
    )


@dataclass(frozen=True)
class Mart:
    """A mart: its builder, the order in which it is reported, and what proves its content.

    ``totals``: an exact sum of money and a sum of whole numbers or quantities, each of columns joined by +.
    """

    build: Callable[..., DataFrame]
    order: tuple[Callable[[], Column], ...]
    totals: tuple[str, str] | None = None


def _desc(column: str) -> Callable[[], Column]:
    return lambda: F.col(column).desc_nulls_first()


def _asc(column: str) -> Callable[[], Column]:
    return lambda: F.col(column).asc_nulls_last()


# The last sort column of each mart makes the order total and splits runs of equal values.
MARTS: dict[str, Mart] = {
    "gold_revenue_by_category": Mart(
        revenue_by_category, (_desc("total_revenue"), _asc("category")),
        ("total_revenue + total_gross_profit", "total_units_sold"),
    ),
    "gold_monthly_order_summary": Mart(
        monthly_order_summary, (_asc("month_label"),),
        ("total_revenue + avg_order_value", "total_orders + unique_customers"),),
    "gold_return_rate_by_product": Mart(
        return_rate_by_product,
        (
            lambda: F.col("return_rate_pct").desc_nulls_last(),
            _desc("total_revenue"),
            _asc("product_id"),
        ),
        ("total_revenue + total_refunded", "times_sold + times_returned"),
    ),
    "gold_customer_lifetime_value": Mart(
        customer_lifetime_value, (_desc("total_spent"), _asc("customer_id")),
        ("total_spent + total_refunded", "total_orders + total_returns"),
    ),
    "gold_fulfillment_summary": Mart(
        fulfillment_summary, (_asc("avg_days_to_deliver"), _asc("carrier")),
        ("avg_days_to_deliver + on_time_rate_pct", "total_shipments + delayed"),
    ),
}


def in_report_order(name: str, mart: DataFrame) -> DataFrame:
    """Sort a mart the way its report shows it."""
    return mart.orderBy(*[key() for key in MARTS[name].order])
