"""The six raw commerce tables, derived from a customer/part/orders/lineitem star schema.

Defects (duplicates, orphans, nulls, bad dates and prices, padding, mixed case) are injected by
modulo rules on the keys, so another engine can derive the same rows. Every column is text, as
if it had been read from CSV.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata.functions.parse import MONEY
from shopstrata.operators.keyed import unbroadcast
from shopstrata.plans.backfill import backfill_order_totals
from shopstrata.sources.schemas import RAW_COLUMNS, TABLES
from shopstrata.sources.tables import TableSet

# The domains of the raw tables.
RETURN_STATUSES = ["approved", "approved", "pending", "rejected"]
CARRIERS = ["UPS", "FedEx", "USPS", "DHL", "Amazon Logistics"]
SHIP_STATUSES = [
    "delivered", "delivered", "delivered", "in_transit", "out_for_delivery", "delayed", "lost",
]

# Labels of these test data.
PAYMENTS = ["card", "transfer", "wallet", "voucher", "cash"]
REASONS = ["reason A", "reason B", "reason C", "reason D", "reason E", "reason F", "reason G", "reason H"]
WAREHOUSES = ["north", "east", "south", "west", "centre"]

# The columns of the star schema that are used, so that no schema is inferred.
STAR_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz",
}

Star = Mapping[str, DataFrame]


def _pick(values: list[str], key: str) -> str:
    """``values[key % len(values)]``."""
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), CAST({key} % {len(values)} AS INT) + 1)"


def _id(prefix: str, *keys: str) -> str:
    return f"concat('{prefix}-', " + ", '-', ".join(f"CAST({k} AS STRING)" for k in keys) + ")"


def _shape(df: DataFrame, table: str, rules: dict[str, str], typed: bool = False) -> DataFrame:
    """The raw table with one rule per column, as text unless ``typed``."""
    columns = [c for c in RAW_COLUMNS[table] if c in rules]
    as_type = "({0}) AS {1}" if typed else "CAST({0} AS STRING) AS {1}"
    return df.selectExpr(*[as_type.format(rules[c], c) for c in columns])


def _customers(star: Star) -> DataFrame:
    first = "concat('First', CAST(c_custkey % 97 AS STRING))"
    email = "concat('user', CAST(if(c_custkey % 60 = 59, c_custkey - 1, c_custkey) AS STRING), '@example.com')"
    return _shape(
        star["customer"],
        "customers",
        {
            "customer_id": _id("CUST", "c_custkey"),
            "first_name": f"if(c_custkey % 11 = 0, concat(' \\t', {first}, '  '), {first})",
            "last_name": "concat('Last', CAST(c_custkey % 89 AS STRING))",
            "email": f"""CASE WHEN c_custkey % 97 = 0 THEN NULL
                              WHEN c_custkey % 7 = 0 THEN upper({email}) ELSE {email} END""",
            "phone": "c_name",
            "city": "concat('NATION_', CAST(c_nationkey AS STRING))",
            "state": "concat('S', CAST(c_nationkey AS STRING))",
            "zip_code": "lpad(CAST(c_custkey % 100000 AS STRING), 5, '0')",
            "segment": "CASE WHEN c_custkey % 29 <> 0 THEN c_mktsegment END",
            "created_at": """CASE WHEN c_custkey % 211 = 0 THEN 'not-a-date' ELSE CAST(
                date_add(DATE '1994-01-01', CAST(c_custkey % 365 AS INT)) AS STRING) END""",
        },
    )


def _products(star: Star) -> DataFrame:
    price = f"CAST(p_retailprice AS {MONEY})"
    return _shape(
        star["part"],
        "products",
        {
            "product_id": _id("PROD", "p_partkey"),
            "product_name": "if(p_partkey % 13 = 0, concat('  ', p_name, ' '), p_name)",
            "category": "p_type",
            "unit_price": f"if(p_partkey % 251 = 0, 'abc', CAST({price} AS STRING))",
            "cost_price": f"""CAST(if(p_partkey % 97 = 0, {price} + 1,
                                      {price} - 400 - p_partkey % 100) AS {MONEY})""",
            "stock_qty": "CASE WHEN p_partkey % 17 <> 0 THEN p_size END",
            "is_active": """CASE WHEN p_partkey % 19 = 0 THEN NULL
                                 WHEN p_partkey % 4 = 0 THEN 'False' ELSE 'True' END""",
        },
    )


# Some quantities have a fraction.
HALVED = "(l_orderkey + l_linenumber) % 23 = 0"
UNITS = f"CAST(if({HALVED}, l_quantity - 0.5D, l_quantity) AS DECIMAL(10,1))"


def _items(star: Star, typed: bool) -> DataFrame:
    # What depends on the part alone is computed per part, not per line.
    parts = star["part"].selectExpr(
        "p_partkey AS l_partkey",
        f"{_id('PROD', 'p_partkey')} AS product_id",
        f"CAST(p_retailprice AS {MONEY}) AS price",
        f"CAST(CAST(p_retailprice AS {MONEY}) AS STRING) AS price_text",
    )
    return _shape(
        star["lineitem"].join(unbroadcast(parts), "l_partkey"),
        "order_items",
        {
            "item_id": _id("ITEM", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
            "order_id": f"""CASE
                WHEN (l_orderkey * 3 + l_suppkey) % 997 = 0 THEN NULL
                WHEN (l_orderkey + l_partkey) % 499 = 0 THEN {_id("ORD-GHOST", "l_partkey % 4")}
                ELSE {_id("ORD", "l_orderkey")} END""",
            "product_id": "product_id",
            "quantity": f"if({HALVED}, CAST({UNITS} AS STRING), CAST(CAST(l_quantity AS INT) AS STRING))",
            "unit_price": "price" if typed else "price_text",
            "line_total": f"CAST({UNITS} * price AS {MONEY})",
        },
        typed,
    )


def _order_items(star: Star) -> DataFrame:
    return _items(star, typed=False)


def _orders(star: Star, items: DataFrame | None = None) -> DataFrame:
    """``items``: the raw order items, where they are stored already; else only their totals are derived."""
    status = """CASE WHEN o_orderstatus = 'F' THEN 'completed'
                     WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN 'shipped'
                     WHEN o_orderstatus = 'O' THEN 'processing'
                     WHEN o_orderkey % 2 = 0 THEN 'completed' ELSE 'cancelled' END"""
    # The second copies are made here, in the same scan and before the totals are joined.
    copies = star["orders"].selectExpr(
        "*", "explode(sequence(0, CAST(o_orderkey % 167 = 0 AS INT))) AS _copy"
    )
    # The other columns are rendered as text behind the join, so that it shuffles narrow rows.
    headers = copies.withColumn("order_id", F.expr(_id("ORD", "o_orderkey"))).drop("_copy")
    totals = backfill_order_totals(headers, _items(star, typed=True) if items is None else items)
    return _shape(
        totals,
        "orders",
        {
            "order_id": "order_id",
            "customer_id": f"CASE WHEN o_orderkey % 101 <> 0 THEN {_id('CUST', 'o_custkey')} END",
            "order_date": """if(o_orderkey % 307 = 0, 'bad-date',
                                CAST(CAST(o_orderdate AS DATE) AS STRING))""",
            "status": f"if(o_orderkey % 9 = 0, concat(' ', upper({status}), '  '), {status})",
            "channel": """CASE WHEN left(o_orderpriority, 1) IN ('1', '2') THEN 'web'
                               WHEN left(o_orderpriority, 1) = '3' THEN 'mobile'
                               WHEN left(o_orderpriority, 1) = '4' THEN 'in-store'
                               ELSE 'referral' END""",
            "payment_method": _pick(PAYMENTS, "o_custkey"),
            "discount_pct": "CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey % 4 * 5 END",
            "order_total": "order_total",
        },
    )


def _returns(star: Star) -> DataFrame:
    return _shape(
        star["lineitem"].where("l_returnflag = 'R'"),
        "returns",
        {
            "return_id": _id("RET", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
            "order_id": f"""if(l_partkey % 53 = 0, {_id("ORD-MISSING", "l_partkey % 5")},
                               {_id("ORD", "l_orderkey")})""",
            "return_date": "date_add(CAST(l_shipdate AS DATE), CAST(3 + l_partkey % 28 AS INT))",
            "reason": _pick(REASONS, "l_suppkey"),
            "status": _pick(RETURN_STATUSES, "l_suppkey"),
            "refund_amount": f"""CASE WHEN l_partkey % 41 <> 0
                                      THEN CAST(l_extendedprice AS {MONEY}) END""",
        },
    )


def _shipping_events(star: Star) -> DataFrame:
    shipped = "CAST(l_shipdate AS DATE)"
    shipment = _id("SHIP", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return _shape(
        star["lineitem"].where("l_linenumber = 1 OR (l_linenumber = 2 AND l_orderkey % 4 = 0)"),
        "shipping_events",
        {
            "shipment_id": shipment,
            "order_id": _id("ORD", "l_orderkey"),
            "carrier": _pick(CARRIERS, "l_suppkey"),
            "warehouse": _pick(WAREHOUSES, "l_partkey"),
            "ship_date": shipped,
            "estimated_delivery": f"date_add({shipped}, CAST(3 + l_partkey % 5 AS INT))",
            "actual_delivery": f"""CASE WHEN l_partkey % 10 = 0 THEN NULL
                WHEN l_partkey % 37 = 5 THEN date_sub({shipped}, 5)
                ELSE date_add({shipped}, CAST(1 + l_orderkey % 10 AS INT)) END""",
            "status": _pick(SHIP_STATUSES, "l_orderkey"),
            "tracking_number": shipment,
        },
    )


BUILDERS = {
    "customers": _customers,
    "products": _products,
    "orders": _orders,
    "order_items": _order_items,
    "returns": _returns,
    "shipping_events": _shipping_events,
}


def raw_tables(spark: SparkSession, star_dir: str, items: Callable[[], DataFrame] | None = None) -> TableSet:
    """The raw commerce tables from the star schema in ``star_dir``; files are opened once.

    ``items`` opens order items that are stored already, from which the order totals then come.
    """
    star = TableSet(
        {
            name: partial(spark.read.schema(schema).parquet, f"{star_dir}/{name}.parquet")
            for name, schema in STAR_SCHEMAS.items()
        }
    )
    openers = {table: partial(BUILDERS[table], star) for table in TABLES}
    if items:
        openers["orders"] = lambda: _orders(star, items())
    return TableSet(openers)
