"""Sides of joins that grow with the data are not gathered in the driver, however small their files are."""

import os

import pytest

from shopstrata.operators import keyed
from shopstrata.plans.marts import ITEM_SALES, MARTS, item_sales
from shopstrata.sources.layers import PACKED
from shopstrata.sources.star_adapter import STAR_SCHEMAS, raw_tables
from shopstrata.sources.tables import TableSet

ROWS = 200_000
# Spark's default: what such a table holds in memory is far above, its file far below.
LIMIT = 10 * 2**20


def _final_plan(df):
    """The plan after it ran, with what Spark decided meanwhile."""
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    """Stored Silver, packed as a run does: an item and an order for every product."""
    folder = str(tmp_path_factory.mktemp("silver"))
    columns = {
        "products": ["concat('P-', id) AS product_id", "'name' AS product_name", "concat('c', id % 3) AS category",
                     "CAST(2 AS DECIMAL(18,2)) AS unit_price", "CAST(1 AS DECIMAL(18,2)) AS cost_price"],
        "orders": ["concat('O-', id) AS order_id", "concat('C-', id) AS customer_id", "DATE '2024-01-01' AS order_date",
                   "CAST(2 AS DECIMAL(18,2)) AS order_total", "'completed' AS status", "'web' AS channel"],
        "order_items": ["concat('I-', id) AS item_id", "concat('O-', id) AS order_id", "concat('P-', id) AS product_id",
                        "CAST(1 AS DECIMAL(18,4)) AS quantity", "CAST(2 AS DECIMAL(18,2)) AS unit_price",
                        "CAST(2 AS DECIMAL(18,2)) AS line_total"],
        "returns": ["concat('R-', id) AS return_id", "concat('O-', id) AS order_id", "'approved' AS status",
                    "CAST(1 AS DECIMAL(18,2)) AS refund_amount"],
        "customers": ["concat('C-', id) AS customer_id", "'f' AS first_name", "'l' AS last_name", "'s' AS segment", "'x' AS state"],
    }
    for table, rules in columns.items():
        spark.range(0, ROWS, 1, 2).selectExpr(*rules).write.options(**PACKED).parquet(f"{folder}/{table}")
    opened = TableSet({t: lambda t=t: spark.read.parquet(f"{folder}/{t}") for t in columns})
    item_sales(opened).write.options(**PACKED).parquet(f"{folder}/{ITEM_SALES}")
    for table in [*columns, ITEM_SALES]:
        assert sum(os.path.getsize(f"{folder}/{table}/{f}") for f in os.listdir(f"{folder}/{table}")) < LIMIT
    return opened, TableSet({t: lambda t=t: spark.read.parquet(f"{folder}/{t}") for t in [*columns, ITEM_SALES]})


@pytest.mark.parametrize("shared", [False, True])
@pytest.mark.parametrize(
    "name", ["gold_revenue_by_category", "gold_return_rate_by_product", "gold_customer_lifetime_value"]
)
def test_marts_of_packed_tables_broadcast_none(spark, silver, name, shared):
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) == LIMIT
    rows, plan = _final_plan(MARTS[name].build(silver[shared]))
    assert len(rows) == (3 if name == "gold_revenue_by_category" else ROWS)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_match_of_packed_tables_broadcasts_none(spark, silver, how):
    counted = silver[0]["returns"].groupBy("order_id").count()
    _, plan = _final_plan(keyed.match(silver[0]["order_items"], counted, "order_id", how).selectExpr("max(struct(*))"))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_raw_items_and_totals_broadcast_none(spark, tmp_path):
    columns = {
        "part": ["id AS p_partkey", "'n' AS p_name", "'t' AS p_type", "1 AS p_size", "2.0D AS p_retailprice"],
        "lineitem": ["id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber", "3.0D AS l_quantity",
                     "6.0D AS l_extendedprice", "'N' AS l_returnflag", "TIMESTAMP_NTZ '2024-01-01' AS l_shipdate"],
        "orders": ["id AS o_orderkey", "id AS o_custkey", "'F' AS o_orderstatus", "TIMESTAMP_NTZ '2024-01-01' AS o_orderdate",
                   "'1-URGENT' AS o_orderpriority"],
    }
    for table, rules in columns.items():
        spark.range(1000).selectExpr(*rules).to(spark.createDataFrame([], STAR_SCHEMAS[table]).schema).write.parquet(
            f"{tmp_path}/{table}.parquet"
        )
    raw = raw_tables(spark, str(tmp_path))
    rows, plan = _final_plan(raw["order_items"])
    assert len(rows) == 1000 and "SortMergeJoin" in plan and "Broadcast" not in plan
    rows, plan = _final_plan(raw["orders"])
    assert len(rows) == 1000 + 6 and "Broadcast" not in plan
