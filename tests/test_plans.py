"""Properties of the physical plans that keep the queries scalable."""

import re

import pytest

import __spark_entry__ as contract
from shopstrata.plans.marts import MARTS
from shopstrata.plans.quality import CHECKS
from shopstrata.plans.silver import CLEANERS
from shopstrata.sources.star_adapter import raw_tables
from shopstrata.sources.tables import TableSet

SF_DIR = "/root/testdata/sf0.001"
# These write files while being built, or hold nothing but counts.
BUILT_WITH_JOBS = {"pipeline_run", "gold_export", "bronze_metadata", "bronze_rejects", "dq_latest", "silver_metrics_written"}
LAZY = sorted(
    n
    for n in contract.queries()
    if n not in BUILT_WITH_JOBS and not re.match(r"bronze_scan|op\d+_|spotsigs_|pipeline$", n)
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join_no_single_task_window(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    assert "Python" not in text and "Pandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # A window only where its groups are cut to the first few rows before they are shuffled.
    assert len(re.findall(r"\bWindow \[", text)) <= len(re.findall(r"WindowGroupLimit .*Partial", text))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Silver as Parquet, as the pipeline stores it."""
    folder = tmp_path_factory.mktemp("silver")
    raw = raw_tables(spark, SF_DIR)
    for table, clean in CLEANERS.items():
        clean(raw[table]).write.parquet(f"{folder}/{table}")
    return TableSet({t: lambda t=t: spark.read.parquet(f"{folder}/{t}") for t in CLEANERS})


def scans(df):
    conf = df.sparkSession.conf
    conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        return re.findall(r"PushedFilters: (\[.*\]), ReadSchema: struct<(.*)>", plan(df))
    finally:
        conf.unset("spark.sql.maxMetadataStringLength")


def test_filters_and_columns_reach_the_scan(stored):
    read = MARTS["gold_fulfillment_summary"].build(stored)
    [(pushed, columns)] = scans(read)
    assert "EqualTo(_invalid_ship_date,false)" in pushed or "Not" in pushed
    assert "tracking_number" not in columns and "warehouse" not in columns
    assert any(
        "In(status, [completed,shipped])" in pushed and columns.count(":") == 2
        for pushed, columns in scans(MARTS["gold_revenue_by_category"].build(stored))
    )
    wide, narrow = scans(MARTS["gold_monthly_order_summary"].build(stored))
    assert "IsNotNull(order_total)" in wide[0] and "discount_pct" not in wide[1]
    assert "IsNotNull(customer_id)" in narrow[0] and narrow[1].count(":") == 3


def test_orphans_are_anti_joins(stored):
    for check in CHECKS:
        if check.check_id in ("DQ-003", "DQ-004", "DQ-006"):
            assert "LeftAnti" in plan(check.violations(stored))


def test_each_mart_reads_a_large_table_once(stored):
    for name, table in [
        ("gold_return_rate_by_product", "order_items"),
        ("gold_customer_lifetime_value", "orders"),
        ("gold_revenue_by_category", "order_items"),
    ]:
        assert len(re.findall(rf"FileScan parquet .*/{table}\]", plan(MARTS[name].build(stored)))) == 1


def test_no_broadcast_hint_on_tables(stored):
    """With automatic broadcasts off, nothing is broadcast: no plan insists on it."""
    spark = stored["orders"].sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for mart in MARTS.values():
            assert "Broadcast" not in plan(mart.build(stored))
        for check in CHECKS:
            assert "Broadcast" not in plan(check.violations(stored))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_distinct_customers_are_shuffled_narrow(stored):
    text = plan(MARTS["gold_monthly_order_summary"].build(stored))
    [pairs] = re.findall(r"Exchange hashpartitioning\(month#\d+, customer_id#\d+.*\n(.*)", text)
    assert "functions=[]" in pairs


def test_unused_flags_cost_no_join(stored, spark):
    """The join that flags repeated orders vanishes where the flag is not read."""
    orders = CLEANERS["orders"](raw_tables(spark, SF_DIR)["orders"])
    assert "Join" not in plan(orders.select("order_id", "status"))


def test_building_a_query_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    try:
        for name in LAZY:
            contract.queries()[name](spark, SF_DIR)
        assert not tracker.getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setJobGroup("", "")
