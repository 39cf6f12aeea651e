"""Known counts of the adapter's tables and checks at sf0.01."""

from datetime import datetime

from shopstrata.plans.quality import quality_report
from shopstrata.plans.silver import CLEANERS
from shopstrata.sources.star_adapter import raw_tables
from shopstrata.sources.tables import TableSet

SF_DIR = "/root/testdata/sf0.01"
# Fixed values, counted independently (see FIXTURES.md).
ROWS = {
    "customers": 1500, "products": 2000, "orders": 15090, "order_items": 60000,
    "returns": 20046, "shipping_events": 10800,
}
ISSUES = {
    "DQ-001": 90, "DQ-002": 150, "DQ-003": 343, "DQ-004": 263, "DQ-005": 278,
    "DQ-006": 114, "DQ-007": 26, "DQ-008": 28, "DQ-009": 263, "DQ-010": 480,
}


def test_row_counts(spark):
    raw = raw_tables(spark, SF_DIR)
    assert {t: raw[t].count() for t in raw} == ROWS
    assert CLEANERS["order_items"](raw["order_items"]).count() == ROWS["order_items"] - 60


def test_issue_counts(spark):
    raw = raw_tables(spark, SF_DIR)
    silver = TableSet({t: lambda t=t: CLEANERS[t](raw[t]) for t in CLEANERS})
    report = quality_report(spark, silver, datetime(2024, 1, 1))
    assert {r["check_id"]: r["issue_count"] for r in report.collect()} == ISSUES
