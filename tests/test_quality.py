"""Checks, report and summary on small frames, and error isolation."""

from datetime import datetime
from decimal import Decimal

import pytest

from shopstrata.plans import quality
from shopstrata.plans.metrics import load_totals, row_counts

RUN = datetime(2024, 1, 1)


@pytest.fixture()
def tables(spark):
    frame = spark.createDataFrame
    return {
        "orders": frame(
            [("1", "A", 5), ("1", "A", 5), ("2", "nan", None), ("3", None, 1), (None, "B", 1),
             (None, "B", 1)],
            "order_id string, customer_id string, order_total int",
        ).selectExpr("*", "DATE '2024-01-01' AS order_date", "'completed' AS status"),
        "order_items": frame(
            [("a", "1"), ("b", "9"), ("c", "2")], "item_id string, order_id string"
        ).selectExpr("*", "'P' AS product_id", "1 AS line_total"),
        "returns": frame(
            [("r1", "1", "approved", 5), ("r2", "8", "pending", 0), ("r3", None, None, None)],
            "return_id string, order_id string, status string, refund_amount int",
        ).selectExpr("*", "'why' AS reason", "DATE '2024-01-01' AS return_date"),
        "customers": frame(
            [("C2", "x"), ("C1", "x"), ("C3", None), ("C4", None), ("C5", "y")],
            "customer_id string, email string",
        ),
        "products": frame(
            [("p1", Decimal(5), Decimal(3)), ("p2", Decimal(0), None), ("p3", None, Decimal(1)),
             ("p4", Decimal(2), Decimal(3)), ("p5", Decimal(2), None)],
            "product_id string, unit_price decimal(18,2), cost_price decimal(18,2)",
        ).selectExpr("*", "'n' AS product_name"),
        "shipping_events": frame(
            [("s1", True), ("s2", False)], "shipment_id string, _invalid_ship_date boolean"
        ).selectExpr(
            "*", "'1' AS order_id", "'UPS' AS carrier", "DATE '2024-01-09' AS ship_date",
            "DATE '2024-01-02' AS actual_delivery",
        ),
    }


COUNTS = {
    "DQ-001": 2, "DQ-002": 2, "DQ-003": 2, "DQ-004": 3, "DQ-005": 1,
    "DQ-006": 1, "DQ-007": 2, "DQ-008": 3, "DQ-009": 1, "DQ-010": 2,
}


def test_report_counts_what_the_listings_list(spark, tables):
    report = {r["check_id"]: r for r in quality.quality_report(spark, tables, RUN).collect()}
    assert {i: r["issue_count"] for i, r in report.items()} == COUNTS
    for check in quality.CHECKS:
        assert check.violations(tables).count() == COUNTS[check.check_id]
        assert report[check.check_id]["description"] == check.description
        assert report[check.check_id]["run_time"] == RUN


def test_listings(tables):
    emails = {r["email"]: r for r in quality.shared_email_lists(tables).collect()}
    assert emails["x"]["customer_ids"] == "C1, C2" and emails[None]["customer_ids"] == "C3, C4"
    assert {tuple(r) for r in quality.BY_ID["DQ-007"].violations(tables).collect()} == {
        ("x", 2, "C1", "C2"), (None, 2, "C3", "C4"),
    }
    assert quality.BY_ID["DQ-005"].violations(tables).first()["days_diff"] == -7
    unmatched = quality.BY_ID["DQ-003"].violations(tables).collect()
    assert {r["return_id"] for r in unmatched} == {"r2", "r3"}
    empty = quality.BY_ID["DQ-004"].violations(tables).collect()
    assert sorted(str(r["order_id"]) for r in empty) == ["3", "None", "None"]


def test_pass_and_summary(spark, tables):
    clean = dict(tables, products=tables["products"].where("product_id = 'p1'"))
    report = quality.quality_report(spark, clean, RUN)
    summary = quality.quality_summary(report).first()
    assert summary.asDict() == {
        "checks_run": 10, "passed": 1, "failed": 9, "errors": 0,
        "total_issues": sum(COUNTS.values()) - COUNTS["DQ-008"], "all_passed": False,
    }


def test_missing_table_is_an_error_row(spark, tables):
    partial = {n: df for n, df in tables.items() if n != "order_items"}
    report = {r["check_id"]: r for r in quality.quality_report(spark, partial, RUN).collect()}
    assert {i for i, r in report.items() if r["status"] == "ERROR"} == {"DQ-004", "DQ-006"}
    assert report["DQ-004"]["issue_count"] == -1
    assert report["DQ-001"]["issue_count"] == 2 and report["DQ-003"]["issue_count"] == 2


def test_failure_while_running_is_isolated(spark, tables):
    """A table that cannot be read breaks the shared job, and then only its own checks."""
    broken = tables["products"].selectExpr(
        "product_id", "product_name", "cost_price",
        "CAST(raise_error('unreadable') AS DECIMAL(18,2)) AS unit_price",
    )
    report = quality.run_quality_checks(spark, dict(tables, products=broken), RUN)
    status = {r["check_id"]: (r["status"], r["issue_count"]) for r in report.collect()}
    assert status.pop("DQ-008") == ("ERROR", -1)
    assert {i: n for i, (_, n) in status.items()} == {
        i: n for i, n in COUNTS.items() if i != "DQ-008"
    }
    summary = quality.quality_summary(report).first()
    assert summary["errors"] == 1 and summary["total_issues"] == sum(COUNTS.values()) - 3


def test_errors_do_not_reset_all_passed(spark):
    rows = [("PASS", 0), ("ERROR", -1)]
    report = spark.createDataFrame(rows, "status string, issue_count long")
    summary = quality.quality_summary(report).first()
    assert summary["all_passed"] and summary["errors"] == 1 and summary["total_issues"] == 0


@pytest.mark.parametrize("issues, shown", [(0, 0), (4, 4), (5, 5), (6, 3), (40, 3)])
def test_samples(spark, tables, issues, shown):
    returns = spark.range(issues).selectExpr(
        "lpad(CAST(id AS STRING), 3, '0') AS return_id", "'1' AS order_id", "'w' AS reason",
        "'s' AS status", "0 AS refund_amount",
    )
    check = quality.BY_ID["DQ-010"]
    found = quality.sample_violations(check, {"returns": returns}).collect()
    assert [r["sample_no"] for r in found] == list(range(1, shown + 1))
    assert [r["record"] for r in found] == [
        f"return_id={i:03d}, order_id=1, reason=w, status=s" for i in range(shown)
    ]


def test_shared_samples_equal_single_ones(tables):
    together = sorted(map(tuple, quality.quality_samples(tables).collect()))
    single = sorted(tuple(r) for c in quality.CHECKS for r in quality.sample_violations(c, tables).collect())
    assert together == single


MORE = [
    quality.Check(
        "DQ-011", "It's a new one", "Validity", "Items on products that don't exist.",
        quality.Alone("order_items", "products", "product_id"), ("item_id", "product_id"),
    ),
    quality.Check(
        "DQ-012", "Free items", "Validity", "Items that cost nothing.",
        quality.Rows("order_items", "line_total < 2"), ("item_id", "line_total * 2 AS twice"),
    ),
    quality.Check(
        "DQ-013", "Customers twice", "Uniqueness", "Customer ids on several orders.",
        quality.Repeated("orders", "customer_id"), ("customer_id", "occurrences"),
    ),
    quality.Check(
        "DQ-014", "Own listing", "Validity", "Whatever a function finds.",
        lambda t: t["returns"].where("status = 'pending'"), ("return_id", "status"), on="returns",
    ),
]


def test_a_check_is_added_in_one_place(spark, tables, monkeypatch):
    monkeypatch.setattr(quality, "CHECKS", [*quality.CHECKS, *MORE])
    for report in (quality.quality_report(spark, tables, RUN), quality.run_quality_checks(spark, tables, RUN)):
        found = {r["check_id"]: r for r in report.collect()}
        assert {i: r["issue_count"] for i, r in found.items()} == COUNTS | {
            "DQ-011": 3, "DQ-012": 3, "DQ-013": 2, "DQ-014": 1,
        }
        assert (found["DQ-011"]["check_name"], found["DQ-014"]["table"]) == ("It's a new one", "silver_returns")
    samples = sorted(map(tuple, quality.quality_samples(tables).collect()))
    single = sorted(tuple(r) for c in quality.CHECKS for r in quality.sample_violations(c, tables).collect())
    assert samples == single
    assert ("DQ-012", 1, "item_id=a, twice=2") in samples


def test_checks_share_scans(tables):
    """Fourteen checks are five scans, a census of each of four keys, and a listing."""
    plans = dict(quality.shared_counts([*quality.CHECKS, *MORE]))
    assert set(plans) == {
        ("DQ-001", "DQ-003", "DQ-004", "DQ-006"), ("DQ-002", "DQ-009"), ("DQ-005",), ("DQ-007",), ("DQ-008",),
        ("DQ-010",), ("DQ-011",), ("DQ-012",), ("DQ-013",), ("DQ-014",),
    }


def test_latest_report_headings(spark, tables):
    report = quality.quality_report(spark, tables, RUN)
    found = quality.latest_report(report)
    assert found.columns == ["ID", "Check", "Category", "Status", "Issues Found"]
    assert found.count() == 10


def test_row_counts_report_unreadable_tables(spark, tables):
    openers = {
        "orders": lambda: tables["orders"],
        "gone": lambda: spark.read.parquet("/nowhere/at/all"),
    }
    counts = row_counts(spark, "silver", openers)
    assert sorted(map(tuple, counts.collect())) == [
        ("silver", "gone", "ERROR", None),
        ("silver", "orders", "OK", 6),
    ]
    assert tuple(load_totals(counts).first()) == ("silver", 1, 6)
