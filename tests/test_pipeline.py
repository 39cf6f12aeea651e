"""CSV scans, the ledger, full runs, histories and exports."""

from datetime import datetime

import pytest

import __spark_entry__ as contract
from shopstrata.plans import quality
from shopstrata.plans.pipeline import QUALITY_LOG, Run, export_marts, run_pipeline
from shopstrata.sources.layers import LayerStore, shared_folder
from shopstrata.sources.raw_csv import (
    read_csv, read_if_present, rejected_rows, scan_csv, stamped, write_csv,
)
from shopstrata.sources.schemas import RAW_COLUMNS, TABLES, raw_schema
from shopstrata.sources.star_adapter import raw_tables

SF_DIR = "/root/testdata/sf0.001"
FIRST, SECOND = datetime(2024, 3, 1, 8), datetime(2024, 3, 2, 8)


def write(path, text):
    path.write_text(text, encoding="utf8")
    return str(path)


HEADER = ",".join(RAW_COLUMNS["returns"])


def test_scan_keeps_cells_as_received(spark, tmp_path):
    path = write(
        tmp_path / "returns.csv",
        f'{HEADER}\n007," O-1 ",2024-02-30,"said ""no"", left",NA,\n008,,,"a, b",x,1.50\n',
    )
    found = [tuple(r) for r in scan_csv(spark, "returns", path).collect()]
    assert found == [
        ("007", " O-1 ", "2024-02-30", 'said "no", left', "NA", None),
        ("008", None, None, "a, b", "x", "1.50"),
    ]


def test_scan_rejects_other_headers(spark, tmp_path):
    path = write(tmp_path / "returns.csv", HEADER.replace("reason", "why") + "\n1,2,3,4,5,6\n")
    with pytest.raises(ValueError, match="lacks reason"):
        scan_csv(spark, "returns", path)


def test_columns_are_bound_by_name(spark, tmp_path):
    columns = ["note", *reversed(RAW_COLUMNS["returns"])]
    cells = {"note": "n", **{c: f"<{c}>" for c in RAW_COLUMNS["returns"]}}
    path = write(tmp_path / "returns.csv", f"{','.join(columns)}\n{','.join(cells[c] for c in columns)}\n")
    found = scan_csv(spark, "returns", path).first().asDict()
    assert found == {c: f"<{c}>" for c in RAW_COLUMNS["returns"]}


def test_malformed_rows_are_kept_apart(spark, tmp_path):
    good = "R0,O0,2024-01-01,fine,approved,1.00"
    comma = "R1,O1,2024-01-01,late, again,approved,5.00"
    path = write(tmp_path / "returns.csv", f"{HEADER}\n{good}\n{comma}\nR2,O2,2024-01-01\n")
    read = read_csv(spark, "returns", path)
    assert [r["return_id"] for r in scan_csv(spark, "returns", path).select("return_id").collect()] == ["R0"]
    assert scan_csv(spark, "returns", path).count() == 1
    assert {tuple(r) for r in rejected_rows(read, "returns").collect()} == {
        ("returns", comma), ("returns", "R2,O2,2024-01-01"),
    }


def test_line_breaks_in_cells(spark, tmp_path):
    columns = RAW_COLUMNS["customers"]
    row = ["C1", "A", "B", "e", "p", '"New\nYork"', "NY", "1", "s", "2024-01-01"]
    path = write(tmp_path / "customers.csv", f"{','.join(columns)}\n{','.join(row)}\n")
    assert scan_csv(spark, "customers", path).first()["city"] == "New\nYork"
    assert rejected_rows(read_csv(spark, "customers", path), "customers").count() == 0


def test_missing_file(spark, tmp_path):
    assert read_if_present(spark, "returns", str(tmp_path / "none.csv")) is None


def test_round_trip_keeps_outer_spaces(spark, tmp_path):
    rows = [(" a\t", None, "", 'q"q', "x,y", "  ")]
    write_csv(spark.createDataFrame(rows, raw_schema("returns")), str(tmp_path / "r.csv"))
    found = scan_csv(spark, "returns", str(tmp_path / "r.csv")).first()
    # An empty cell means a missing one.
    assert tuple(found) == (" a\t", None, None, 'q"q', "x,y", "  ")


def test_ingest_metadata(spark):
    raw = raw_tables(spark, SF_DIR)["returns"]
    found = stamped(raw, "returns", FIRST)
    assert found.columns == RAW_COLUMNS["returns"] + ["_ingest_timestamp", "_source_file"]
    row = found.first()
    assert (row["_ingest_timestamp"], row["_source_file"]) == (FIRST, "returns.csv")


@pytest.fixture(scope="module")
def raw_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for table, df in raw_tables(spark, SF_DIR).items():
        write_csv(df, f"{folder}/{table}.csv")
    return str(folder)


@pytest.fixture(scope="module")
def two_runs(spark, raw_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    first = run_pipeline(spark, raw_dir, root, FIRST, contract.MART_OPTIONS).collect()
    second = run_pipeline(spark, raw_dir, root, SECOND, contract.MART_OPTIONS).collect()
    return LayerStore(spark, root), first, second


def test_runs_are_repeatable(two_runs):
    store, first, second = two_runs
    key = lambda r: (r["layer"], r["table"], r["status"], r["rows"], r["rejected"])
    assert sorted(map(str, map(key, first))) == sorted(map(str, map(key, second)))
    assert all(r["seconds"] > 0 and r["error"] is None for r in first)
    assert {r["status"] for r in first} == {"OK"}
    assert [r["layer"] for r in first].count("bronze") == len(TABLES)
    rows = {(r["layer"], r["table"]): r["rows"] for r in first}
    for (layer, table), n in rows.items():
        if layer in ("bronze", "silver", "gold"):
            assert store.read(layer, table).count() == n, "the newest run replaces the older"


def test_layers_carry_their_timestamps(two_runs):
    store = two_runs[0]
    orders = store.read("bronze", "orders")
    assert orders.first()["_ingest_timestamp"] == SECOND
    assert orders.first()["_row_count"] == orders.count()
    assert store.read("silver", "orders").first()["_row_count"] == orders.count()
    silver = store.read("silver", "orders").columns
    assert {"_ingest_timestamp", "_source_file", "_row_count", "_silver_timestamp"} <= set(silver)
    assert store.read("gold", "gold_fulfillment_summary").first()["_gold_timestamp"] == SECOND


def test_writes_count_for_the_ledger(two_runs, spark):
    from shopstrata.plans.metrics import silver_metrics

    store = two_runs[0]
    found = sorted(map(tuple, store.metrics("silver").collect()))
    counted = silver_metrics(store.current("bronze"), store.current("silver"))
    assert found == sorted(map(tuple, counted.collect()))


def test_history_grows_by_one_report_per_run(two_runs, spark):
    store = two_runs[0]
    history = store.history(QUALITY_LOG)
    assert history.count() == 2 * len(quality.CHECKS)
    assert {r["run_time"] for r in quality.latest_run(history).collect()} == {SECOND}
    again = quality.latest_run(history)
    store.append_history("again", again)
    store.append_history("again", again)
    assert store.history("again").count() == len(quality.CHECKS)


def test_the_same_run_time_twice_is_one_report(spark, raw_dir, tmp_path):
    for _ in range(2):
        status = run_pipeline(spark, raw_dir, str(tmp_path), FIRST, contract.MART_OPTIONS)
    history = LayerStore(spark, str(tmp_path)).history(QUALITY_LOG)
    assert history.count() == quality.latest_report(history).count() == len(quality.CHECKS)
    assert quality.quality_summary(quality.latest_run(history)).first()["checks_run"] == len(quality.CHECKS)
    assert status.where("layer = 'quality'").first()["rows"] == len(quality.CHECKS)


def test_a_table_with_rejects_is_partial(spark, raw_dir, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for table in TABLES:
        if table != "returns":
            (folder / f"{table}.csv").symlink_to(f"{raw_dir}/{table}.csv")
    broken = 'R3,O3,2024-01-02,"two\nlines",approved,2.00'
    write(folder / "returns.csv", f"{HEADER}\nR0,O0,2024-01-01,fine,approved,1.00\na,b\n{broken}\n")
    run = Run(spark, str(folder), str(tmp_path / "lake"), FIRST)
    run.bronze()
    run.silver()
    status = {(r["layer"], r["table"]): r for r in run.status().collect()}
    loaded = status["bronze", "returns"]
    assert (loaded["status"], loaded["rows"], loaded["rejected"]) == ("PARTIAL", 2, 1)
    assert status["silver", "returns"]["rows"] == 2
    assert run.store.read("bronze", "returns").first()["_row_count"] == 2
    assert run.store.rejects().count() == 1


def test_report_csv(two_runs, spark):
    store = two_runs[0]
    path = store.ledger().where("layer = 'quality'").orderBy("run_time").collect()[-1]["path"]
    report = spark.read.option("header", True).csv(path)
    assert report.columns == [
        "run_time", "check_id", "check_name", "table", "category", "description", "status",
        "issue_count", "message",
    ]
    assert report.count() == len(quality.CHECKS)


def test_marts_from_files_equal_marts_in_memory(two_runs, spark):
    store = two_runs[0]
    for name in ("gold_revenue_by_category", "gold_monthly_order_summary"):
        stored = contract.portable(store.read("gold", name).drop("_gold_timestamp"))
        direct = contract.queries()[name](spark, SF_DIR)
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, direct.collect()))


def test_invariants(two_runs):
    store = two_runs[0]
    orders = store.read("silver", "orders")
    paid = orders.where("order_date IS NOT NULL AND order_total IS NOT NULL").count()
    monthly = store.read("gold", "gold_monthly_order_summary")
    assert monthly.selectExpr("sum(total_orders)").first()[0] == paid
    assert store.read("gold", "gold_customer_lifetime_value").count() == (
        store.read("silver", "customers").count()
    )
    shipments = store.read("silver", "shipping_events")
    carried = store.read("gold", "gold_fulfillment_summary").selectExpr("sum(total_shipments)")
    assert carried.first()[0] + shipments.where("_invalid_ship_date").count() == shipments.count()


def test_plain_load(spark, raw_dir, tmp_path):
    run = Run(spark, raw_dir, str(tmp_path / "lake"), FIRST)
    run.plain_load()
    assert {(r["table"], r["status"]) for r in run.status().collect()} == {
        (t, "OK") for t in TABLES
    }
    loaded = run.store.read("raw", "customers")
    assert loaded.columns == RAW_COLUMNS["customers"]
    assert loaded.count() == scan_csv(spark, "customers", f"{raw_dir}/customers.csv").count()


def test_command_line(spark, raw_dir, tmp_path, capsys):
    from shopstrata.__main__ import main

    root = str(tmp_path / "lake")
    main(["run", raw_dir, root, "--run-time", "2024-03-01T08:00:00"])
    main(["export", root, str(tmp_path / "csv")])
    main(["dashboard", root])
    shown = capsys.readouterr().out
    assert "dq_quality_log" in shown and "overall_return_pct" in shown and "sample_no" in shown
    exported = spark.read.option("header", True).csv(f"{tmp_path}/csv/gold_fulfillment_summary")
    assert exported.count() == 5


def test_missing_and_broken_tables_do_not_stop_the_rest(spark, raw_dir, tmp_path):
    """No returns file, and a shipping file with a wrong header."""
    folder = tmp_path / "raw"
    folder.mkdir()
    for table in ("customers", "products", "orders", "order_items"):
        (folder / f"{table}.csv").symlink_to(f"{raw_dir}/{table}.csv")
    write(folder / "shipping_events.csv", "a,b\n1,2\n")
    run = Run(spark, str(folder), str(tmp_path / "lake"), FIRST)
    run.bronze()
    run.silver()
    checked = run.quality().collect()
    report = {r["check_id"]: r["status"] for r in checked}
    assert all((r["message"] is not None) == (r["status"] == "ERROR") for r in checked)
    run.gold()
    status = {(r["layer"], r["table"]): r["status"] for r in run.status().collect()}
    assert status["bronze", "returns"] == "SKIPPED"
    assert status["bronze", "shipping_events"] == "FAILED"
    failed = run.status().where("layer = 'bronze' AND status = 'FAILED'").first()
    assert "lacks shipment_id" in failed["error"]
    assert status["silver", "orders"] == "OK"
    assert report["DQ-003"] == report["DQ-005"] == report["DQ-010"] == "ERROR"
    assert report["DQ-001"] == report["DQ-004"] == report["DQ-006"] == "FAIL"
    assert status["gold", "gold_revenue_by_category"] == "OK"
    assert status["gold", "gold_fulfillment_summary"] == "FAILED"
    assert status["gold", "gold_return_rate_by_product"] == "FAILED"


def test_failed_run_leaves_the_old_table(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    store.record([store.write("r1", FIRST, "silver", "t", spark.range(3))])
    bad = spark.range(5).selectExpr("raise_error('broken') AS id")
    with pytest.raises(Exception, match="broken"):
        store.write("r2", SECOND, "silver", "t", bad)
    assert store.read("silver", "t").count() == 3


def test_export(spark, tmp_path):
    mart = spark.createDataFrame(
        [("b", "2.00"), ("a", "5.00")], "category string, total_revenue string"
    )
    export_marts({"gold_revenue_by_category": mart}, str(tmp_path))
    found = spark.read.option("header", True).csv(f"{tmp_path}/gold_revenue_by_category")
    assert sorted(map(tuple, found.collect())) == [("a", "5.00"), ("b", "2.00")]


def test_shared_folder_follows_the_cluster(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(base)
    assert shared_folder(spark) != shared_folder(spark)


def test_a_mart_needs_no_totals(spark, monkeypatch):
    from shopstrata.plans.marts import MARTS, Mart
    from shopstrata.plans.pipeline import mart_totals

    monkeypatch.setitem(MARTS, "gold_new", Mart(lambda t: t["orders"], ()))
    frame = spark.createDataFrame([(1,), (2,)], "a int")
    assert tuple(mart_totals("gold_new", frame).first()) == ("gold_new", 2, None, None)
