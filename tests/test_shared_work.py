"""What keeps the bytes down that the run and the export move: work done once, narrow shuffles, packed files."""

import os
import re
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from decimal import Decimal
from functools import partial

import pytest

import __spark_entry__ as contract
from shopstrata.functions.rounding import halves, whole_sum
from shopstrata.operators import keyed
from shopstrata.plans import marts
from shopstrata.plans.pipeline import Run, with_item_sales
from shopstrata.sources.layers import LayerStore, entry
from shopstrata.sources.raw_csv import scan_csv
from shopstrata.sources.tables import TableSet
from tests.test_marts import SCHEMAS, _random_rows

SF_DIR = "/root/testdata/sf0.001"
SHARING = ["gold_revenue_by_category", "gold_return_rate_by_product"]


def _files(folder):
    return [f for _, _, names in os.walk(folder) for f in names]


def _rows(df):
    return sorted(map(str, df.collect()))


def _plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(params=[11, 12, 13])
def frames(request, spark):
    rows = _random_rows(request.param)
    typed = {t: s.replace("quantity int", "quantity decimal(18,4)") for t, s in SCHEMAS.items()}
    found = {t: spark.createDataFrame(rows[t], SCHEMAS[t]).to(spark.createDataFrame([], typed[t]).schema) for t in SCHEMAS}
    return TableSet({t: partial(lambda df: df, df) for t, df in found.items()})


def test_marts_share_the_sums_of_items(spark, frames, tmp_path):
    shared = with_item_sales(spark, frames, str(tmp_path / "sales"))
    for name in SHARING:
        alone, together = marts.MARTS[name].build(frames), marts.MARTS[name].build(shared)
        assert together.dtypes == alone.dtypes
        assert _rows(together) == _rows(alone)
        assert "sales" in _plan(together) and "item_id" not in _plan(together)
    # Written once; another way to count orders has sums of its own.
    assert shared[marts.ITEM_SALES] is shared[marts.ITEM_SALES]
    once = marts.revenue_by_category(shared, dedupe_orders=True)
    assert _rows(once) == _rows(marts.revenue_by_category(frames, dedupe_orders=True))


def test_a_table_that_is_missing_stops_only_its_marts(spark, frames, tmp_path):
    some = TableSet({t: partial(frames.__getitem__, t) for t in frames if t != "returns"})
    shared = with_item_sales(spark, some, str(tmp_path / "sales"))
    assert _rows(marts.revenue_by_category(shared)) == _rows(marts.revenue_by_category(frames))
    with pytest.raises(KeyError):
        marts.return_rate_by_product(shared)


def test_sums_of_halves_are_exact(spark):
    values = [Decimal("99999999999999.9999"), Decimal("-99999999999999.9999"), Decimal("-0.0001"), Decimal("26843.5456"), None]
    groups = [("a", v) for v in values] + [("b", values[0])] * 50 + [("c", None)] + [("d", values[1])] * 50
    df = spark.createDataFrame(groups, "k string, v decimal(18,4)")
    found = df.groupBy("k").agg(*[contract.F.expr(x) for x in halves("v", "s", 4)]).selectExpr("k", whole_sum("s", 4))
    expected = df.groupBy("k").agg(contract.F.sum("v").alias("s"))
    assert found.dtypes == expected.dtypes
    assert _rows(found) == _rows(expected)


def test_match_shuffles_no_column_of_its_own(spark):
    left = spark.range(100).selectExpr("cast(id as string) AS key", "id AS n")
    right = left.groupBy("key").count()
    plan = keyed.match(left, right, "key", "left")._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"\bhash\(.*\) AS ", plan)


def test_raw_and_stored_files_are_packed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(contract, "RAW_FILE_ROWS", 1000)
    raw_dir = contract._raw_files(spark, SF_DIR, contract.TABLES)
    local = raw_dir.removeprefix("file:")
    for table in contract.TABLES:
        names = [f for f in _files(f"{local}/{table}.csv") if f.startswith("part-")]
        assert names and all(f.endswith(".csv.gz") for f in names)
        direct = contract.raw_tables(spark, SF_DIR)[table]
        assert _rows(scan_csv(spark, table, f"{raw_dir}/{table}.csv")) == _rows(direct)
    # One task wrote the returns and the items, or few; none of their files holds more than the bound.
    assert spark.read.text(f"{raw_dir}/order_items.csv").groupBy("_metadata.file_path").count().agg({"count": "max"}).first()[0] <= 1001
    run = Run(spark, raw_dir, str(tmp_path / "root"), datetime(2024, 1, 1))
    run.bronze_and_silver()
    run.gold()
    assert {e["status"] for e in run.entries} == {"OK"}
    for layer in ("bronze", "silver", "gold"):
        names = [f for f in _files(tmp_path / "root" / layer) if f.startswith("part-")]
        assert names and all(f.endswith(".zstd.parquet") for f in names)
    assert not os.listdir(tmp_path / "root" / "_work")


def test_appends_to_the_ledger_do_not_meet(spark, tmp_path):
    """Checks and marts of a run end side by side; the end of one append took away what another was writing."""
    store = LayerStore(spark, str(tmp_path))
    noted = [entry(f"r{i}", datetime(2024, 1, 1), "gold", f"t{i}", "OK", i, "p") for i in range(24)]
    with ThreadPoolExecutor(max_workers=8) as pool:
        list(pool.map(lambda e: store.record([e]), noted))
    assert sorted(r["rows"] for r in store.ledger().collect()) == list(range(24))


def test_the_export_derives_orders_and_item_sums_once(spark, tmp_path, monkeypatch):
    folders = iter([str(tmp_path / "csv"), str(tmp_path / "work")])
    monkeypatch.setattr(contract, "shared_folder", lambda spark: next(folders))
    expected = [contract.mart_totals(n, contract._gold(spark, SF_DIR)[n]) for n in contract.MARTS]
    found = contract.queries()["gold_export"](spark, SF_DIR)
    assert _rows(found) == sorted(str(r) for df in map(contract.portable, expected) for r in df.collect())
    assert sorted(os.listdir(tmp_path / "work")) == ["item_sales", "orders"]
