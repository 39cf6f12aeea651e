"""Copies of tables that no reader needs, leases, the compacted ledger, and the newest run of a history."""

import threading
from datetime import datetime, timedelta

import pytest

from shopstrata.plans import quality
from shopstrata.sources.layers import LayerStore

START = datetime(2024, 5, 1)
NONE = timedelta(0)


def run(store, number, rows=None):
    day = START + timedelta(days=number)
    frame = store.spark.range(rows or number + 1)
    store.record([store.write(f"r{number}", day, "silver", t, frame) for t in ("orders", "returns")])


def copies(root, table="orders"):
    return sorted(p.name for p in (root / "silver" / table).iterdir() if p.name.startswith("run="))


def ledger_files(root):
    return [p for p in (root / "_ledger").iterdir() if p.name.endswith(".parquet")]


def test_two_copies_are_left_after_ten_runs(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    for number in range(10):
        run(store, number)
    before = store.ledger().count()
    gone = store.sweep(margin=NONE)
    assert len(gone) == 16 and before == 20
    assert copies(tmp_path) == copies(tmp_path, "returns") == ["run=r8", "run=r9"]
    assert store.read("silver", "orders").count() == 10
    # The replaced ledger files are left to readers until the next sweep.
    assert len(ledger_files(tmp_path)) == 11
    assert store.sweep(margin=NONE) == [] and len(ledger_files(tmp_path)) == 1
    assert store.ledger().count() == 4
    run(store, 10)
    store.sweep(keep=1, margin=NONE)
    assert copies(tmp_path) == ["run=r10"] and store.read("silver", "returns").count() == 11
    with pytest.raises(ValueError):
        store.sweep(keep=0)


def test_a_late_run_of_an_earlier_day_is_not_current(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    for number in (5, 1, 6):
        run(store, number)
    store.sweep(keep=1, margin=NONE)
    assert copies(tmp_path) == ["run=r6"]


def test_margin_and_leases_keep_copies(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    run(store, 0)
    with store.lease():
        held = store.read("silver", "orders")
        for number in range(1, 5):
            run(store, number)
        assert store.sweep(keep=1, margin=NONE) == []
        assert held.count() == 1 and store.sweep(keep=1) == []
    assert store.sweep(keep=1) == [], "they were current a moment ago"
    assert len(store.sweep(keep=1, margin=NONE)) == 8
    run(store, 5)
    with store.lease(hours=-1):
        assert len(store.sweep(keep=1, margin=NONE)) == 2, "a lease that has run out holds nothing"


def test_readers_do_not_fail_during_sweeps(spark, tmp_path):
    store, failures, reads, done = LayerStore(spark, str(tmp_path)), [], [], threading.Event()
    removed = 0
    run(store, 0, 100)

    def read():
        while not done.is_set():
            try:
                with store.lease():
                    reads.append(store.read("silver", "orders").count())
            except Exception as problem:  # noqa: BLE001
                failures.append(problem)

    readers = [threading.Thread(target=read) for _ in range(3)]
    for reader in readers:
        reader.start()
    for number in range(1, 7):
        run(store, number, 100)
        removed += len(store.sweep(keep=1, margin=timedelta(seconds=2)))
    done.set()
    for reader in readers:
        reader.join()
    assert not failures and set(reads) == {100} and removed


def test_newest_run_reads_one_folder(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    schema = "run_time timestamp, check_id string, check_name string, category string, status string, issue_count long"
    days = [START + timedelta(days=d, microseconds=d) for d in range(40)]
    rows = [(day, "DQ-1", "n", "c", "PASS", i) for i, day in enumerate(days)]
    rows += [(days[-1] + timedelta(seconds=s), "DQ-1", "n", "c", "PASS", 100 + s) for s in (9, 10, 2)]
    store.append_history("log", spark.createDataFrame(rows, schema))
    newest = store.newest_run("log")
    assert len(newest.inputFiles()) == 1
    assert [(r["run_time"], r["issue_count"]) for r in newest.collect()] == [(days[-1] + timedelta(seconds=10), 110)]
    expected = quality.latest_report(store.history("log")).collect()
    assert quality.displayed(newest).collect() == expected
    assert newest.columns == store.history("log").columns
