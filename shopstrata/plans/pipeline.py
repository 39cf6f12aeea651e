"""The full run: Bronze, Silver, quality checks, Gold, and the CSV export of the marts."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import partial
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata.functions.parse import instant
from shopstrata.plans.marts import ITEM_SALES, MARTS, in_report_order, item_sales
from shopstrata.plans.metrics import observed_input, write_metrics
from shopstrata.plans.quality import run_quality_checks
from shopstrata.plans.silver import CLEANERS, STORED_CLEANERS
from shopstrata.sources.files import Files
from shopstrata.sources.layers import CURRENT, LEDGER_SCHEMA, PACKED, LayerStore, entry
from shopstrata.sources.raw_csv import read_if_present, stamped, write_csv
from shopstrata.sources.schemas import TABLES
from shopstrata.sources.tables import TableSet

LOG = logging.getLogger(__name__)
QUALITY_LOG = "dq_quality_log"


class Run:
    """One run of the pipeline over ``raw_dir`` into the tables below ``root``.

    The tables of a layer do not depend on each other and are written side by side, so a small
    table does not wait for a large one. A failed table leaves a FAILED entry (Bronze: SKIPPED
    when there is no file) and its previous contents current; the others go on.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw_dir: str,
        root: str,
        run_time: datetime | None = None,
        mart_options: Mapping[str, dict] | None = None,
    ):
        self.spark = spark
        self.raw_dir = raw_dir.rstrip("/")
        self.store = LayerStore(spark, root)
        self.run_time = run_time or datetime.now()
        self.run_id = f"{self.run_time:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
        self.mart_options = mart_options or {}
        self.entries: list[dict] = []

    def _attempt(self, layer: str, name: str, plan: Callable[[], DataFrame | tuple | None]) -> dict:
        """Write one table and return its entry; a failure is an entry as well."""
        note = partial(entry, self.run_id, self.run_time, layer, name)
        try:
            df, metrics, before = plan(), None, None
            if df is None:
                return note("SKIPPED")
            if isinstance(df, tuple):
                df, metrics, before = df
            return self.store.write(self.run_id, self.run_time, layer, name, df, metrics, before)
        except Exception as problem:  # noqa: BLE001 - one table must not stop the others
            return note("FAILED", error=str(problem))

    def _write_layer(self, layer: str, plans: Mapping[str, Callable[[], DataFrame | tuple | None]]) -> None:
        with ThreadPoolExecutor(max_workers=max(1, len(plans))) as pool:
            self._record(pool.map(lambda name: self._attempt(layer, name, plans[name]), plans))

    def _record(self, entries: Iterable[dict]) -> None:
        entries = list(entries)
        self.store.record(entries)
        self.entries += entries

    def _scan(self, table: str) -> DataFrame | None:
        return read_if_present(self.spark, table, f"{self.raw_dir}/{table}.csv")

    def plain_load(self) -> None:
        """Load the raw files into the layer ``raw``, without any metadata."""
        self._write_layer("raw", {t: partial(self._scan, t) for t in TABLES})

    def _load(self, table: str) -> DataFrame | None:
        raw = self._scan(table)
        return None if raw is None else stamped(raw, table, self.run_time)

    def _clean(self, table: str, bronze: Callable[[], DataFrame]) -> tuple:
        """The cleaned table, and what its write is to count."""
        stamp = F.expr(instant(datetime.now()))
        source, before = observed_input(table, bronze())
        return STORED_CLEANERS[table](source).withColumn("_silver_timestamp", stamp), write_metrics(table), before

    def bronze(self) -> None:
        """Load the raw files as they are, with ingest metadata."""
        self._write_layer("bronze", {t: partial(self._load, t) for t in TABLES})

    def silver(self) -> None:
        """Clean every Bronze table."""
        bronze = self.store.current("bronze")
        self._write_layer(
            "silver", {t: partial(self._clean, t, partial(bronze.__getitem__, t)) for t in CLEANERS}
        )

    def bronze_and_silver(self) -> None:
        """Both layers, each table cleaned as soon as it is loaded.

        A table that could not be loaded is cleaned from its previous contents, as in :meth:`silver`.
        """
        def both(table: str) -> list[dict]:
            loaded = self._attempt("bronze", table, partial(self._load, table))
            if loaded["status"] in CURRENT:
                source = partial(self.store.open, "bronze", loaded["path"], loaded["rows"])
            else:
                source = lambda: self.store.current("bronze")[table]
            return [loaded, self._attempt("silver", table, partial(self._clean, table, source))]

        with ThreadPoolExecutor(max_workers=len(TABLES)) as pool:
            done = list(pool.map(both, TABLES))
        self._record(sorted((e for pair in done for e in pair), key=lambda e: e["layer"]))

    def quality(self) -> DataFrame:
        """Run the checks, write the CSV report of the run and append to the history."""
        began = time.perf_counter()
        report = run_quality_checks(self.spark, self.store.current("silver"), self.run_time)
        # Ten rows: one file is enough.
        path = f"{self.store.root}/quality_report/run={self.run_id}"
        write_csv(report.coalesce(1), path)
        self.store.append_history(QUALITY_LOG, report)
        rows = self.store.history(QUALITY_LOG).where(F.col("run_time") == F.expr(instant(self.run_time)))
        note = partial(entry, self.run_id, self.run_time, "quality", QUALITY_LOG, "OK")
        self._record([note(rows.count(), path, seconds=time.perf_counter() - began)])
        return report

    def gold(self) -> None:
        """Build the marts; they are stored unsorted and sorted when read."""
        work = f"{self.store.root}/_work/run={self.run_id}"
        silver = with_item_sales(self.spark, self.store.current("silver"), f"{work}/{ITEM_SALES}")

        def build(mart: str) -> DataFrame:
            built = MARTS[mart].build(silver, **self.mart_options.get(mart, {}))
            return built.withColumn("_gold_timestamp", F.expr(instant(self.run_time)))

        try:
            self._write_layer("gold", {m: partial(build, m) for m in MARTS})
        finally:
            Files(self.spark, self.store.root).remove(work)

    def status(self) -> DataFrame:
        """One row per layer and table of this run."""
        rows = [(*e.values(), None) for e in self.entries]
        done = self.spark.createDataFrame(rows, LEDGER_SCHEMA)
        return done.select("layer", "table", "status", "rows", "rejected", "error", "seconds")


def run_pipeline(
    spark: SparkSession,
    raw_dir: str,
    root: str,
    run_time: datetime | None = None,
    mart_options: Mapping[str, dict] | None = None,
) -> DataFrame:
    """Run all steps and return one status row per table. Issues never block Gold.

    Quality and Gold both need Silver only and run side by side.
    """
    run = Run(spark, raw_dir, root, run_time, mart_options)
    with run.store.lease():
        run.bronze_and_silver()
        with ThreadPoolExecutor(max_workers=2) as pool:
            for done in [pool.submit(run.quality), pool.submit(run.gold)]:
                done.result()
    return run.status()


def with_item_sales(spark: SparkSession, silver: Mapping[str, DataFrame], path: str) -> TableSet:
    """``silver`` with the sums that marts share, written to ``path`` when the first of them asks, for all of them.

    Where they cannot be written, there is no such table, and each mart is built, or fails, by itself.
    """
    lock, written = Lock(), []

    def stored() -> DataFrame | None:
        with lock:
            if not written:
                try:
                    item_sales(silver).write.options(**PACKED).parquet(path)
                    # Plans shorten paths; the alias names the table in them whatever its path.
                    written.append(spark.read.parquet(path).alias(ITEM_SALES))
                except Exception as problem:  # noqa: BLE001 - the marts do without
                    LOG.warning("the marts do not share %s: %s", ITEM_SALES, problem)
                    written.append(None)
            return written[0]

    return TableSet({**{t: partial(silver.__getitem__, t) for t in silver}, ITEM_SALES: stored})


def mart_totals(name: str, mart: DataFrame) -> DataFrame:
    """(mart, rows, money, units) of a stored or exported mart, summed as decimals; null for a mart without totals."""
    sums = []
    for part in MARTS[name].totals or ("NULL", "NULL"):
        exact = " + ".join(f"CAST({c} AS DECIMAL(28,4))" for c in part.split(" + "))
        sums.append(f"sum({exact})")
    return mart.selectExpr(f"'{name}' AS mart", "count(1) AS rows", f"{sums[0]} AS money", f"{sums[1]} AS units")


def export_marts(marts: Mapping[str, DataFrame], folder: str) -> None:
    """Write each mart to its own CSV folder, in report order."""
    plans = {name: in_report_order(name, marts[name]) for name in marts}
    with ThreadPoolExecutor(max_workers=len(plans)) as pool:
        list(pool.map(lambda name: write_csv(plans[name], f"{folder}/{name}"), plans))
