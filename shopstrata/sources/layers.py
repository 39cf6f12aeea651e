"""Layered tables on shared storage, made current by a ledger.

Overwriting a directory in place leaves readers without a table while a job runs, and without
one for good when it fails. Here each run writes a directory of its own, and appending the
ledger rows, one small file committed by a rename, is what makes it current.

Older copies go by :meth:`LayerStore.sweep`. A reader that holds a lease keeps every copy that was current at any
time since its lease began: it takes the lease first and resolves paths afterwards, and a sweep reads the ledger
first and the leases afterwards, so whatever the reader resolves is either newer than what the sweep
saw or protected by a lease that the sweep sees.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import time
import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime, timedelta
from functools import partial
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from shopstrata.sources.files import Files
from shopstrata.sources.raw_csv import BAD_ROW, good_rows, rejected_rows
from shopstrata.sources.tables import TableSet

LEDGER_SCHEMA = (
    "run_id string, run_time timestamp, layer string, `table` string, "
    "status string, rows long, path string, rejected long, error string, seconds double, "
    "metrics map<string,bigint>, recorded timestamp"
)
# Ids and prices hardly repeat: zstd and the delta encodings of Parquet's second version, which Spark reads since
# 3.3, make less than 60% of what the defaults make of them.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9", "parquet.writer.version": "v2"}
# What a reader sees: whole tables, and those of which some raw rows could not be read.
CURRENT = ("OK", "PARTIAL")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only where that is unset in local mode, as in a test, a temporary folder is used and set, and
    removed when the process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="shopstrata-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/shopstrata-{uuid.uuid4().hex}"


class LayerStore:
    """Tables named (layer, table) below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._appending = Lock()

    def write(
        self, run_id: str, run_time: datetime, layer: str, table: str, df: DataFrame,
        metrics: Mapping[str, Column] | None = None, before: Observation | None = None,
    ) -> dict:
        """Write one table of a run; rows are counted by the write itself. Returns its entry.

        ``metrics`` are further aggregates of the rows that are written, ``before`` an observation of rows on their
        way to ``df``; both are collected by the same write and kept in the entry. Raw rows that could not be read are stored with the others, but counted apart; a table that
        has any is PARTIAL.
        """
        path = f"{self.root}/{layer}/{table}/run={run_id}"
        began = time.perf_counter()
        bad = F.col(BAD_ROW).isNotNull() if BAD_ROW in df.columns else F.lit(False)
        seen = Observation()
        further = [c.alias(f"metric {name}") for name, c in (metrics or {}).items()]
        counted = df.observe(seen, F.count_if(~bad).alias("rows"), F.count_if(bad).alias("rejected"), *further)
        counted.write.mode("overwrite").options(**PACKED).parquet(path)
        rows, rejected = seen.get["rows"], seen.get["rejected"]
        found = {name: seen.get[f"metric {name}"] for name in metrics or {}} | (before.get if before else {})
        return entry(
            run_id, run_time, layer, table, "PARTIAL" if rejected else "OK", rows, path, rejected,
            seconds=time.perf_counter() - began, metrics=found or None,
        )

    def record(self, entries: Iterable[dict]) -> None:
        """Append to the ledger; written tables are current from here on."""
        now = datetime.now()
        rows = [(*e.values(), now) for e in entries]
        if rows:
            written = self.spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1)
            # Two appends at a time share a temporary folder, which the first one to end removes.
            with self._appending:
                written.write.mode("append").parquet(f"{self.root}/_ledger")

    def ledger(self) -> DataFrame:
        """All recorded entries, each once.

        Files that a compaction has replaced are not read any more, so that they can go. Their names are looked up before
        the files are listed: a reader either does not know of the compaction, and its lease is older, or leaves them out.
        """
        files = Files(self.spark, self.root)
        replaced = {name for _, _, names in self._compactions(files) for name in names}
        paths = [f.path for f in files.listed(f"{self.root}/_ledger") if f.name.endswith(".parquet") and f.name not in replaced]
        if not paths:
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        read = self.spark.read.schema(LEDGER_SCHEMA).parquet(*paths)
        return read.dropDuplicates(["run_id", "layer", "table", "recorded"])

    def _compactions(self, files: Files) -> list[tuple[str, datetime, list[str]]]:
        """(note, time, names of the replaced files) of each compaction whose files are still there."""
        found = []
        for note in files.listed(f"{self.root}/_compactions"):
            if not note.name.endswith(".part"):
                try:
                    when, *names = files.read(note.path).split("\n")
                except Exception:  # noqa: BLE001 - a note that a sweep has just removed, after its files
                    continue
                found.append((note.path, datetime.fromisoformat(when), names))
        return found

    def current(self, layer: str) -> TableSet:
        """The current contents of the tables of a layer.

        Bronze rows carry the row count of their load. It is known only once a load has been
        written, so it is kept in the ledger and added on reading; storing it in the rows would
        take a second scan of the raw files.
        """
        newest = (
            self.ledger()
            .where(F.col("status").isin(*CURRENT) & (F.col("layer") == layer))
            .groupBy("table")
            .agg(F.max_by(F.struct("path", "rows"), F.struct("run_time", "run_id")).alias("last"))
            .select("table", "last.*")
        )

        # One row per table, whatever the length of the history.
        return TableSet(
            {r["table"]: partial(self.open, layer, r["path"], r["rows"]) for r in newest.collect()}
        )

    def open(self, layer: str, path: str, rows: int) -> DataFrame:
        """A written table: its readable rows, in Bronze with the row count of the load."""
        df = self.spark.read.parquet(path)
        if BAD_ROW in df.columns:
            df = good_rows(df)
        return df.withColumn("_row_count", F.lit(rows)) if layer == "bronze" else df

    def rejects(self, layer: str = "bronze") -> DataFrame:
        """(table, record): the raw rows of the current tables that could not be read."""
        newest = self.ledger().where((F.col("layer") == layer) & F.col("status").isin(*CURRENT))
        newest = newest.groupBy("table").agg(
            F.max_by(F.struct("path", "rejected"), F.struct("run_time", "run_id")).alias("last")
        )
        found = self.spark.createDataFrame([], "`table` string, record string")
        for r in newest.select("table", "last.*").where("rejected > 0").collect():
            found = found.unionByName(rejected_rows(self.spark.read.parquet(r["path"]), r["table"]))
        return found

    def read(self, layer: str, table: str) -> DataFrame:
        """The current contents of a table."""
        return self.current(layer)[table]

    def metrics(self, layer: str) -> DataFrame:
        """(table, metric, value): what the writes of the current tables of a layer have counted."""
        newest = self.ledger().where((F.col("layer") == layer) & F.col("status").isin(*CURRENT))
        newest = newest.groupBy("table").agg(
            F.max_by(F.struct("rows", "metrics"), F.struct("run_time", "run_id")).alias("last")
        )
        counted = F.map_concat(F.create_map(F.lit("rows_out"), F.col("last.rows")), F.coalesce("last.metrics", F.create_map()))
        return newest.select("table", F.explode(counted).alias("metric", "value"))

    @contextmanager
    def lease(self, hours: float = 24) -> Iterator[None]:
        """While it lasts, a sweep leaves every copy alone that is or becomes current meanwhile.

        Resolve tables inside of it. The lease of a reader that died ends by itself after ``hours``.
        """
        files, path = Files(self.spark, self.root), f"{self.root}/_leases/{uuid.uuid4().hex}"
        now = datetime.now()
        files.write(path, f"{now.isoformat()} {(now + timedelta(hours=hours)).isoformat()}")
        try:
            yield
        finally:
            files.remove(path)

    def _oldest_lease(self, files: Files, now: datetime) -> datetime:
        """When the oldest running lease began; leases that have run out are removed."""
        oldest = now
        for found in files.listed(f"{self.root}/_leases"):
            if found.name.endswith(".part"):
                continue
            try:
                began, until = map(datetime.fromisoformat, files.read(found.path).split())
            except Exception:  # noqa: BLE001 - a lease that ended meanwhile
                continue
            if until < now:
                files.remove(found.path)
            else:
                oldest = min(oldest, began)
        return oldest

    def sweep(self, keep: int = 2, margin: timedelta = timedelta(minutes=10)) -> list[str]:
        """Delete the copies of tables that no reader can need, and compact the ledger. Returns what was deleted.

        A copy stays if it is one of the newest ``keep`` of its table, or if it was still current ``margin`` (for clocks
        that differ, and for readers without a lease) before now or before the oldest lease. The ledger becomes one file;
        the files it replaces, which readers may have listed, go in a later sweep under the same condition.
        """
        if keep < 1:
            raise ValueError("the current copy has to stay")
        files = Files(self.spark, self.root)
        newer = Window.partitionBy("layer", "table").orderBy(F.desc("run_time"), F.desc("run_id"))
        listed = self.ledger().where(F.col("status").isin(*CURRENT) & F.col("path").isNotNull())
        # A copy ended being current when the first of the newer ones was recorded.
        ended = F.min("recorded").over(newer.rowsBetween(Window.unboundedPreceding, -1))
        # One row per copy, all of them names; ledgers are as long as the number of runs.
        old = [
            (r["path"], r["ended"])
            for r in listed.select("path", F.row_number().over(newer).alias("rank"), ended.alias("ended"))
            .where(F.col("rank") > keep).toLocalIterator()
        ]
        now = datetime.now()
        until = self._oldest_lease(files, now) - margin
        gone = [path for path, ended in old if ended is not None and ended < until and files.remove(path)]
        self._compact(files, set(gone), until)
        return gone

    def _compact(self, files: Files, gone: set[str], until: datetime) -> None:
        """One ledger file without the entries of deleted copies; replaced files go when nobody can be reading them."""
        waiting = set()
        for note, when, names in self._compactions(files):
            if when < until:
                for name in names:
                    files.remove(f"{self.root}/_ledger/{name}")
                files.remove(note)
            else:
                waiting |= set(names)
        present = [f.name for f in files.listed(f"{self.root}/_ledger") if f.name.endswith(".parquet")]
        replaced = [name for name in present if name not in waiting]
        if len(replaced) < 2 and not gone:
            return
        read = self.spark.read.schema(LEDGER_SCHEMA).parquet(*[f"{self.root}/_ledger/{name}" for name in replaced])
        kept = read.dropDuplicates(["run_id", "layer", "table", "recorded"])
        if gone:
            paths = self.spark.createDataFrame([(p,) for p in sorted(gone)], "path string")
            kept = kept.join(paths, "path", "left_anti").select(*read.columns)
        kept.coalesce(1).write.mode("append").parquet(f"{self.root}/_ledger")
        files.write(f"{self.root}/_compactions/{uuid.uuid4().hex}", "\n".join([datetime.now().isoformat(), *replaced]))

    def append_history(self, table: str, report: DataFrame) -> None:
        """Append one run to a history. A run is known by its ``run_time``: writing it again replaces it."""
        (
            report.withColumns(
                {"run_date": F.to_date("run_time"), "run_key": F.unix_micros("run_time")}
            )
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_date", "run_key")
            .parquet(f"{self.root}/history/{table}")
        )

    def history(self, table: str) -> DataFrame:
        """All runs of a history, without its partition columns."""
        stored = self.spark.read.parquet(f"{self.root}/history/{table}")
        return stored.drop("run_date", "run_key")

    def newest_run(self, table: str) -> DataFrame:
        """The rows of the newest run of a history, whose one folder is found by the names of folders."""
        files, folder = Files(self.spark, self.root), f"{self.root}/history/{table}"
        for level in ("run_date", "run_key"):
            # Dates compare as text, keys as numbers.
            names = [f.name for f in files.listed(folder) if f.name.startswith(f"{level}=")]
            known = [n for n in names if not n.endswith("__")]
            if not known:
                return self.history(table)
            value = (lambda n: int(n.partition("=")[2])) if level == "run_key" else (lambda n: n)
            folder = f"{folder}/{max(known, key=value)}"
        return self.spark.read.parquet(folder)


def entry(
    run_id: str,
    run_time: datetime,
    layer: str,
    table: str,
    status: str,
    rows: int | None = None,
    path: str | None = None,
    rejected: int | None = None,
    error: str | None = None,
    seconds: float | None = None,
    metrics: dict[str, int] | None = None,
) -> dict:
    """A ledger row."""
    return {
        "run_id": run_id,
        "run_time": run_time,
        "layer": layer,
        "table": table,
        "status": status,
        "rows": rows,
        "path": path,
        "rejected": rejected,
        "error": error,
        "seconds": seconds,
        "metrics": metrics,
    }
