
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import partial, reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from oracle.answers import answers  # noqa: E402
from shopstrata.functions.parse import instant  # noqa: E402
from shopstrata.plans import metrics, quality, serving, singles  # noqa: E402
from shopstrata.plans.backfill import backfill_order_totals  # noqa: E402
from shopstrata.plans.marts import ITEM_SALES, MARTS, ORDER_COLUMNS, in_report_order  # noqa: E402
from shopstrata.plans.pipeline import QUALITY_LOG, Run, export_marts, mart_totals, run_pipeline, with_item_sales  # noqa: E402
from shopstrata.plans.silver import CLEANERS, STORED_CLEANERS, silver_order_items_rejects  # noqa: E402
from shopstrata.sources.layers import PACKED, LayerStore, shared_folder  # noqa: E402
from shopstrata.sources.raw_csv import read_csv, rejected_rows, scan_csv, write_csv  # noqa: E402
from shopstrata.sources.schemas import RAW_COLUMNS, TABLES  # noqa: E402
from shopstrata.sources.star_adapter import raw_tables  # noqa: E402
from shopstrata.sources.tables import TableSet  # noqa: E402

try:  # the training-data operators are an optional part
    import corpus_pipeline  # noqa: E402
    from shopstrata.llm import queries as corpus_queries  # noqa: E402
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(("corpus_pipeline", "shopstrata.llm")):
        raise
    corpus_pipeline = corpus_queries = None

INGEST_TIME = datetime(2024, 1, 1)
RUN_TIME = datetime(2024, 1, 2)
# The test data's customers spend far more than the default thresholds.
TIERS = {"high_value": 1_050_000, "mid_value": 800_000}
# A gzipped file is read by one task.
RAW_FILE_ROWS = 1_000_000
MART_OPTIONS = {"gold_customer_lifetime_value": TIERS}

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Cast to types that compare alike on both engines."""

    targets = {"decimal": "DOUBLE", "float": "DOUBLE", "tinyint": "BIGINT", "smallint": "BIGINT",
               "int": "BIGINT", "timestamp": "TIMESTAMP_NTZ"}
    columns = []
    for name, kind in df.dtypes:
        target = targets.get(kind.split("(")[0])
        columns.append(f"CAST(`{name}` AS {target}) AS `{name}`" if target else f"`{name}`")
    return df.selectExpr(*columns)


def _silver(spark: SparkSession, sf_dir: str) -> TableSet:
    raw = raw_tables(spark, sf_dir)
    return TableSet({t: lambda t=t: CLEANERS[t](raw[t]) for t in TABLES})


def _gold(spark: SparkSession, sf_dir: str) -> TableSet:
    return _marts(_silver(spark, sf_dir))


def _marts(silver: TableSet) -> TableSet:
    return TableSet(
        {
            name: lambda name=name, mart=mart: mart.build(silver, **MART_OPTIONS.get(name, {}))
            for name, mart in MARTS.items()
        }
    )


def _on_silver(plan: Callable[[TableSet], DataFrame]) -> Query:
    return lambda spark, sf_dir: portable(plan(_silver(spark, sf_dir)))


def _on_raw(plan: Callable[[TableSet], DataFrame]) -> Query:
    return lambda spark, sf_dir: portable(plan(raw_tables(spark, sf_dir)))


def _on_gold(plan: Callable[[TableSet], DataFrame]) -> Query:
    return lambda spark, sf_dir: portable(plan(_gold(spark, sf_dir)))


def _raw_files(spark: SparkSession, sf_dir: str, tables: list[str]) -> str:
    """The raw tables written as CSV, side by side, into a new shared folder."""
    folder = shared_folder(spark)
    stored = {t: partial(scan_csv, spark, t, f"{folder}/{t}.csv") for t in tables}
    raw = raw_tables(spark, sf_dir, items=stored.get("order_items"))

    def write(table: str) -> None:
        write_csv(raw[table], f"{folder}/{table}.csv", "gzip", RAW_FILE_ROWS)

    # The orders get their totals from the items that are written first.
    later = [t for t in tables if t == "orders" and "order_items" in stored]
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        written = {t: pool.submit(write, t) for t in tables if t not in later}
        for table in later:
            written["order_items"].result()
            write(table)
        for done in written.values():
            done.result()
    return folder


def _bronze_scan(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return scan_csv(spark, table, f"{_raw_files(spark, sf_dir, [table])}/{table}.csv")

    return run


def _bronze_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Run(spark, _raw_files(spark, sf_dir, TABLES), shared_folder(spark), INGEST_TIME)
    run.bronze()
    bronze = run.store.current("bronze")
    loaded = None
    for table in TABLES:
        rows = bronze[table].select(
            F.col(RAW_COLUMNS[table][0]).alias("id"),
            "_ingest_timestamp",
            "_source_file",
            "_row_count",
        )
        loaded = rows if loaded is None else loaded.unionByName(rows)
    return portable(loaded)


def _layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, silver = raw_tables(spark, sf_dir), _silver(spark, sf_dir)
    bronze = metrics.row_counts(spark, "bronze", {t: partial(raw.__getitem__, t) for t in TABLES})
    clean = metrics.row_counts(spark, "silver", {t: partial(silver.__getitem__, t) for t in TABLES})
    return portable(bronze.unionByName(clean))


def _load_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_tables(spark, sf_dir)
    counts = metrics.row_counts(spark, "bronze", {t: partial(raw.__getitem__, t) for t in TABLES})
    return portable(metrics.load_totals(counts))


def _silver_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_tables(spark, sf_dir)
    clean = TableSet({t: lambda t=t: CLEANERS[t](raw[t]) for t in TABLES})
    return portable(metrics.silver_metrics(raw, clean))


def _silver_metrics_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same figures as the writes of Silver have counted them, read from the ledger."""
    raw, store = raw_tables(spark, sf_dir), LayerStore(spark, shared_folder(spark))

    def write(table: str) -> dict:
        source, before = metrics.observed_input(table, raw[table])
        cleaned = CLEANERS[table](source)
        return store.write("one", RUN_TIME, "silver", table, cleaned, metrics.write_metrics(table), before)

    with ThreadPoolExecutor(max_workers=len(TABLES)) as pool:
        store.record(list(pool.map(write, TABLES)))
    return portable(store.metrics("silver"))


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(spark, _silver(spark, sf_dir), RUN_TIME)


def _dq_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs appended to a history, the newer one twice, of which that one is read."""
    store = LayerStore(spark, shared_folder(spark))
    store.append_history(QUALITY_LOG, _report(spark, sf_dir))
    newer = store.history(QUALITY_LOG)
    ten_rows = spark.createDataFrame(newer.collect(), newer.schema)
    older = ten_rows.withColumns(
        {"run_time": F.expr(instant(INGEST_TIME)), "issue_count": F.lit(0).cast("long")}
    )
    store.append_history(QUALITY_LOG, older)
    store.append_history(QUALITY_LOG, ten_rows)
    return portable(quality.displayed(store.newest_run(QUALITY_LOG)))


def _order_total_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_tables(spark, sf_dir)
    headers = raw["orders"].drop("order_total")
    return portable(
        backfill_order_totals(headers, raw["order_items"]).select("order_id", "order_total")
    )


def _gold_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export all marts as CSV and sum up what can be read back."""
    folder, work, silver = shared_folder(spark), shared_folder(spark), _silver(spark, sf_dir)
    # All marts but one read the orders, whose totals come from the items; they are derived once.
    silver["orders"].select(*ORDER_COLUMNS).write.options(**PACKED).parquet(f"{work}/orders")
    opened = {t: partial(silver.__getitem__, t) for t in silver}
    opened["orders"] = partial(spark.read.parquet, f"{work}/orders")
    export_marts(_marts(with_item_sales(spark, TableSet(opened), f"{work}/{ITEM_SALES}")), folder)
    read = spark.read.option("header", True).option("escape", '"')
    totals = [mart_totals(name, read.csv(f"{folder}/{name}")) for name in MARTS]
    return portable(reduce(DataFrame.unionByName, totals))


def _pipeline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline from CSV files: one status row per layer and table, with sums of the stored marts."""
    raw_dir, root = _raw_files(spark, sf_dir, TABLES), shared_folder(spark)
    status = run_pipeline(spark, raw_dir, root, RUN_TIME, MART_OPTIONS)
    gold = LayerStore(spark, root).current("gold")
    totals = reduce(DataFrame.unionByName, [mart_totals(name, gold[name]) for name in MARTS])
    totals = totals.withColumnRenamed("mart", "table").drop("rows")
    return portable(status.select("layer", "table", "status", "rows", "rejected").join(totals, "table", "left"))


def _bronze_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns as CSV lines without quotes: a comma in the reason of some makes a cell too many."""
    folder, columns = shared_folder(spark), RAW_COLUMNS["returns"]
    raw = raw_tables(spark, sf_dir)["returns"]
    reason = F.when(F.col("refund_amount").isNull(), F.concat("reason", F.lit(", unclear"))).otherwise(F.col("reason"))
    cells = [reason if c == "reason" else F.coalesce(c, F.lit("")) for c in columns]
    lines = raw.select(F.concat_ws(",", *cells).alias(",".join(columns)))
    # A separator and a quote that occur in no line leave the lines as they are.
    lines.write.options(header=True, sep="\u0001", quote="\u0002", escape="\u0002").csv(f"{folder}/returns.csv")
    return rejected_rows(read_csv(spark, "returns", f"{folder}/returns.csv"), "returns")


def _bronze_scan_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns as CSV with line breaks, quotes and commas in the reason of some."""
    folder, raw = shared_folder(spark), raw_tables(spark, sf_dir)["returns"]
    reason = F.when(F.col("refund_amount").isNull(), F.concat("reason", F.lit(',\n"unclear"\n'))).otherwise(F.col("reason"))
    write_csv(raw.withColumn("reason", reason), f"{folder}/returns.csv")
    return scan_csv(spark, "returns", f"{folder}/returns.csv")


def entry(spark: SparkSession) -> DataFrame:
    """Revenue by category on the smallest test data."""
    return queries()["gold_revenue_by_category"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """Every registered query: ``(spark, sf_dir) -> DataFrame``."""
    found: dict[str, Query] = {}
    for name in MARTS:
        found[name] = _on_gold(lambda g, name=name: in_report_order(name, g[name]))

    for table in TABLES:
        found[f"silver_{table}"] = _on_silver(lambda t, table=table: t[table])
        found["bronze_scan" if table == "customers" else f"bronze_scan_{table}"] = _bronze_scan(
            table
        )
    for table in ("customers", "orders"):
        found[f"silver_{table}_stored"] = _on_raw(lambda r, table=table: STORED_CLEANERS[table](r[table]))
    found["silver_order_items_rejects"] = _on_raw(
        lambda r: silver_order_items_rejects(r["order_items"])
    )

    for check in quality.CHECKS:
        found[check.check_id.lower().replace("-", "_")] = _on_silver(check.violations)
    found["dq_report"] = lambda spark, sf_dir: portable(_report(spark, sf_dir))
    found["dq_summary"] = lambda spark, sf_dir: portable(
        quality.quality_summary(_report(spark, sf_dir))
    )
    found["dq_latest"] = _dq_latest
    found["dq_samples"] = _on_silver(quality.quality_samples)

    found["kpi_summary"] = _on_gold(
        lambda g: serving.kpi_summary(
            g["gold_monthly_order_summary"],
            g["gold_return_rate_by_product"],
            g["gold_customer_lifetime_value"],
        )
    )
    for name, plan, mart in [
        ("revenue_chart", serving.revenue_chart, "gold_revenue_by_category"),
        ("monthly_trend", serving.monthly_trend, "gold_monthly_order_summary"),
        ("top_customers", serving.top_customers, "gold_customer_lifetime_value"),
        ("return_rate_by_category", serving.return_rate_by_category, "gold_return_rate_by_product"),
        ("fulfillment_chart", serving.fulfillment_chart, "gold_fulfillment_summary"),
        ("orders_by_channel", serving.orders_by_channel, "gold_monthly_order_summary"),
        ("top_categories", serving.top_categories, "gold_revenue_by_category"),
        ("latest_months", serving.latest_months, "gold_monthly_order_summary"),
    ]:
        found[name] = _on_gold(lambda g, plan=plan, mart=mart: plan(g[mart]))

    found["bronze_metadata"] = _bronze_metadata
    found["bronze_scan_multiline"] = _bronze_scan_multiline
    found["bronze_rejects"] = _bronze_rejects
    found["layer_row_counts"] = _layer_row_counts
    found["load_totals"] = _load_totals
    found["silver_metrics"] = _silver_metrics
    found["silver_metrics_written"] = _silver_metrics_written
    found["gold_export"] = _gold_export
    found["pipeline_run"] = _pipeline_run
    found["order_total_backfill"] = _order_total_backfill

    found["filter_in_status"] = _on_silver(singles.earning_order_ids)
    found["join_items_products"] = _on_silver(singles.items_with_products)
    found["semi_approved_items"] = _on_silver(singles.items_of_approved_orders)
    found["dq_007_members"] = _on_silver(quality.shared_email_members)
    # Small cells, so that the test data's groups have several.
    found["dq_007_parts"] = _on_silver(lambda t: quality.shared_email_parts(t, rows=3))
    found["dq_007_lists"] = _on_silver(quality.shared_email_lists)
    found["join_return_rows"] = _on_silver(singles.return_rows_with_orders)
    found["join_returns_orders"] = _on_silver(singles.returns_with_orders)
    found["agg_count_distinct"] = _on_silver(singles.customers_per_channel)
    found["agg_conditional"] = _on_silver(singles.status_counts_per_channel)
    found["agg_rates"] = _on_silver(singles.rates_per_warehouse)
    found["distinct_approved_orders"] = _on_silver(singles.approved_orders)
    found["value_tier"] = _on_silver(
        lambda t: singles.customer_tiers(t, TIERS["high_value"], TIERS["mid_value"])
    )
    found["scalar_clean_text"] = _on_raw(lambda r: singles.cleaned_labels(r["orders"]))
    found["scalar_clean_names"] = _on_raw(lambda r: singles.cleaned_names(r["customers"]))
    found["scalar_try_parse"] = _on_raw(lambda r: singles.parsed_numbers(r["products"]))
    found["scalar_try_parse_dates"] = _on_raw(lambda r: singles.parsed_dates(r["orders"]))
    found["scalar_dates"] = _on_silver(singles.date_parts)

    if corpus_queries:
        found |= corpus_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    """The SQL counterpart of every registered query that SQL can express."""
    return answers() | (corpus_queries.SQL if corpus_queries else {})
