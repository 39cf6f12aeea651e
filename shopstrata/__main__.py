"""Command line: run the pipeline, export the marts, show the dashboard's figures.

    python -m shopstrata run RAW_DIR ROOT
    python -m shopstrata export ROOT CSV_DIR
    python -m shopstrata dashboard ROOT
    python -m shopstrata sweep ROOT [--keep N]

On a cluster the same module is started with spark-submit; ROOT is then on shared storage.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import SparkSession

from shopstrata.plans import quality, serving
from shopstrata.plans.marts import MARTS
from shopstrata.plans.pipeline import QUALITY_LOG, export_marts, run_pipeline
from shopstrata.plans.silver import CLEANERS
from shopstrata.session import build_session
from shopstrata.sources.layers import LayerStore


def run(spark: SparkSession, raw_dir: str, root: str, run_time: datetime | None) -> None:
    """Run all steps, then show the status of each table, the outcome of the checks, samples and rejects."""
    run_pipeline(spark, raw_dir, root, run_time).show(100, truncate=False)
    store = LayerStore(spark, root)
    store.rejects().show(20, truncate=False)
    silver = store.current("silver")
    if set(CLEANERS) <= set(silver):
        quality.quality_samples(silver).orderBy("check_id", "sample_no").show(100, truncate=False)
    newest = store.newest_run(QUALITY_LOG)
    quality.displayed(newest).show(truncate=False)
    quality.quality_summary(newest).show(truncate=False)


def export(spark: SparkSession, root: str, folder: str) -> None:
    """Write every current mart as CSV."""
    store = LayerStore(spark, root)
    with store.lease():
        gold = store.current("gold")
        export_marts({name: gold[name] for name in MARTS if name in gold}, folder)


def dashboard(spark: SparkSession, root: str) -> None:
    """Show the data behind each part of the dashboard."""
    store = LayerStore(spark, root)
    with store.lease():
        show_parts(store)


def show_parts(store: LayerStore) -> None:
    gold, newest = store.current("gold"), store.newest_run(QUALITY_LOG)
    monthly, products = gold["gold_monthly_order_summary"], gold["gold_return_rate_by_product"]
    revenue, customers = gold["gold_revenue_by_category"], gold["gold_customer_lifetime_value"]
    for part in (
        serving.kpi_summary(monthly, products, customers),
        serving.revenue_chart(revenue),
        serving.monthly_trend(monthly),
        serving.top_customers(customers),
        serving.return_rate_by_category(products),
        serving.fulfillment_chart(gold["gold_fulfillment_summary"]),
        serving.orders_by_channel(monthly),
        quality.quality_summary(newest),
        quality.displayed(newest),
    ):
        part.show(100, truncate=False)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shopstrata")
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("run", help="run the pipeline")
    one.add_argument("raw_dir")
    one.add_argument("root")
    one.add_argument("--run-time", type=datetime.fromisoformat)
    two = commands.add_parser("export", help="write the marts as CSV")
    two.add_argument("root")
    two.add_argument("folder")
    three = commands.add_parser("dashboard", help="show the dashboard's figures")
    three.add_argument("root")
    four = commands.add_parser("sweep", help="delete copies of tables that no reader needs")
    four.add_argument("root")
    four.add_argument("--keep", type=int, default=2)
    given = parser.parse_args(arguments)

    spark = build_session()
    if given.command == "run":
        run(spark, given.raw_dir, given.root, given.run_time)
    elif given.command == "export":
        export(spark, given.root, given.folder)
    elif given.command == "sweep":
        print("\n".join(LayerStore(spark, given.root).sweep(given.keep)))
    else:
        dashboard(spark, given.root)


if __name__ == "__main__":
    main()
