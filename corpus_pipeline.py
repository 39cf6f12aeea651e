"""A corpus pipeline over ``documents``; STAGES and run() follow the driver's contract."""

from __future__ import annotations

from shopstrata.llm.stages import STAGES, run_stages

# SQL cannot express nearest neighbours, anchors or alignments; a test runs brute-force stages.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages applied to ``documents``, each written as Parquet and read again."""
    return run_stages(spark, sf_dir, STAGES)
