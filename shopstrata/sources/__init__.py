"""Inputs and outputs: raw CSV, layered tables with a ledger, and the test-data adapter."""
