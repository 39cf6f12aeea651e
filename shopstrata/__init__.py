"""Commerce analytics on Spark: raw CSV -> Bronze -> Silver -> checks and Gold marts."""
