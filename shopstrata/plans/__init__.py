"""Silver cleaners, quality checks, Gold marts, serving reads, and the pipeline."""
