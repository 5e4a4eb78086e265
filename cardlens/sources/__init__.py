"""Inputs and outputs: the test-table adapter, CSV/Parquet sources,
guards, and sinks that count rows on the write."""
