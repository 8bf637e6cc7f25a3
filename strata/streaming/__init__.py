"""Structured Streaming: incremental log parsing into partitioned Parquet."""
