"""Writers: partitioned Parquet layers, the quality report, keyed JSON events."""
