"""Readers: raw-event JSON, historical CSV, landed API payloads, Parquet layers, Kafka."""
