"""Structured Streaming ingestion of raw bar events."""
