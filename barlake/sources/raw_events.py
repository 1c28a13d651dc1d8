"""Raw-event JSON lines written by the ingestion stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlake.schema import CORRUPT, RAW_SCHEMA


def read_raw_events(spark: SparkSession, root: str) -> DataFrame:
    """Fixed-schema scan of a JSONL tree; unreadable lines keep their text in
    ``_corrupt_record``. Partition directories are not interpreted: the same
    fields are in every record. A missing root raises Spark's path error.
    """
    return (
        spark.read.schema(RAW_SCHEMA)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", "true")
        .json(root)
    )
