"""Parquet layers (landing, bronze, silver, gold)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Partition values are directory names; typing them keeps symbols such as "007" text.
_PARTITION_TYPES = {
    "symbol": T.StringType(),
    "timeframe": T.StringType(),
    "trading_date": T.DateType(),
    "ingest_run_id": T.StringType(),
    "feature_set_version": T.StringType(),
}


def read_layer(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Scan a partitioned layer; filters on partition columns prune directories."""
    fields = [
        T.StructField(f.name, _PARTITION_TYPES.get(f.name, f.dataType), True) for f in schema.fields
    ]
    return spark.read.schema(T.StructType(fields)).parquet(root)


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    """Silver bars with the columns the feature build needs."""
    numbers = ("open", "high", "low", "close", "volume")
    schema = T.StructType(
        [T.StructField("event_time", T.TimestampType())]
        + [T.StructField(n, T.DoubleType()) for n in numbers]
        + [T.StructField(n, _PARTITION_TYPES[n]) for n in ("symbol", "timeframe", "trading_date")]
    )
    return read_layer(spark, root, schema).select(
        "symbol", "event_time", "trading_date", "timeframe", *[F.col(n) for n in numbers]
    )
