"""Historical files to landing bars and their coarser timeframe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions import times
from barlake.operators.quality import assert_landing
from barlake.operators.resample import resample
from barlake.runtime import require_utc, stage, unstage
from barlake.schema import MARKET_ZONE
from barlake.sinks.layers import write_landing
from barlake.sources.history_csv import read_history

SOURCE_TIMEFRAME = "1m"


def load_summary(raw: DataFrame, output: DataFrame, path: str, timeframe: str) -> DataFrame:
    """One row: rows in and out, timeframes, time span and run id."""
    tagged = raw.withColumn("side", F.lit("in")).unionByName(
        output.withColumn("side", F.lit("out"))
    )
    out_time = F.when(F.col("side") == "out", F.col("event_time"))
    return tagged.agg(
        F.lit(path).alias("input_path"),
        F.count_if(F.col("side") == "in").alias("source_rows"),
        F.count_if(F.col("side") == "out").alias("output_rows"),
        F.lit(SOURCE_TIMEFRAME).alias("source_timeframe"),
        F.lit(timeframe).alias("output_timeframe"),
        times.utc_iso(F.min(out_time)).alias("min_event_time"),
        times.utc_iso(F.max(out_time)).alias("max_event_time"),
        F.min("ingest_run_id").alias("ingest_run_id"),
    )


def load_history(
    spark: SparkSession,
    path: str,
    output_root: str,
    symbol: str,
    timeframe: str = "15m",
    source_zone: str = MARKET_ZONE,
    ingest_run_id: str | None = None,
) -> dict[str, object]:
    """Load CSV history, write 1m bars and, if coarser, the resampled bars."""
    require_utc(spark)
    raw = stage(read_history(spark, path, symbol, source_zone, ingest_run_id), "history")
    try:
        assert_landing(raw)
        output = resample(raw, timeframe, validate=False)
        assert_landing(output)
        both = raw if timeframe == SOURCE_TIMEFRAME else raw.unionByName(output)
        write_landing(both, output_root)
        return load_summary(raw, output, path, timeframe).first().asDict()
    finally:
        unstage(spark, raw)
