"""Resampling of canonical bars to coarser timeframes; gaps are never filled."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.operators.quality import assert_landing
from barlake.schema import CANONICAL_COLUMNS, TIMEFRAME_MINUTES, ContractError


def resample(
    bars: DataFrame, timeframe: str, validate: bool = True, unique_keys: bool = True
) -> DataFrame:
    """First/max/min/last/sum per ``(symbol, trading_date)`` and left-closed bin.

    Provenance is per symbol and day: source and run id of the earliest row, latest
    ``ingested_at``. The first aggregate keeps only fixed-width buffers, so it runs
    as a hash aggregate with a map-side combine; the text columns ride along as
    grouping keys. What is left, at most a row a bin and origin, is dealt out by day once,
    and both the bins and the day's provenance are settled there: two exchanges in all.

    With ``unique_keys=False`` rows may share a symbol and time, and all of them count; the
    first open is then the least at the first time, the last close the greatest at the last.
    """
    if timeframe not in TIMEFRAME_MINUTES:
        raise ContractError(f"unsupported target timeframe: {timeframe}")
    if validate:
        assert_landing(bars, unique_keys)
    if timeframe == "1m":
        return bars

    bin_start = F.window("event_time", f"{TIMEFRAME_MINUTES[timeframe]} minutes").getField("start")
    day = ("symbol", "trading_date")
    # A struct would not fit the hash aggregate; it is needed only where times may repeat.
    first = "event_time" if unique_keys else F.struct("event_time", "open")
    last = "event_time" if unique_keys else F.struct("event_time", "close")
    by_origin = (
        bars.withColumn("bin", bin_start)
        .groupBy(*day, "bin", "source", "ingest_run_id")
        .agg(
            F.min("event_time").alias("first_at"),
            F.max("event_time").alias("last_at"),
            F.min_by("open", first).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", last).alias("close"),
            F.sum("volume").alias("volume"),
            F.max("ingested_at").alias("ingested_at"),
        )
    )
    merged = by_origin.repartition(*day).groupBy(*day, "bin").agg(
        F.min_by("open", F.struct("first_at", "open")).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", F.struct("last_at", "close")).alias("close"),
        F.sum("volume").alias("volume"),
        F.min_by(F.struct("source", "ingest_run_id"), F.struct("first_at", "source", "ingest_run_id")).alias("origin"),
        F.max("ingested_at").alias("ingested_at"),
    )
    # At most one row per bin of the day is left in this window (288 for 5m).
    whole_day = Window.partitionBy(*day)
    out = merged.withColumns(
        {
            "origin": F.min_by("origin", "bin").over(whole_day),
            "ingested_at": F.max("ingested_at").over(whole_day),
        }
    ).select(
        "symbol",
        F.col("bin").alias("event_time"),
        "trading_date",
        F.lit(timeframe).alias("timeframe"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        "origin.source",
        F.lit(None).cast("string").alias("source_record_id"),
        "origin.ingest_run_id",
        "ingested_at",
        F.lit("valid").alias("quality_status"),
    )
    return out.select(*CANONICAL_COLUMNS)
