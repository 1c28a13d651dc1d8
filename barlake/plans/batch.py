"""Raw JSON lines to Bronze, Silver and the quality report."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

from barlake.functions import times
from barlake.operators import dedupe, quality
from barlake.runtime import require_utc, stage, unstage
from barlake.schema import MARKET_ZONE, ContractError
from barlake.sinks import layers
from barlake.sources.raw_events import read_raw_events


def run_batch(
    spark: SparkSession,
    raw: str,
    bronze: str,
    silver: str,
    report: str,
    run_id: str | None = None,
    zone: str = MARKET_ZONE,
    rank_scope: str = "all",
    reject_non_finite: bool = True,
) -> Row:
    """Write every event to Bronze, the newest valid row per key to Silver, and the report, which is returned.

    JSON is parsed once into a stored columnar table; the per-key statistics, which
    feed both the report and Bronze, read only its key columns. Without a run id the
    start of the run names it.
    """
    require_utc(spark)
    started = datetime.now(timezone.utc)
    flagged = stage(quality.flag_events(read_raw_events(spark, raw), zone, reject_non_finite), "events")
    stats = stage(dedupe.key_stats(flagged), "key-stats")
    counters = stage(
        dedupe.quality_metrics(stats).select(
            F.lit(run_id or f"{started:batch-%Y-%m-%d-%H%M%S-%f}").alias("run_id"),
            times.utc_iso(F.lit(started)).alias("generated_at"),
            F.lit(raw).alias("input_root"),
            "*",
        ),
        "report",
    )
    try:
        found = counters.first()
        if not found["input_rows"]:
            raise ContractError(f"input contains no events: {raw}")
        every = dedupe.with_duplicate_counts(flagged, stats)
        layers.write_layer(dedupe.layer_projection(every), bronze)
        newest = dedupe.newest_per_key(flagged, rank_scope)
        layers.write_layer(dedupe.layer_projection(newest), silver)
        layers.write_report(counters, report)
        return found
    finally:
        unstage(spark, flagged, stats, counters)
