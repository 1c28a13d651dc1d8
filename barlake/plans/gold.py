"""Silver bars to Gold features."""

from __future__ import annotations

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from barlake.operators.features import FEATURE_COLUMNS, FeatureConfig, build_features
from barlake.runtime import require_utc
from barlake.sinks.layers import write_gold
from barlake.sources.lake import read_silver


def build_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    config: FeatureConfig = FeatureConfig(),
) -> dict[str, object]:
    """Build and write the features of a Silver layer; return row counts."""
    require_utc(spark)
    counts = Observation("gold")
    built = build_features(read_silver(spark, silver_root), config)
    ready = F.col("feature_status") == "ready"
    observed = built.observe(
        counts, F.count(F.lit(1)).alias("rows"), F.count_if(ready).alias("ready_rows")
    )
    write_gold(observed, gold_root)
    rows, ready_rows = counts.get["rows"], counts.get["ready_rows"]
    return {
        "rows": rows,
        "feature_count": len(FEATURE_COLUMNS),
        "ready_rows": ready_rows,
        "warmup_rows": rows - ready_rows,
    }
