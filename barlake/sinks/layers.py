"""Partitioned Parquet layers and the quality report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.schema import FEATURE_INPUTS, LAYER_PARTITIONS, ContractError


def _write_dynamic(df: DataFrame, root: str, partitions: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``.

    Rows are rebalanced by partition value, so a small partition gets one file and
    AQE splits a partition that holds much of the table over several tasks. Every file
    is in time order.
    """
    (
        df.hint("rebalance", *partitions)
        .sortWithinPartitions(*partitions, "event_time")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(root)
    )


def write_layer(df: DataFrame, root: str) -> None:
    """Bronze or Silver rows, replaced per symbol, timeframe and day."""
    _write_dynamic(df, root, LAYER_PARTITIONS)


def write_landing(df: DataFrame, root: str) -> None:
    """Canonical bars; loading the same run again replaces that run's files only.

    The run id stays as it is; the folder is named by a column of its own, whose value
    Spark escapes, so that no two runs share one.
    """
    _write_dynamic(_named(df, "run", "ingest_run_id"), root, (*LAYER_PARTITIONS, "run"))


def _named(df: DataFrame, folder: str, column: str) -> DataFrame:
    prefix = F.lit(f"{folder}-")
    return df.withColumn(folder, F.coalesce(F.concat(prefix, F.col(column)), F.lit("none")))


def write_gold(df: DataFrame, root: str) -> None:
    """Feature rows; each feature-set version replaces its own partitions only."""
    needed = {*FEATURE_INPUTS, "feature_set_version", "available_at", "feature_status"}
    missing = sorted(needed - set(df.columns))
    if missing:
        raise ContractError(f"missing feature output columns: {missing}")
    named = _named(df, "version", "feature_set_version")
    _write_dynamic(named, root, ("version", *LAYER_PARTITIONS))


def write_report(report: DataFrame, root: str) -> None:
    """One-row quality report as Parquet, JSON and indented summary text."""
    report.write.mode("overwrite").parquet(f"{root}/parquet")
    report.write.mode("overwrite").json(f"{root}/json")
    pretty = F.to_json(F.struct("*"), {"pretty": "true"}).alias("value")
    report.coalesce(1).select(pretty).write.mode("overwrite").text(f"{root}/summary")
