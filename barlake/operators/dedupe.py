"""Duplicate counting and newest-row selection by business key.

A key (including the all-null key of unreadable lines) may hold a large share
of the input, so no window is partitioned by the key: counts and the newest row
come from aggregates that reduce on the map side, and counts return to the rows
through a left join whose skewed partitions adaptive execution splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.schema import BUSINESS_KEY, LAYER_COLUMNS


def key_stats(flagged: DataFrame) -> DataFrame:
    """Rows, valid rows and rejected rows per business key (nulls form keys too)."""
    valid = F.col("quality_status") == "valid"
    return flagged.groupBy(*BUSINESS_KEY).agg(
        F.count(F.lit(1)).alias("duplicate_count"),
        F.count_if(valid).alias("valid_rows"),
        F.count_if(~valid).alias("rejected_rows"),
    )


def quality_metrics(stats: DataFrame) -> DataFrame:
    """The five counters of the quality report, from per-key statistics.

    Keys with a null part are not distinct business keys, yet their repeats count
    as duplicates; ``duplicate_rows`` counts every member of a repeated key.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in BUSINESS_KEY])
    n = F.col("duplicate_count")
    total = {
        "input_rows": F.sum(n),
        "distinct_business_keys": F.count_if(complete),
        "duplicate_rows": F.sum(F.when(n > 1, n).otherwise(0)),
        "valid_rows": F.sum("valid_rows"),
        "rejected_rows": F.sum("rejected_rows"),
    }
    return stats.agg(
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(name) for name, c in total.items()]
    )


def with_duplicate_counts(flagged: DataFrame, stats: DataFrame) -> DataFrame:
    """Add ``duplicate_count`` and ``is_duplicate`` to every row.

    One left join with the counts of repeated keys, in which null parts are equal: one scan
    of the rows and one of the counts. A key's rows need not meet in one task, because each
    only looks its count up. Adaptive execution broadcasts few counts and otherwise splits
    the partition of a hot key by the measured sizes of its map outputs, at any input size.
    """
    counts = stats.filter("duplicate_count > 1").select(
        *[F.col(k).alias(f"key_{k}") for k in BUSINESS_KEY], F.col("duplicate_count").alias("n")
    )
    same_key = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"key_{k}")) for k in BUSINESS_KEY],
    )
    counted = flagged.join(counts, same_key, "left").select(*flagged.columns, "n")
    return counted.withColumns(
        {
            "duplicate_count": F.coalesce("n", F.lit(1)).cast("bigint"),
            "is_duplicate": F.coalesce("n", F.lit(1)) > 1,
        }
    ).drop("n")


def newest_per_key(flagged: DataFrame, rank_scope: str = "all") -> DataFrame:
    """The newest valid row of each key, with the key's duplicate count.

    ``rank_scope="all"`` picks the newest of all rows and then drops it if it was
    rejected, so a late bad event hides an earlier good one; ``"valid"`` picks the
    newest of the valid rows. Newest means latest ``consumed_at``, then highest
    offset, with nulls oldest; partition and a row hash settle remaining ties.
    """
    if rank_scope not in ("all", "valid"):
        raise ValueError("rank_scope must be 'all' or 'valid'")
    payload = [c for c in flagged.columns if c not in BUSINESS_KEY]
    valid = F.col("quality_status") == "valid"
    order = F.struct(
        "consumed_at", "kafka_offset", "kafka_partition", F.xxhash64(*payload).alias("h")
    )
    if rank_scope == "valid":
        order = F.when(valid, order)
    best = flagged.groupBy(*BUSINESS_KEY).agg(
        F.max_by(F.struct(*payload), order).alias("row"),
        F.count(F.lit(1)).alias("duplicate_count"),
    )
    return (
        best.select(*BUSINESS_KEY, "row.*", "duplicate_count")
        .filter(valid)
        .withColumn("is_duplicate", F.col("duplicate_count") > 1)
    )


def layer_projection(rows: DataFrame) -> DataFrame:
    return rows.select(*LAYER_COLUMNS)
