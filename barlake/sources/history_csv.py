"""Historical CSV files to canonical one-minute bars."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.functions import bars as B
from barlake.functions import times
from barlake.runtime import stage
from barlake.schema import (
    CANONICAL_COLUMNS,
    CSV_TIME_ALIASES,
    MARKET_ZONE,
    NUMERICS,
    ContractError,
)

SOURCE_NAME = "historical_csv"


def resolve_columns(header: list[str]) -> dict[str, str]:
    """Canonical name to header name; trimmed, case-insensitive, first alias wins."""
    found = {name.strip().lower(): name for name in header}
    wanted = {"event_time": CSV_TIME_ALIASES} | {name: (name,) for name in NUMERICS}
    out = {}
    for target, aliases in wanted.items():
        match = next((found[a] for a in aliases if a in found), None)
        if match is None:
            raise ContractError(f"missing required column; expected one of {aliases}")
        out[target] = match
    return out


def content_run_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(file, ingest_run_id)``: a run id made from the lines of each file and their order.

    Every line is hashed with its place in the file; sums of those hashes do not depend on
    how the file is split, so files of any size take the same way through many tasks.
    """
    lines = spark.read.text(path).select(
        F.xxhash64("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("seq"),
    )
    placed = _number_rows(stage(lines, "csv-lines")).select("file", F.xxhash64("row", "line").alias("h"))
    sums = placed.groupBy("file").agg(
        F.sha2(
            F.concat_ws("|", F.count("h"), F.bit_xor("h"), F.sum(F.col("h").cast("decimal(20,0)"))), 256
        ).alias("digest")
    )
    run_id = F.concat(F.lit("csv_"), F.substring("digest", 1, 16))
    return sums.select("file", run_id.alias("ingest_run_id"))


def _number_rows(rows: DataFrame) -> DataFrame:
    """Add ``row``, the zero-based position in the file.

    A file may span many splits. A split is read by one task, where ``seq`` counts without
    gaps, so only the first ``seq`` and the size of each split are needed. ``rows`` must be
    a stored table, so that both reads see the same ``split`` and ``seq``.
    """
    sizes = rows.groupBy("file", "split").agg(
        F.count(F.lit(1)).alias("n"), F.min("seq").alias("first")
    )
    earlier = (
        Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sizes.select(
        "file", "split", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")
    )
    numbered = rows.join(starts, ["file", "split"])
    return numbered.withColumn("row", F.col("start") + F.col("seq") - F.col("first")).drop(
        "first", "start", "seq", "split"
    )


def read_history(
    spark: SparkSession,
    path: str,
    symbol: str,
    source_zone: str = MARKET_ZONE,
    ingest_run_id: str | None = None,
    time_formats: Iterable[str] = (),
) -> DataFrame:
    """Canonical ``1m`` bars of one CSV file or of a directory of equal headers.

    A file of the directory whose header differs is refused when it is read.
    Times without an offset are wall-clock times in ``source_zone``. Unreadable
    times raise, naming up to five rows; unreadable numbers become null and fail
    the table contract later.
    """
    reader = spark.read.option("header", "true").option("enforceSchema", "false")
    raw = reader.csv(path)
    names = resolve_columns(raw.columns)
    picked = raw.select(
        *[F.col(f"`{source}`").alias(target) for target, source in names.items()],
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("seq"),
    )
    numbered = _number_rows(stage(picked, "csv-rows"))
    parsed = numbered.withColumns(
        {
            "event_text": F.col("event_time"),
            "event_time": times.parse_market_time(
                F.col("event_time"), source_zone, time_formats
            ),
            **{n: B.to_number(F.col(n)) for n in NUMERICS},
        }
    )
    bad = parsed.filter("event_time IS NULL").orderBy("row").limit(5).select("row").collect()
    if bad:
        raise ContractError(f"invalid event_time at rows {[r['row'] for r in bad]}")
    if ingest_run_id is None:
        parsed = parsed.join(content_run_ids(spark, path), "file")
    else:
        parsed = parsed.withColumn("ingest_run_id", F.lit(ingest_run_id))
    return parsed.select(
        F.lit(symbol).alias("symbol"),
        "event_time",
        times.local_date(F.col("event_time"), MARKET_ZONE).alias("trading_date"),
        F.lit("1m").alias("timeframe"),
        *NUMERICS,
        F.lit(SOURCE_NAME).alias("source"),
        F.col("row").cast("string").alias("source_record_id"),
        "ingest_run_id",
        F.current_timestamp().alias("ingested_at"),
        F.lit("valid").alias("quality_status"),
    ).select(*CANONICAL_COLUMNS)
