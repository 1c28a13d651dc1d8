"""Row quality flag of the batch job and the whole-table contract checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions import bars, times
from barlake.schema import (
    BUSINESS_KEY,
    CANONICAL_COLUMNS,
    CORRUPT,
    FEATURE_INPUTS,
    MARKET_ZONE,
    NUMERICS,
    RAW_SCHEMA_VERSION,
    ContractError,
)


def event_is_valid(zone: str = MARKET_ZONE, reject_non_finite: bool = True) -> Column:
    """One boolean per raw event with parsed ``event_ts`` and ``published_ts``.

    NaN and Infinity are refused by default because the contract asks for finite
    numbers; ``reject_non_finite=False`` leaves them to the ordinary comparisons.
    """
    rules = [
        F.col(CORRUPT).isNull(),
        F.col("schema_version") == RAW_SCHEMA_VERSION,
        F.length(F.trim("symbol")) > 0,
        F.col("event_ts").isNotNull(),
        F.col("published_ts").isNotNull(),
        F.col("trading_date") == times.local_date_text(F.col("event_ts"), zone),
        bars.timeframe_ok(F.col("timeframe")),
        bars.numerics_present(),
        bars.prices_positive(),
        bars.volume_ok(),
        bars.high_bounds(),
        bars.low_bounds(),
        F.col("source").isNotNull(),
        F.col("ingest_run_id").isNotNull(),
    ]
    if reject_non_finite:
        rules.append(bars.numerics_finite())
    return F.coalesce(bars.all_of(rules), F.lit(False))


def flag_events(
    raw: DataFrame, zone: str = MARKET_ZONE, reject_non_finite: bool = True
) -> DataFrame:
    """Add parsed times and ``quality_status`` to raw events; narrow, no shuffle."""
    if CORRUPT not in raw.columns:
        raw = raw.withColumn(CORRUPT, F.lit(None).cast("string"))
    parsed = raw.withColumns(
        {
            "event_ts": times.parse_instant(F.col("event_time")),
            "published_ts": times.parse_instant(F.col("published_at")),
            "consumed_ts": times.parse_instant(F.col("consumed_at")),
        }
    )
    status = F.when(event_is_valid(zone, reject_non_finite), "valid").otherwise("rejected")
    return (
        parsed.withColumn("quality_status", status)
        .withColumns(
            {
                "event_time": F.col("event_ts"),
                "published_at": F.col("published_ts"),
                "consumed_at": F.col("consumed_ts"),
                "trading_date": F.try_to_date("trading_date"),
            }
        )
        .drop("event_ts", "published_ts", "consumed_ts", CORRUPT)
    )


Rule = tuple[str, Column]
DUPLICATE_KEY = "duplicate business key"


def _null_key() -> Rule:
    parts = [F.col(name).isNull() for name in BUSINESS_KEY]
    return ("business key must not be null", bars.any_of(parts))


def _shared_rules() -> dict[str, Rule]:
    return {
        "null": ("OHLCV contains null or non-numeric values", ~bars.numerics_known()),
        "finite": ("OHLCV contains non-finite values", ~bars.numerics_finite()),
        "positive": ("OHLC prices must be greater than zero", ~bars.prices_positive()),
        "volume": ("volume must not be negative", ~bars.volume_ok()),
        "high": ("high is below open, close or low", ~bars.high_bounds()),
        "low": ("low is above open, close or high", ~bars.low_bounds()),
    }


def landing_rules() -> list[Rule]:
    """Canonical table rules in report order; the key rule comes first."""
    shared = _shared_rules()
    return [
        (DUPLICATE_KEY, F.lit(False)),
        ("event_time must not be null", F.col("event_time").isNull()),
        (
            "unsupported timeframe",
            ~F.coalesce(bars.timeframe_ok(F.col("timeframe")), F.lit(False)),
        ),
        *(shared[name] for name in ("null", "finite", "positive", "volume", "high", "low")),
        _null_key(),
    ]


def silver_rules() -> list[Rule]:
    """Feature input rules in report order; dates are checked in the market zone."""
    shared = _shared_rules()
    expected = times.local_date(F.col("event_time"), MARKET_ZONE)
    return [
        ("event_time must not be null", F.col("event_time").isNull()),
        ("trading_date does not match event_time", ~F.col("trading_date").eqNullSafe(expected)),
        shared["null"],
        (DUPLICATE_KEY, F.lit(False)),
        *(shared[name] for name in ("positive", "volume", "high", "low")),
        _null_key(),
    ]


def contract_report(
    df: DataFrame, rules: Sequence[Rule], key: Sequence[str] = BUSINESS_KEY
) -> DataFrame:
    """One row: ``total_rows``, ``duplicate_keys`` and the ordinal of the first broken rule.

    Each row carries only its key and one small integer into the shuffle, and a
    repeated key is reduced to one row on the map side. Without the key rule among ``rules``
    repeated keys are counted, but break nothing.
    """
    names = [name for name, _ in rules]
    key_rank = names.index(DUPLICATE_KEY) if DUPLICATE_KEY in names else None
    first_bad = F.coalesce(
        *[F.when(F.coalesce(bad, F.lit(False)), F.lit(n)) for n, (_, bad) in enumerate(rules)]
    )
    per_key = (
        df.select(*key, first_bad.alias("bad"))
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"), F.min("bad").alias("bad"))
    )
    repeated = F.when(F.col("n") > 1, F.lit(key_rank).cast("int"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.min(F.least("bad", repeated)).alias("first_broken_rule"),
    )


def _assert(df: DataFrame, columns: Sequence[str], rules: Sequence[Rule], label: str, unique_keys: bool) -> int:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ContractError(f"{label}: missing columns {missing}")
    if not unique_keys:
        rules = [rule for rule in rules if rule[0] != DUPLICATE_KEY]
    report = contract_report(df, rules).first()
    if report["total_rows"] == 0:
        raise ContractError(f"{label}: input is empty")
    if report["first_broken_rule"] is not None:
        raise ContractError(f"{label}: {rules[report['first_broken_rule']][0]}")
    return report["total_rows"]


def assert_landing(df: DataFrame, unique_keys: bool = True) -> int:
    """Raise on the first broken rule of the canonical table; return its row count.

    ``unique_keys=False`` is for rows of which several may share a time; every other rule holds.
    """
    return _assert(df, CANONICAL_COLUMNS, landing_rules(), "canonical bars", unique_keys)


def assert_silver(df: DataFrame, unique_keys: bool = True) -> int:
    """Raise on the first broken rule of the feature input; return its row count."""
    return _assert(df, FEATURE_INPUTS, silver_rules(), "silver bars", unique_keys)


def as_feature_input(df: DataFrame) -> DataFrame:
    """Cast feature inputs to their contract types; unreadable values become null."""
    missing = [name for name in FEATURE_INPUTS if name not in df.columns]
    if missing:
        raise ContractError(f"silver bars: missing columns {missing}")
    casts = {name: F.col(name).try_cast("double") for name in NUMERICS}
    casts["event_time"] = F.col("event_time").try_cast("timestamp")
    casts["trading_date"] = F.col("trading_date").try_cast("date")
    return df.withColumns(casts)


def duplicate_keys(df: DataFrame, key: Sequence[str] = BUSINESS_KEY) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("duplicate_count"))
        .filter(F.col("duplicate_count") > 1)
    )
