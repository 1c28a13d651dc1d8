"""Table contracts: column lists, Spark schemas and the fixed values of the bar contract."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: they define the data contract and must stay exactly as written. ---
MARKET_ZONE = "Asia/Ho_Chi_Minh"
RAW_SCHEMA_VERSION = "ohlcv_raw_v1"
DLQ_SCHEMA_VERSION = "ohlcv_raw_dlq_v1"
TIMEFRAMES = ("1m", "5m", "15m", "30m")
PRICES = ("open", "high", "low", "close")
NUMERICS = PRICES + ("volume",)
BUSINESS_KEY = ("symbol", "event_time", "timeframe")
LAYER_PARTITIONS = ("symbol", "timeframe", "trading_date")
CSV_TIME_ALIASES = ("event_time", "datetime", "date", "timestamp")
PAYLOAD_ALIASES = {
    "t": ("t", "timestamp", "time"),
    "o": ("o", "open"),
    "h": ("h", "high"),
    "l": ("l", "low"),
    "c": ("c", "close"),
    "v": ("v", "volume"),
}
EPOCH_MILLIS_FROM = 100_000_000_000
EPSILON = 1e-12
SIGNAL_POSITIONS = {"LONG": 1, "SHORT": -1, "HOLD": 0, "CLOSE": 0}
EVENT_REASONS = {
    "no_object": "Kafka payload must be a JSON object",
    "missing": "Missing event fields: ",
    "version": "Unsupported schema_version: ",
    "empty": "symbol and timeframe must not be empty",
    "value": "Invalid event value: ",
    "naive": "timestamps must be timezone-aware",
    "not_finite": "OHLCV values must be finite numbers",
    "not_positive": "OHLC prices must be greater than zero",
    "bounds": "OHLC bounds are invalid",
    "volume": "volume must not be negative",
    "day": "trading_date does not match event_time",
    "key": "Kafka message key does not match the event business key",
}
# --- end of fixed values ---

TIMEFRAME_MINUTES = {name: int(name[:-1]) for name in TIMEFRAMES}


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


CANONICAL_SCHEMA = _struct(
    symbol=T.StringType(),
    event_time=T.TimestampType(),
    trading_date=T.DateType(),
    timeframe=T.StringType(),
    **{name: T.DoubleType() for name in NUMERICS},
    source=T.StringType(),
    source_record_id=T.StringType(),
    ingest_run_id=T.StringType(),
    ingested_at=T.TimestampType(),
    quality_status=T.StringType(),
)
CANONICAL_COLUMNS = tuple(CANONICAL_SCHEMA.names)

EVENT_SCHEMA = _struct(
    schema_version=T.StringType(),
    symbol=T.StringType(),
    event_time=T.StringType(),
    trading_date=T.StringType(),
    timeframe=T.StringType(),
    **{name: T.DoubleType() for name in NUMERICS},
    source=T.StringType(),
    source_record_id=T.StringType(),
    ingest_run_id=T.StringType(),
    published_at=T.StringType(),
)
EVENT_FIELDS = tuple(EVENT_SCHEMA.names)
REQUIRED_EVENT_FIELDS = tuple(name for name in EVENT_FIELDS if name != "source_record_id")

CORRUPT = "_corrupt_record"
RAW_SCHEMA = T.StructType(
    list(EVENT_SCHEMA.fields)
    + list(
        _struct(
            kafka_key=T.StringType(),
            kafka_partition=T.IntegerType(),
            kafka_offset=T.LongType(),
            consumed_at=T.StringType(),
        ).fields
    )
    + [T.StructField(CORRUPT, T.StringType(), True)]
)

LAYER_COLUMNS = EVENT_FIELDS + (
    "consumed_at",
    "kafka_key",
    "kafka_partition",
    "kafka_offset",
    "quality_status",
    "is_duplicate",
    "duplicate_count",
)

FEATURE_INPUTS = ("symbol", "event_time", "trading_date", "timeframe") + NUMERICS


class ContractError(ValueError):
    """Input rows break a table contract."""
