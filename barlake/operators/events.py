"""Raw events: building, keys, decoding and the ordered event contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions import bars as B
from barlake.functions import times
from barlake.functions.frames import evaluate_once
from barlake.schema import (
    DLQ_SCHEMA_VERSION,
    EVENT_FIELDS,
    EVENT_REASONS,
    EVENT_SCHEMA,
    MARKET_ZONE,
    NUMERICS,
    RAW_SCHEMA_VERSION,
    REQUIRED_EVENT_FIELDS,
)

MALFORMED = "MalformedPayload"
VIOLATION = "ContractViolation"
_NOT_JSON = "payload is not valid JSON"


def message_key(symbol: Column, event_time: Column, timeframe: Column) -> Column:
    """``symbol|event_time|timeframe`` over the texts as they stand; null if one is null."""
    return F.concat(symbol, F.lit("|"), event_time, F.lit("|"), timeframe)


def _present(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def _filled(text: Column) -> Column:
    text = text.cast("string")
    return F.when(text != "", text)


def build_events(
    rows: DataFrame, source: str | None = None, ingest_run_id: str | None = None
) -> DataFrame:
    """Canonical or API bars to the fourteen fields of the raw event.

    ``source`` and ``ingest_run_id`` override the row's own values; without either,
    the source is ``unknown`` and the run id is drawn per row. An empty value is none.
    """
    day = times.local_date_text(F.col("event_time"), MARKET_ZONE)
    return rows.select(
        F.lit(RAW_SCHEMA_VERSION).alias("schema_version"),
        F.upper(F.trim("symbol")).alias("symbol"),
        times.utc_iso(F.col("event_time")).alias("event_time"),
        F.coalesce(_present(rows, "trading_date"), day).alias("trading_date"),
        F.trim("timeframe").alias("timeframe"),
        *[F.col(n).cast("double").alias(n) for n in NUMERICS],
        F.coalesce(_filled(F.lit(source)), _filled(_present(rows, "source")), F.lit("unknown")).alias(
            "source"
        ),
        _present(rows, "source_record_id").alias("source_record_id"),
        F.coalesce(
            _filled(F.lit(ingest_run_id)), _filled(_present(rows, "ingest_run_id")), F.uuid()
        ).alias("ingest_run_id"),
        times.utc_iso(F.current_timestamp()).alias("published_at"),
    )


def to_messages(events: DataFrame, carried: dict[str, Column] | None = None) -> DataFrame:
    """Events to ``key``/``value`` rows, with ``carried`` columns beside them.

    Null optional fields stay in the JSON.
    """
    key = message_key(F.col("symbol"), F.col("event_time"), F.col("timeframe"))
    body = F.to_json(F.struct(*EVENT_FIELDS), {"ignoreNullFields": "false"})
    more = [column.alias(name) for name, column in (carried or {}).items()]
    return events.select(key.alias("key"), body.alias("value"), *more)


_EVENT_TEXTS = ", ".join(f"{name} string" for name in EVENT_FIELDS)


def _parsed_fields() -> Column:
    """Everything the rules look at, read from ``fields`` once per message.

    Only a message with a null required field is parsed a second time, as a map,
    to tell an absent field from a null one and an object from anything else.
    """
    fields = F.col("fields")
    texts = ("schema_version", "symbol", "timeframe", "trading_date")
    gaps = B.any_of([fields[n].isNull() for n in REQUIRED_EVENT_FIELDS])
    return F.struct(
        *[fields[n].alias(n) for n in texts],
        *[B.to_number(fields[n]).alias(n) for n in NUMERICS],
        times.parse_instant(fields["event_time"]).alias("event_at"),
        times.parse_instant(fields["published_at"]).alias("published_at"),
        (times.has_offset(fields["event_time"]) & times.has_offset(fields["published_at"])).alias(
            "aware"
        ),
        message_key(fields["symbol"], fields["event_time"], fields["timeframe"]).alias("own_key"),
        F.coalesce(gaps, F.lit(True)).alias("gaps"),
        F.when(gaps, F.map_keys(F.from_json("value", "map<string,string>"))).alias("names"),
    )


def _event_error(key: Column | None) -> Column:
    """Reason of the first broken rule in contract order, or null; reads ``parsed``."""
    p = F.col("parsed")
    o, h, l, c, v = numbers = [p[n] for n in NUMERICS]

    def blank(name: str) -> Column:
        return F.coalesce(F.length(F.trim(p[name])) == 0, F.lit(True))

    def unknown(condition: Column) -> Column:
        return ~F.coalesce(condition, F.lit(False))

    readable = p["event_at"].isNotNull() & p["published_at"].isNotNull()
    day = times.local_date_text(p["event_at"], MARKET_ZONE)
    required = F.array(*[F.lit(n) for n in sorted(REQUIRED_EVENT_FIELDS)])
    missing = F.when(p["gaps"], F.array_except(required, p["names"]))
    no_object = p["gaps"] & p["names"].isNull()
    reason = {name: F.lit(text) for name, text in EVENT_REASONS.items()}
    rules = [
        (no_object & F.try_parse_json("value").isNull(), F.lit(_NOT_JSON)),
        (no_object, reason["no_object"]),
        (F.size(missing) > 0, F.concat(reason["missing"], F.array_join(missing, ", "))),
        (
            unknown(p["schema_version"] == RAW_SCHEMA_VERSION),
            F.concat(reason["version"], F.coalesce(p["schema_version"], F.lit("null"))),
        ),
        (blank("symbol") | blank("timeframe"), reason["empty"]),
        (~readable, F.concat(reason["value"], F.lit("unreadable timestamp"))),
        (unknown(p["aware"]), F.concat(reason["value"], reason["naive"])),
        (B.any_of([n.isNull() for n in numbers]), F.concat(reason["value"], F.lit("not a number"))),
        (B.any_of([~B.is_finite(n) for n in numbers]), reason["not_finite"]),
        (F.least(o, h, l, c) <= 0, reason["not_positive"]),
        ((h < F.greatest(o, c, l)) | (l > F.least(o, c, h)), reason["bounds"]),
        (v < 0, reason["volume"]),
        (unknown(p["trading_date"] == day), reason["day"]),
    ]
    if key is not None:
        rules.append((unknown(key == p["own_key"]), reason["key"]))
    return F.coalesce(*[F.when(broken, text) for broken, text in rules])


def validate_messages(messages: DataFrame, check_key: bool = True) -> DataFrame:
    """Add ``fields`` (texts), ``error_type`` and ``error`` to ``key``/``value`` rows.

    A null symbol is refused as empty. Readable JSON that is not an object and
    unreadable text are told apart by ``error_type``.
    """
    decoded = evaluate_once(messages, {"fields": F.from_json("value", _EVENT_TEXTS)})
    parsed = evaluate_once(decoded, {"parsed": _parsed_fields()})
    error = _event_error(F.col("key") if check_key else None)
    kind = F.when(F.col("error") == _NOT_JSON, MALFORMED).when(
        F.col("error").isNotNull(), VIOLATION
    )
    checked = evaluate_once(parsed, {"error": error}).drop("parsed")
    return checked.withColumn("error_type", kind)


def event_columns() -> list[Column]:
    """The fourteen event fields read from ``fields`` with their contract types."""
    return [
        (
            B.to_number(F.col("fields")[f.name])
            if f.name in NUMERICS
            else F.col("fields")[f.name]
        ).alias(f.name)
        for f in EVENT_SCHEMA.fields
    ]


def bronze_records(accepted: DataFrame) -> DataFrame:
    """Event fields plus the Kafka position, as written to the raw layer."""
    return accepted.select(
        *event_columns(),
        F.col("key").alias("kafka_key"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("bigint").alias("kafka_offset"),
        times.utc_iso(F.current_timestamp()).alias("consumed_at"),
    )


def dead_letters(invalid: DataFrame) -> DataFrame:
    """Dead-letter records; the payload stays the text that was received."""
    return invalid.select(
        F.lit(DLQ_SCHEMA_VERSION).alias("schema_version"),
        F.col("key").alias("original_key"),
        "error_type",
        "error",
        F.col("value").alias("payload"),
        times.utc_iso(F.current_timestamp()).alias("failed_at"),
    )
