"""Time parsing and formatting. Every timestamp column is an instant in UTC.

The helpers assume ``spark.sql.session.timeZone=UTC`` (see ``runtime.require_utc``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern: a time of day followed by Z, a zone name of UTC, or a numeric offset.
_AWARE = r"(?i)\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|UTC|GMT|[+-]\d{2}(:?\d{2})?)$"
#: The commonest of those texts, found by one look from the start.
_AWARE_ISO = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"


def has_offset(text: Column) -> Column:
    """True where the text carries its own zone."""
    return text.rlike(_AWARE_ISO) | F.trim(text).rlike(_AWARE)


def parse_instant(text: Column) -> Column:
    """Text to timestamp; offset-less text is UTC, unreadable text is null."""
    return F.try_to_timestamp(text)


def local_to_utc(local: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` to UTC; null where the zone's clock skips or repeats it."""
    utc = F.to_utc_timestamp(local, zone)
    exists = F.from_utc_timestamp(utc, zone) == local
    repeated = F.lit(False)
    for minutes in (-60, -30, 30, 60):
        other = utc + F.expr(f"INTERVAL {minutes} MINUTES")
        repeated = repeated | (F.from_utc_timestamp(other, zone) == local)
    return F.when(exists & ~repeated, utc)


def parse_market_time(text: Column, zone: str, formats: Iterable[str] = ()) -> Column:
    """Text to UTC; text without an offset is a wall-clock time in ``zone``."""
    readings = [F.try_to_timestamp(text)] + [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    parsed = F.coalesce(*readings)
    return F.when(has_offset(text), parsed).otherwise(local_to_utc(parsed, zone))


def local_date(instant: Column, zone: str) -> Column:
    return F.to_date(F.from_utc_timestamp(instant, zone))


def local_date_text(instant: Column, zone: str) -> Column:
    return F.date_format(F.from_utc_timestamp(instant, zone), "yyyy-MM-dd")


def utc_iso(instant: Column) -> Column:
    """ISO-8601 text ending in Z; the fraction appears only when it is not zero."""
    whole = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(instant), F.lit(1_000_000))
    fraction = F.when(micros == 0, F.lit("")).otherwise(F.date_format(instant, ".SSSSSS"))
    return F.concat(whole, fraction, F.lit("Z"))


def from_epoch(value: Column, is_millis: Column) -> Column:
    """Epoch number (seconds or milliseconds, fractions allowed) to timestamp."""
    micros = F.round(F.when(is_millis, value * 1e3).otherwise(value * 1e6), 0)
    return F.timestamp_micros(micros.try_cast("bigint"))
