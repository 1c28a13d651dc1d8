"""Landed market-data API responses to bars.

One input row is one response: ``payload`` (JSON text), ``symbol``, ``resolution``.
A payload is either an object of parallel arrays or a list of records, optionally
under ``data``. Rules hold for the response as a whole, as arrays of one row, so
normalising needs no shuffle; a rejected response contributes no bars.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions import bars as B
from barlake.functions import times
from barlake.functions.frames import evaluate_once
from barlake.schema import EPOCH_MILLIS_FROM, MARKET_ZONE, NUMERICS, PAYLOAD_ALIASES

_FIELDS = dict(zip("tohlcv", ("event_time", *NUMERICS)))
_NAMES = [alias for aliases in PAYLOAD_ALIASES.values() for alias in aliases]
_ARRAYS = ", ".join(f"{name} array<string>" for name in _NAMES)
_RECORDS = f"array<struct<{', '.join(f'{name}:string' for name in _NAMES)}>>"


def _field(field: str) -> Column:
    """Text values of one field: the first alias present, even as null, for either shape.

    In a record list the first record decides which alias counts.
    """
    shape = F.when(F.col("is_list"), F.lit("records")).otherwise(F.lit("arrays"))
    value = F.lit(None).cast("array<string>")
    for name in reversed(PAYLOAD_ALIASES[field]):
        here = F.when(shape == "records", F.col(f"records.{name}")).otherwise(F.col(f"arrays.{name}"))
        value = F.when(F.array_contains("names", name), here).otherwise(value)
    return value


def parse_payloads(responses: DataFrame) -> DataFrame:
    """Add ``timeframe``, ``error`` and ``bars`` (array of structs) to each response."""
    body = F.coalesce(F.get_json_object("payload", "$.data"), F.col("payload"))
    shaped = responses.withColumn("body", F.trim(body)).withColumns(
        {
            "is_list": F.startswith(F.trim(body), F.lit("[")),
        }
    )
    # Only the shape that the first character shows is parsed.
    one = F.when(F.col("is_list"), F.get_json_object("body", "$[0]")).otherwise(F.col("body"))
    shaped = evaluate_once(
        shaped,
        {
            "arrays": F.from_json(F.when(~F.col("is_list"), F.col("body")), _ARRAYS),
            "records": F.from_json(F.when(F.col("is_list"), F.col("body")), _RECORDS),
            "names": F.json_object_keys(one),
        },
    )
    has_volume = F.arrays_overlap("names", F.array(*[F.lit(n) for n in PAYLOAD_ALIASES["v"]]))
    found = evaluate_once(
        shaped,
        {f: _field(f) for f in _FIELDS}
        | {
            "has_volume": F.coalesce(has_volume, F.lit(False)),
            "is_json": F.get_json_object("body", "$").isNotNull(),
            "is_empty": F.col("is_list") & (F.size("records") == 0),
            "timeframe": B.resolution_to_timeframe(F.col("resolution")),
        },
    )
    # Without volumes they are zero; a volume field that is there must hold numbers.
    stand_in = F.when(~F.col("has_volume"), F.lit("0.0"))
    volume = F.coalesce("v", F.transform("t", lambda _: stand_in))
    seconds = F.transform("t", B.to_number)
    bars = evaluate_once(
        found.withColumn("v", volume).withColumn("seconds", seconds),
        {
            "numeric_time": F.forall("seconds", lambda x: x.isNotNull()),
            "millis": F.array_max(F.transform("seconds", F.abs)) >= EPOCH_MILLIS_FROM,
            "zipped": F.arrays_zip("t", "seconds", "o", "h", "l", "c", "v"),
        },
    )

    def bar(z: Column) -> Column:
        stamp = F.when(
            F.col("numeric_time"), times.from_epoch(z["seconds"], F.col("millis"))
        ).otherwise(times.parse_instant(z["t"]))
        return F.struct(
            stamp.alias("event_time"), *[B.to_number(z[f]).alias(_FIELDS[f]) for f in "ohlcv"]
        )

    checked = evaluate_once(bars, {"bars": F.transform("zipped", bar)})
    checked = evaluate_once(checked, {"rule": F.array_min(F.transform("bars", _broken_rule))})
    error = _payload_error()
    return checked.select(*responses.columns, "timeframe", error.alias("error"), "bars")


# Reasons per bar, in the order in which the rules are reported.
_BAR_RULES = (
    "invalid timestamp",
    "non-numeric values",
    "non-finite values",
    "negative volume",
    "OHLC bounds are violated",
)


def _broken_rule(b: Column) -> Column:
    """Index of the first rule in ``_BAR_RULES`` that the bar breaks, or null."""
    o, h, l, c = (b[n] for n in ("open", "high", "low", "close"))
    numbers = [b[n] for n in NUMERICS]
    broken = [
        b["event_time"].isNull(),
        B.any_of([n.isNull() for n in numbers]),
        B.any_of([~B.is_finite(n) for n in numbers]),
        b["volume"] < 0,
        (h < F.greatest(o, c, l)) | (l > F.least(o, c, h)),
    ]
    return F.coalesce(*[F.when(bad, F.lit(n)) for n, bad in enumerate(broken)])


def _payload_error() -> Column:
    """First broken rule of the response, or null."""
    missing = F.array_compact(
        F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in ("c", "h", "l", "o", "t")])
    )
    sizes = [F.size(f) for f in _FIELDS]
    uneven = B.any_of([s != sizes[0] for s in sizes[1:]])
    stamps = F.col("bars.event_time")
    filled = ~F.coalesce(F.col("is_empty"), F.lit(False))
    reasons = F.array(*[F.lit(r) for r in _BAR_RULES])
    return (
        F.when(F.col("timeframe").isNull(), "unsupported resolution")
        .when(F.length(F.trim("symbol")) == 0, "symbol must not be empty")
        .when(~F.col("is_json"), "payload is not valid JSON")
        .when(
            filled & (F.size(missing) > 0),
            F.concat(F.lit("missing fields: "), F.array_join(missing, ", ")),
        )
        .when(filled & uneven, "arrays have inconsistent lengths")
        .when(F.col("rule").isNotNull(), F.get(reasons, F.col("rule")))
        .when(F.size(F.array_distinct(stamps)) < F.size(stamps), "duplicate timestamps")
    )


def payload_bars(parsed: DataFrame, source: str, record_prefix: str) -> DataFrame:
    """Bars of the accepted responses in time order each, with provenance named by the caller."""
    symbol = F.upper(F.trim("symbol"))
    # Time is a bar's first field.
    accepted = F.array_sort(F.when(F.col("error").isNull(), F.col("bars")))
    exploded = parsed.select(
        symbol.alias("symbol"), "timeframe", F.inline_outer(accepted)
    ).filter("event_time IS NOT NULL")
    stamp = F.regexp_replace(times.utc_iso(F.col("event_time")), "Z$", "+00:00")
    return exploded.select(
        "symbol",
        "event_time",
        times.local_date(F.col("event_time"), MARKET_ZONE).alias("trading_date"),
        "timeframe",
        *NUMERICS,
        F.lit(source).alias("source"),
        F.concat_ws(":", F.lit(record_prefix), F.col("symbol"), stamp).alias("source_record_id"),
    )


def rejected_payloads(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNotNull()).drop("bars")
