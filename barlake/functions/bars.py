"""Column predicates and small numeric helpers for OHLCV rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from barlake.schema import NUMERICS, PRICES, TIMEFRAMES

_INF = float("inf")


def any_of(predicates: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates)


def all_of(predicates: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates)


def is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) != F.lit(_INF))


def to_number(text: Column) -> Column:
    # The cast leaves blanks at both ends out itself.
    return text.cast("string").try_cast("double")


def _cols(names, prefix: str) -> list[Column]:
    return [F.col(prefix + name) for name in names]


def numerics_present(prefix: str = "") -> Column:
    return all_of([c.isNotNull() for c in _cols(NUMERICS, prefix)])


def numerics_known(prefix: str = "") -> Column:
    """Neither null nor NaN, which is how an unreadable number may also arrive."""
    return all_of([c.isNotNull() & ~F.isnan(c) for c in _cols(NUMERICS, prefix)])


def numerics_finite(prefix: str = "") -> Column:
    return all_of([is_finite(c) for c in _cols(NUMERICS, prefix)])


def prices_positive(prefix: str = "") -> Column:
    return all_of([c > 0 for c in _cols(PRICES, prefix)])


def high_bounds(prefix: str = "") -> Column:
    o, h, l, c = _cols(PRICES, prefix)
    return h >= F.greatest(o, c, l)


def low_bounds(prefix: str = "") -> Column:
    o, h, l, c = _cols(PRICES, prefix)
    return l <= F.least(o, c, h)


def volume_ok(prefix: str = "") -> Column:
    return F.col(prefix + "volume") >= 0


def timeframe_ok(column: Column) -> Column:
    return column.isin(*TIMEFRAMES)


def resolution_to_timeframe(resolution: Column) -> Column:
    """``5``, ``"5"`` or ``"5m"`` to ``5m``; unsupported resolutions become null."""
    minutes = F.regexp_replace(F.lower(F.trim(resolution.cast("string"))), "m$", "")
    name = F.concat(minutes, F.lit("m"))
    return F.when(timeframe_ok(name), name)
