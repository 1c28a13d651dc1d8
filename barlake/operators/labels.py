"""Training labels, time splits, gaps between bars and the contract of signals.

Labels look ahead, so they are a table of their own and no input of features.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions import bars as B
from barlake.operators.quality import DUPLICATE_KEY, Rule
from barlake.operators.series import SERIES, with_position
from barlake.schema import BUSINESS_KEY, MARKET_ZONE, SIGNAL_POSITIONS, TIMEFRAME_MINUTES

SIGNAL_KEY = ("pipeline_run_id", "strategy_name", *BUSINESS_KEY)


def forward_labels(
    bars: DataFrame, horizon: int, threshold: float, version: str = "labels_v1"
) -> DataFrame:
    """Return over the next ``horizon`` bars of the series and its class; null at the end.

    A bar meets the later one by its position, which is unique in a series, so that a
    long series is spread over as many tasks as any other rows.
    """
    if horizon <= 0 or threshold < 0:
        raise ValueError(f"no labels for horizon {horizon} and threshold {threshold}")
    placed = with_position(bars)
    later = placed.select(
        *[F.col(name).alias(f"_{name}") for name in SERIES],
        (F.col("pos") - horizon).alias("_pos"),
        F.col("close").alias("_close"),
    )
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in SERIES]
    joined = placed.join(later, [*same, F.col("pos") == F.col("_pos")], "left")
    gain = F.col("_close") / F.col("close") - 1
    return joined.select(
        *BUSINESS_KEY,
        "trading_date",
        F.lit(horizon).cast("bigint").alias("horizon_bars"),
        F.lit(float(threshold)).alias("threshold"),
        gain.alias("future_return"),
        F.when(gain > threshold, "LONG")
        .when(gain < -threshold, "SHORT")
        .when(gain.isNotNull(), "HOLD")
        .alias("label"),
        F.lit(version).alias("label_version"),
    )


def time_split(at: Column, train_until: str, validate_until: str) -> Column:
    """``train``, ``validation`` or ``test`` by time alone; both limits are exclusive."""
    return (
        F.when(at < F.lit(train_until).cast("timestamp"), "train")
        .when(at < F.lit(validate_until).cast("timestamp"), "validation")
        .when(at.isNotNull(), "test")
    )


def _time_at(rows: DataFrame, at: str, wanted: list[int]) -> list:
    """For each of ``wanted`` the least time through which so many rows lie; no global sort.

    Counts by day are combined before their shuffle; only the days in which a border falls
    are counted again by exact time.
    """
    day = F.date_trunc("day", F.col(at))
    days = sorted(tuple(r) for r in rows.groupBy(day.alias("d")).agg(F.count(F.lit(1))).collect())
    out = []
    for rank in wanted:
        before = 0
        for start, n in days:
            if before + n >= rank:
                break
            before += n
        inside = rows.where(day == F.lit(start)).groupBy(at).agg(F.count(F.lit(1)).alias("n"))
        running = inside.select(at, F.sum("n").over(Window.orderBy(at)).alias("through"))
        out.append(running.where(F.col("through") >= rank - before).agg(F.min(at)).first()[0])
    return out


def quantile_split(rows: DataFrame, at: str = "event_time", shares: tuple[float, float] = (0.6, 0.2)) -> DataFrame:
    """``rows`` with ``split`` by time order: train, then validation, the rest test.

    For when no dates are given. Rows of one time are never parted: a border is the least
    time through which the share's rows lie. Rows without a time have no split; an empty
    table stays empty. The borders are two values, read from a day histogram (one row a day)
    and the exact times of two days.
    """
    if min(shares) <= 0 or sum(shares) >= 1:
        raise ValueError(f"no split by shares {shares}")
    timed = rows.where(F.col(at).isNotNull()).select(at)
    total = timed.count()
    if not total:
        return rows.withColumn("split", F.lit(None).cast("string"))
    ranks = [max(1, math.ceil(round(total * share, 6))) for share in (shares[0], sum(shares))]
    first, second = _time_at(timed, at, ranks)
    split = (
        F.when(F.col(at) <= F.lit(first), "train")
        .when(F.col(at) <= F.lit(second), "validation")
        .when(F.col(at).isNotNull(), "test")
    )
    return rows.withColumn("split", split)


def _minutes(timeframe: Column) -> Column:
    pairs = [F.lit(x) for pair in TIMEFRAME_MINUTES.items() for x in pair]
    return F.create_map(*pairs)[timeframe]


def _bin(at: Column, minutes: Column) -> Column:
    return F.expr("unix_seconds(event_time)") - F.pmod(F.expr("unix_seconds(event_time)"), minutes * 60)


def gap_report(bars: DataFrame) -> DataFrame:
    """Per series and day: bins with a bar, bins from the first to the last, and the missing.

    One aggregate that combines before its shuffle; bars of other timeframes are left out.
    """
    day = (*SERIES, "trading_date")
    minutes = _minutes(F.col("timeframe"))
    bins = bars.where(minutes.isNotNull()).select(*day, _bin(F.col("event_time"), minutes).alias("bin")).distinct()
    span = F.max("bin") - F.min("bin")
    counted = bins.groupBy(*day).agg(F.count("bin").alias("present"), span.alias("span"))
    expected = (F.col("span") / (minutes * 60) + 1).cast("bigint")
    return counted.select(
        *day, "present", expected.alias("expected"), (expected - F.col("present")).alias("missing")
    )


def missing_bars(bars: DataFrame) -> DataFrame:
    """Start of every bin without a bar between a day's first and last one."""
    day = (*SERIES, "trading_date")
    minutes = _minutes(F.col("timeframe"))
    bins = bars.where(minutes.isNotNull()).select(*day, _bin(F.col("event_time"), minutes).alias("bin")).distinct()
    ends = bins.groupBy(*day).agg(F.min("bin").alias("low"), F.max("bin").alias("high"))
    step = (_minutes(F.col("timeframe")) * 60).cast("bigint")
    every = ends.select(*day, F.explode(F.sequence("low", "high", step)).alias("bin"))
    return every.join(bins, [*day, "bin"], "left_anti").select(
        *day, F.timestamp_seconds("bin").alias("event_time")
    )


#: Share of a series' days on which a bin must have a bar to belong to its session.
SESSION_SHARE = 0.5


def _day_bins(bars: DataFrame, zone: str) -> DataFrame:
    """Distinct (series, trading_date, minute of the local day at which a bin starts)."""
    minutes = _minutes(F.col("timeframe"))
    local = F.from_utc_timestamp(F.col("event_time"), zone)
    minute = F.hour(local) * 60 + F.minute(local)
    rows = bars.where(minutes.isNotNull() & F.col("event_time").isNotNull())
    return rows.select(*SERIES, "trading_date", (minute - F.pmod(minute, minutes)).cast("int").alias("minute")).distinct()


def session_calendar(bars: DataFrame, zone: str = MARKET_ZONE, share: float = SESSION_SHARE) -> DataFrame:
    """Per series the bins of its sessions: those with a bar on at least ``share`` of its days.

    Learned by two aggregates that combine before their shuffle, so breaks, and bars that
    stray outside the hours of trading, are no part of a session.
    """
    bins = _day_bins(bars, zone)
    days = bins.groupBy(*SERIES).agg(F.count_distinct("trading_date").alias("days"))
    held = bins.groupBy(*SERIES, "minute").agg(F.count(F.lit(1)).alias("held"))
    same = [F.col(f"h.{c}").eqNullSafe(F.col(f"d.{c}")) for c in SERIES]
    both = held.alias("h").join(days.alias("d"), same).where(F.col("held") >= share * F.col("days"))
    return both.select(*[F.col(f"h.{c}").alias(c) for c in SERIES], "minute", "held", "days")


def missing_in_sessions(bars: DataFrame, zone: str = MARKET_ZONE, share: float = SESSION_SHARE) -> DataFrame:
    """Start of every session bin without a bar, on each day the series has any bar.

    Bins of a break are not missing; a bin lost in a session is, also at its ends. The days of
    a series meet its session's bins by an equality join, at most one row a bin of a day.
    """
    bins = _day_bins(bars, zone)
    calendar = session_calendar(bars, zone, share).drop("held", "days")
    days = bins.select(*SERIES, "trading_date").distinct()
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"c.{c}")) for c in SERIES]
    every = days.alias("d").join(calendar.alias("c"), same).select(*[f"d.{c}" for c in (*SERIES, "trading_date")], "minute")
    keys = (*SERIES, "trading_date", "minute")
    there = [F.col(f"e.{c}").eqNullSafe(F.col(f"b.{c}")) for c in keys]
    lost = every.alias("e").join(bins.alias("b"), there, "left_anti")
    local = F.timestamp_seconds(F.unix_seconds(F.col("trading_date").cast("timestamp")) + F.col("minute") * 60)
    return lost.select(*SERIES, "trading_date", F.to_utc_timestamp(local, zone).alias("event_time"))


def signal_rules() -> list[Rule]:
    """Rules of the signals table in report order, for ``contract_report`` by ``SIGNAL_KEY``."""
    wanted = F.create_map(*[F.lit(x) for pair in SIGNAL_POSITIONS.items() for x in pair])
    keys = [F.col(name).isNull() for name in SIGNAL_KEY]
    return [
        (DUPLICATE_KEY, F.lit(False)),
        ("signal key must not be null", B.any_of(keys)),
        ("position must be -1, 0 or 1", ~F.coalesce(F.col("position").isin(-1, 0, 1), F.lit(False))),
        ("signal and position disagree", ~F.coalesce(wanted[F.col("signal")] == F.col("position"), F.lit(False))),
        ("confidence is outside [0, 1]", ~F.coalesce(F.col("confidence").between(0.0, 1.0), F.lit(True))),
        ("close must not be null", F.col("close").isNull()),
    ]
