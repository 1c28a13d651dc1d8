"""Publish bars as keyed JSON events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.operators import events as E
from barlake.runtime import stage, unstage
from barlake.schema import ContractError


def _reaching(counts: DataFrame, column: str, limit: int) -> tuple | None:
    """The value of ``column`` at which the running sum of ``n`` reaches ``limit``, and the sum before it."""
    running = F.sum("n").over(Window.orderBy(F.asc_nulls_first(column)))
    through = counts.select(column, "n", running.alias("through")).where(F.col("through") >= limit)
    row = through.orderBy("through").first()
    return row and (row[column], row["through"] - row["n"])


def first_rows(bars: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` bars in series and time order, null symbols and times first.

    Counts by symbol and day, combined before their shuffle, tell where the limit falls: in
    which symbol, and on which of its days. Symbols and days before that are taken whole; only
    the rows of that one symbol and day are sorted. What meets in one task is a count for each
    symbol, for each day of one symbol, or the bars of one symbol and day, for any limit.
    """
    if limit <= 0:
        raise ValueError("limit must be greater than zero")
    day = F.date_trunc("day", F.col("event_time"))
    days = stage(bars.groupBy("symbol", day.alias("day")).agg(F.count(F.lit(1)).alias("n")), "first-rows")
    at = _reaching(days.groupBy("symbol").agg(F.sum("n").alias("n")), "symbol", limit)
    if at is None:
        return bars
    symbol, before = at
    own = F.col("symbol").eqNullSafe(F.lit(symbol))
    last, earlier = _reaching(days.where(own).select("day", "n"), "day", limit - before)
    on_day = own & day.eqNullSafe(F.lit(last))
    rest = Window.partitionBy("symbol").orderBy(F.asc_nulls_first("event_time"))
    taken = bars.where(on_day).withColumn("_n", F.row_number().over(rest))
    # A null sorts before any value.
    whole_symbol = F.lit(False) if symbol is None else F.col("symbol").isNull() | (F.col("symbol") < symbol)
    whole_day = F.lit(False) if last is None else own & (day.isNull() | (day < F.lit(last)))
    unstage(bars.sparkSession, days)
    return bars.where(whole_symbol | whole_day).unionByName(taken.where(F.col("_n") <= limit - before - earlier).drop("_n"))


def publish(
    bars: DataFrame,
    write: Callable[[DataFrame], None],
    source: str | None = None,
    ingest_run_id: str | None = None,
    limit: int | None = None,
) -> int:
    """Validate every event, hand ``key``/``value`` rows to ``write``, return the count.

    Messages are stored once first, so that the check, the write and the count see
    the same run ids and times. Any invalid event stops the run before the write.
    """
    rows = bars if limit is None else first_rows(bars, limit)
    messages = stage(E.to_messages(E.build_events(rows, source, ingest_run_id)), "messages")
    try:
        bad = E.validate_messages(messages).filter("error IS NOT NULL").select("error").first()
        if bad is not None:
            raise ContractError(bad["error"])
        write(messages)
        return messages.count()
    finally:
        unstage(bars.sparkSession, messages)
